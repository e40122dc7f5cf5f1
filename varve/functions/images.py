"""Expressions on channel-row-column grids (``array<array<array<double>>>``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the image pipeline: per-channel mean and deviation
# on the 0..255 scale, and the crop padding in pixels.
CHANNEL_MEAN = (125.3, 123.0, 113.9)
CHANNEL_STD = (63.0, 62.1, 66.7)
PIXEL_SCALE = 255.0
CROP_PADDING = 4


def to_grid(values: Column, channels: int, rows: int, columns: int) -> Column:
    """A flat array as channels x rows x columns."""
    per_channel = rows * columns
    return F.transform(
        F.sequence(F.lit(0), F.lit(channels - 1)),
        lambda c: F.transform(
            F.sequence(F.lit(0), F.lit(rows - 1)),
            lambda r: F.slice(values, c * per_channel + r * columns + 1, columns),
        ),
    )


def normalize(
    image: Column,
    mean: Sequence[float] = CHANNEL_MEAN,
    std: Sequence[float] = CHANNEL_STD,
    scale: float = PIXEL_SCALE,
) -> Column:
    """Pixels to floats, then standardise each channel; mean and std are on the pixel scale."""
    means = F.array(*[F.lit(m / scale) for m in mean])
    stds = F.array(*[F.lit(s / scale) for s in std])
    return F.transform(
        image,
        lambda channel, c: F.transform(
            channel,
            lambda row: F.transform(row, lambda v: (v / scale - F.get(means, c)) / F.get(stds, c)),
        ),
    )


def flat(image: Column) -> Column:
    """A grid as one array again."""
    return F.flatten(F.flatten(image))


def augmented(image: Column, key: Column, seed: int, epoch: int, rows: int, columns: int, padding: int = CROP_PADDING) -> Column:
    """Crop and flip by draws that are fixed per seed, epoch and ``key``."""
    top = draw(2 * padding + 1, seed, epoch, key, "top").cast("int")
    left = draw(2 * padding + 1, seed, epoch, key, "left").cast("int")
    heads = draw(2, seed, epoch, key, "flip") == 1
    return flip(crop(image, top, left, rows, columns, padding), heads)


def draw(limit: int, *parts: Column | int | str) -> Column:
    """A repeatable pseudo-random integer in [0, limit) from the given parts."""
    text = F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % limit


def flip(image: Column, when: Column) -> Column:
    """Mirror each row left to right where ``when`` holds."""
    mirrored = F.transform(image, lambda channel: F.transform(channel, lambda row: F.reverse(row)))
    return F.when(when, mirrored).otherwise(image)


def crop(image: Column, top: Column, left: Column, rows: int, columns: int, padding: int = CROP_PADDING) -> Column:
    """A rows x columns cut at (top, left) of the zero-padded image; offsets run 0..2*padding."""
    zero = F.lit(0.0)
    blank = F.array_repeat(F.array_repeat(zero, columns + 2 * padding), padding)
    edge = F.array_repeat(zero, padding)

    def cut(channel: Column) -> Column:
        wide = F.transform(channel, lambda row: F.concat(edge, row, edge))
        tall = F.concat(blank, wide, blank)
        return F.transform(F.slice(tall, top + 1, rows), lambda row: F.slice(row, left + 1, columns))

    return F.transform(image, cut)
