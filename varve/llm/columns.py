"""What the operators share: text columns as byte arrays, word positions, 64-bit hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy step works on; a longer text is a step of its own.
STEP_BYTES = 2_000_000

_SPACES = (0x20, *range(0x09, 0x0E))
#: True where a byte belongs to a word of "anything but ASCII white space".
SOLID = np.ones(256, bool)
SOLID[list(_SPACES)] = False

_RANDOM = np.random.default_rng(20_240_229)
_BYTE = _RANDOM.integers(1, 2**63, 256, np.uint64)
_PLACE = _RANDOM.integers(0, 2**63, 1 << 16, np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def as_strings(column: pa.Array) -> pa.Array:
    """``column`` with null as the empty text."""
    return column.fill_null("") if column.null_count else column


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each row, null as empty, one at a time."""
    buf, offsets = bytes_of(column)
    view = memoryview(buf)
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield bytes(view[a:b])


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column, and its ``rows + 1`` offsets into them."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows with about ``limit`` bytes."""
    buf, offsets = bytes_of(column)
    rows, first = len(offsets) - 1, 0
    while first < rows:
        stop = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        stop = min(max(stop, first + 1), rows)
        yield first, stop, buf[offsets[first] : offsets[stop]], offsets[first : stop + 1] - offsets[first]
        first = stop


def word_ends(buf: np.ndarray, offsets: np.ndarray, solid: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends in bytes of the maximal runs of ``solid`` bytes; runs end with their row."""
    inside = solid[buf]
    before = np.empty(len(buf), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(buf)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(buf), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word: a sum of random products of byte and place, mixed with the length."""
    out = np.empty(len(starts), np.uint64)
    sizes = ends - starts
    total = np.concatenate(([0], np.cumsum(sizes)))
    first = 0
    while first < len(starts):
        stop = int(np.searchsorted(total, total[first] + 500_000, "right")) - 1
        stop = min(max(stop, first + 1), len(starts))
        size, at = sizes[first:stop], total[first:stop] - total[first]
        place = np.arange(total[stop] - total[first], dtype=np.int64) - np.repeat(at, size)
        value = _BYTE[buf[place + np.repeat(starts[first:stop], size)]]
        if size.max(initial=0) >= len(_PLACE):
            value = value + (place >> 16).astype(np.uint64) * BASE
            place = place & 0xFFFF
        out[first:stop] = np.add.reduceat(value * _PLACE[place], at)
        first = stop
    return mixed(out + sizes.astype(np.uint64) * BASE)


def byte_symbols(buf: np.ndarray) -> np.ndarray:
    """A random 64-bit number for each byte."""
    return _BYTE[buf]


def powers(count: int, base: np.uint64 = BASE) -> np.ndarray:
    """``base`` to the powers 0 to ``count - 1`` modulo 2**64."""
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def gram_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` symbols, one per start."""
    count = max(len(symbols) - k + 1, 0)
    out = np.zeros(count, np.uint64)
    for j in range(k):
        out *= BASE
        out += symbols[j : j + count]
    return mixed(out)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
