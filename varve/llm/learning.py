"""Bounded samples, sparse logistic regression and calibration, fitted in one task on a sample of fixed size."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.columns import BASE, mixed, steps, word_ends, word_hashes


def fraction(*columns) -> F.Column:
    """A fixed number in [0, 1) per value of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / float(1 << 40)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, only=None, balanced=True) -> DataFrame:
    """``docs`` with ``label`` as int for about ``rows`` documents drawn by a hash of the id, half of each class if ``balanced``.

    Several labels of one document count as the largest. The drawn ids are at most about ``rows`` and so may be broadcast.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if only is not None:
        known = known.where(only)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias(label))
    counts = {r[0]: r[1] for r in known.groupBy(label).count().collect()}
    rate = F.lit(0.0)
    for value, count in counts.items():
        rate = F.when(F.col(label) == value, F.lit(min(1.0, rows / 2 / count if balanced else rows / sum(counts.values())))).otherwise(rate)
    drawn = known.where(fraction("doc_id", F.lit(label)) < rate)
    return docs.select(*[c for c in docs.columns if c != label]).join(F.broadcast(drawn), "doc_id")


def one_task(sample: DataFrame, fit, schema: str) -> list:
    """Rows that ``fit`` makes of the whole bounded sample, in one task."""
    return sample.groupBy(F.lit(0).alias("all")).applyInPandas(lambda rows: fit(rows), schema).collect()


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Sparse:
    """Rows of (index, value) pairs, all rows in one pair of arrays."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.count = len(rows)
        self.index = np.concatenate([r[0] for r in rows] or [np.zeros(0, np.int64)])
        self.value = np.concatenate([r[1] for r in rows] or [np.zeros(0)])
        self.row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.index] * self.value, self.count)


def logistic(rows: Sparse, target: np.ndarray, size: int, ridge=1e-4, steps_=80, rate=0.3, weight=None) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression, by Adam over the whole sample; classes weigh the same."""
    weights, bias = np.zeros(size), 0.0
    if not rows.count:
        return weights, bias
    share = np.where(target == 1, 0.5 / max(target.sum(), 1), 0.5 / max((1 - target).sum(), 1))
    share = share * (1 if weight is None else weight)
    first, second, bias_first, bias_second = np.zeros(size), np.zeros(size), 0.0, 0.0
    for turn in range(1, steps_ + 1):
        error = (sigmoid(rows.scores(weights) + bias) - target) * share
        slope = np.bincount(rows.index, error[rows.row] * rows.value, size) + ridge * weights
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        fade = (1 - 0.9**turn, 1 - 0.99**turn)
        weights = weights - rate * (first / fade[0]) / (np.sqrt(second / fade[1]) + 1e-6)
        slope = error.sum()
        bias_first, bias_second = 0.9 * bias_first + 0.1 * slope, 0.99 * bias_second + 0.01 * slope**2
        bias -= rate * (bias_first / fade[0]) / (np.sqrt(bias_second / fade[1]) + 1e-6)
    return weights, float(bias)


def platt(scores: np.ndarray, target: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities, by Newton steps with a little smoothing."""
    if not len(scores) or target.min() == target.max():
        return 1.0, 0.0
    weight = np.ones(len(scores)) if weight is None else weight
    n1, n0 = target.sum(), (1 - target).sum()
    goal = np.where(target == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(np.abs(scores).mean(), 1e-6)
    x = np.stack([scores / scale, np.ones(len(scores))], 1)
    theta, prior = np.zeros(2), 0.2  # which holds a handful of rows back from certainty
    for _ in range(50):
        p = sigmoid(x @ theta)
        slope = x.T @ (weight * (p - goal)) + prior * theta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + prior * np.eye(2)
        step = np.linalg.solve(curve, slope)
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(theta[0] / scale), float(theta[1])


#: Numbers of features: words and word pairs share the first half, runs of characters the second.
GRAM_BITS = 16
GRAM_SIZE = 2 << GRAM_BITS
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_HALF = np.uint64((1 << GRAM_BITS) - 1)


def gram_indices(buf: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed n-grams of several texts as (feature, text) arrays: words, word pairs, runs of 3 and 4 bytes.

    Words are lower-cased; runs keep their case and don't cross from one text to the next.
    """
    starts, ends = word_ends(buf, offsets)
    words = word_hashes(_LOWER[buf], starts, ends)
    row = np.searchsorted(offsets, starts, "right") - 1
    found = [((words & _HALF).astype(np.int32), row)]
    pairs = mixed(words[:-1] * BASE + words[1:])
    same = row[:-1] == row[1:]
    found.append(((pairs[same] & _HALF).astype(np.int32), row[:-1][same]))
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    wide = buf.astype(np.uint32)
    for n, odd in ((3, 0x9E3779B1), (4, 0x85EBCA77)):
        count = len(buf) - n + 1
        if count <= 0:
            continue
        packed = np.zeros(count, np.uint32)
        for j in range(n):
            packed = (packed << np.uint32(8)) | wide[j : j + count]
        index = ((packed * np.uint32(odd)) >> np.uint32(32 - GRAM_BITS)).astype(np.int32) + (1 << GRAM_BITS)
        same = owner[:count] == owner[n - 1 :]
        found.append((index[same], owner[:count][same]))
    return found


def gram_scores(column: pa.Array, weights: np.ndarray, step_bytes: int = 1_000_000) -> np.ndarray:
    """For each text the sum over the four kinds of n-gram of their mean weight; 0 for an empty text."""
    out = np.zeros(len(column))
    for first, stop, buf, offsets in steps(column, step_bytes):
        for index, row in gram_indices(buf, offsets):
            count = np.bincount(row, minlength=stop - first)
            out[first:stop] += np.bincount(row, weights[index], stop - first) / np.maximum(count, 1)
    return out


def gram_rows(texts: Iterable[str | None]) -> Sparse:
    """The same features as rows for fitting: shares of each kind of n-gram."""
    rows = []
    for text in texts:
        data = np.frombuffer((text or "").encode(), np.uint8)
        parts = []
        for index, _ in gram_indices(data, np.array([0, len(data)])):
            if len(index):
                feature, count = np.unique(index, return_counts=True)
                parts.append((feature.astype(np.int32), (count / len(index)).astype(np.float32)))
        rows.append(
            (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            if parts
            else (np.zeros(0, np.int32), np.zeros(0, np.float32))
        )
    return Sparse(rows)
