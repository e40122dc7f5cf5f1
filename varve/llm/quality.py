"""Quality rules: exact counts, and a calibrated n-gram logistic regression against a fixed threshold.

The regression sees shares of hashed words, word pairs and character runs. It is fitted on a
sample of at most about ``FIT_ROWS`` labelled documents, four fifths of which train the weights and one
fifth the calibration; everything else is computed from each whole text in Arrow batches.

Defined results: a null or empty text has no words, fails the base rules and is not kept; without labels of
both classes every score is 1, so only the base rules decide; columns named like a result are replaced.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from varve.llm.columns import BASE, SOLID, mixed, steps, texts_of, word_ends, word_hashes
from varve.llm.learning import GRAM_SIZE, Sparse, gram_rows, gram_scores, labelled_sample, logistic, one_task, platt, sigmoid

#: Labelled documents that the model is fitted on, about.
FIT_ROWS = 3_000
#: A document is kept from this probability of good quality on.
THRESHOLD = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated_words(words: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Words of each row that lie in a three-word window which its row has twice or more."""
    if len(words) < 3:
        return np.zeros(rows, np.int64)
    windows = mixed((words[:-2] * BASE + words[1:-1]) * BASE + words[2:] + mixed(row[:-2].astype(np.uint64)))
    inside = row[:-2] == row[2:]
    _, number, times = np.unique(windows[inside], return_inverse=True, return_counts=True)
    twice = np.zeros(len(words), bool)
    twice[np.flatnonzero(inside)[times[number] > 1]] = True
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return np.bincount(row[covered], minlength=rows)


def _repeated_lines(text: bytes) -> int:
    seen, repeated = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line.split():
            seen.add(line)
    return repeated


def counts(column: pa.Array, step_bytes: int = 1_000_000) -> dict[str, np.ndarray]:
    out = {name: np.zeros(len(column), np.int64) for name in COUNTS}
    for first, stop, buf, offsets in steps(column, step_bytes):
        starts, ends = word_ends(buf, offsets)
        row = np.searchsorted(offsets, starts, "right") - 1
        inside = SOLID[buf]
        part = slice(first, stop)
        out["n_words"][part] = np.bincount(row, minlength=stop - first)
        out["word_chars"][part] = _per_row(inside & ((buf & 0xC0) != 0x80), offsets)
        out["n_symbols"][part] = _per_row(_SYMBOL[buf], offsets)
        out["n_repeat_words"][part] = _repeated_words(word_hashes(buf, starts, ends), row, stop - first)
    out["n_dup_lines"][:] = [_repeated_lines(t) for t in texts_of(column)]
    return out


def fit(sample: DataFrame, label: str = "quality") -> bytes:
    """The model as bytes: weights, bias and calibration."""

    def learn(rows):
        import pandas as pd

        rows = rows.sort_values("doc_id")
        target = rows[label].to_numpy(float)
        features = gram_rows(rows["text"])
        held = np.arange(len(rows)) % 5 == 0
        train = ~held
        weights, bias = logistic(_rows_of(features, train), target[train], GRAM_SIZE)
        slope, offset = platt(features.scores(weights)[held] + bias, target[held])
        weights[np.abs(weights) < 1e-9] = 0
        model = (weights.astype(np.float32), bias, max(slope, 1e-3), offset)
        usable = len(set(target)) == 2
        return pd.DataFrame({"model": [pickle.dumps(model if usable else None)]})

    found = one_task(sample.select("doc_id", "text", label), learn, "model binary")
    return bytes(found[0]["model"]) if found else pickle.dumps(None)


def _rows_of(features: Sparse, chosen: np.ndarray) -> Sparse:
    part = Sparse([])
    keep = chosen[features.row]
    part.count = int(chosen.sum())
    part.index, part.value = features.index[keep], features.value[keep]
    part.row = (np.cumsum(chosen) - 1)[features.row[keep]]
    return part


def judge(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the five counts, ``base_failed``, ``quality_score`` and ``kept``."""
    sample = labelled_sample(docs.select("doc_id", "text"), labels, "quality", fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast(fit(sample))  # GRAM_SIZE numbers
    own = [T.StructField(n, T.LongType()) for n in COUNTS]
    own += [T.StructField("base_failed", T.BooleanType()), T.StructField("quality_score", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    plain = docs.select(*[c for c in docs.columns if c not in {f.name for f in own}])

    def run(batches):
        model = pickle.loads(shared.value)
        for batch in batches:
            text = batch.column("text")
            found = counts(text)
            failed = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"])
            score = np.ones(len(text))
            if model is not None:
                weights, bias, slope, offset = model
                score = sigmoid(slope * (gram_scores(text, weights) + bias) + offset)
            values = [*(found[n] for n in COUNTS), failed, score, ~failed & (score >= threshold)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(v) for v in values)], [*batch.schema.names, *(f.name for f in own)]
            )

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, *own]))
