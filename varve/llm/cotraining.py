"""Quality classifier by co-training a view of the text with a view of the page's metadata.

Both views start from the same labelled sample. In each round every document is scored by both views, and the
documents that one view is surest of become pseudo-labelled training rows of the other; a row that both
views are sure of, in opposite ways, teaches neither. At the end each view is calibrated on labelled rows kept out of
training, and all documents are scored by the sum of the two calibrated log-odds
(the sample is half of each class, so its prior log-odds are 0).

The text view reads hashed n-grams. The metadata view reads what a record says about the page: language, source, both
together, and the declared length in steps; it never reads the text.

Bounds, all parameters: ``fit_rows`` labelled documents, ``exchange`` pseudo-labels per view, class and round.

Defined results: null metadata is a value of its own; a null or empty text has no n-grams; without labels
of both classes the score is 1; columns named like a result are replaced.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.llm.learning import GRAM_SIZE, Sparse, fraction, gram_rows, gram_scores, labelled_sample, logistic, one_task, platt, sigmoid
from varve.session import written

FIT_ROWS = 3_000
EXCHANGE = 200
ROUNDS = 2
#: What a view must be sure of to teach the other, and the score from which a document is kept.
SURE = 0.95
THRESHOLD = 0.5
META_SIZE = 1 << 16
META = ("lang", "source", "n_chars")


def _with_meta(docs: DataFrame) -> DataFrame:
    """``docs`` with one text column of metadata values, whatever of them the table has."""
    parts = []
    for name in META:
        value = F.col(name).cast("string") if name in docs.columns else F.lit(None).cast("string")
        parts.append(F.coalesce(value, F.lit("")))
    return docs.withColumn("meta", F.concat_ws("\x1f", *parts))


def _meta_indices(meta: str) -> list[int]:
    lang, source, length = meta.split("\x1f")[:3]
    step = str(len(bin(max(int(length), 0)))) if length.lstrip("-").isdigit() else "?"
    values = (f"l{lang}", f"s{source}", f"n{step}", f"ls{lang}\x1f{source}", f"ln{lang}\x1f{step}")
    return [zlib.crc32(v.encode("utf-8", "replace")) % META_SIZE for v in values]


def _meta_rows(metas) -> Sparse:
    return Sparse([(np.array(_meta_indices(m), np.int64), np.ones(5)) for m in metas])


def _part(rows: Sparse, chosen: np.ndarray) -> Sparse:
    out = Sparse([])
    keep = chosen[rows.row]
    out.count = int(chosen.sum())
    out.index, out.value, out.row = rows.index[keep], rows.value[keep], (np.cumsum(chosen) - 1)[rows.row[keep]]
    return out


def _learn(rows):
    """Both views' weights and calibrations from labelled and pseudo-labelled rows."""
    import pandas as pd

    rows = rows.sort_values(["doc_id", "view"])
    own = rows["view"].to_numpy() == "both"
    target = rows["quality"].to_numpy(float)
    held = np.zeros(len(rows), bool)
    held[np.flatnonzero(own)[::3]] = True
    model = None
    if len(set(target[own])) == 2:
        model = []
        for view, features, size in (
            ("text", gram_rows(rows["text"]), GRAM_SIZE),
            ("meta", _meta_rows(rows["meta"]), META_SIZE),
        ):
            train = ~held & (own | (rows["view"].to_numpy() == view))
            weights, bias = logistic(_part(features, train), target[train], size, ridge=1e-4 if view == "text" else 1e-2)
            slope, offset = platt((features.scores(weights) + bias)[held], target[held])
            model.append((weights.astype(np.float32), bias, max(slope, 1e-3), offset))
    return pd.DataFrame({"model": [pickle.dumps(model)]})


def _scored(docs: DataFrame, model: bytes) -> DataFrame:
    """``docs`` (doc_id, text, meta and others) with the calibrated ``text_p`` and ``meta_p``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two weight vectors of fixed size
    schema = T.StructType([*docs.schema.fields, T.StructField("text_p", T.DoubleType()), T.StructField("meta_p", T.DoubleType())])

    def run(batches):
        views = pickle.loads(shared.value)
        memo: dict[str, float] = {}
        for batch in batches:
            text_p = meta_p = np.ones(batch.num_rows)
            if views:
                weights, bias, slope, offset = views[0]
                text_p = sigmoid(slope * (gram_scores(batch.column("text"), weights) + bias) + offset)
                weights, bias, slope, offset = views[1]
                metas = batch.column("meta").to_pylist()
                for meta in set(metas) - memo.keys():
                    if len(memo) > 100_000:
                        memo.clear()
                    memo[meta] = float(sum(weights[i] for i in _meta_indices(meta)))
                raw = np.array([memo[m] if m in memo else float(sum(weights[i] for i in _meta_indices(m))) for m in metas])
                meta_p = sigmoid(slope * (raw + bias) + offset)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(text_p), pa.array(meta_p)], [*batch.schema.names, "text_p", "meta_p"]
            )

    return docs.mapInArrow(run, schema)


def _pseudo_labels(scored: DataFrame, exchange: int, salt: int) -> DataFrame:
    """(doc_id, quality, view): for each view the documents that the other one is surest of, of each class."""
    chosen = []
    for teacher, pupil in (("text_p", "meta"), ("meta_p", "text")):
        other = "meta_p" if teacher == "text_p" else "text_p"
        for quality in (0, 1):
            p = F.col(teacher) if quality else 1 - F.col(teacher)
            q = F.col(other) if quality else 1 - F.col(other)
            sure = scored.where((p >= SURE) & (q > 1 - SURE))
            top = sure.orderBy(p.desc(), fraction("doc_id", F.lit(salt))).limit(exchange)
            chosen.append(top.select("doc_id", F.lit(quality).alias("quality"), F.lit(pupil).alias("view")))
    out = chosen[0]
    for more in chosen[1:]:
        out = out.unionByName(more)
    return out


def classify(
    docs: DataFrame,
    labels: DataFrame,
    rounds: int = ROUNDS,
    fit_rows: int = FIT_ROWS,
    exchange: int = EXCHANGE,
) -> DataFrame:
    """``docs`` with ``text_p``, ``meta_p``, ``quality_score`` and ``kept``."""
    own = ("meta", "text_p", "meta_p", "quality_score", "kept")
    plain = docs.select(*[c for c in docs.columns if c not in own])
    whole = _with_meta(plain)
    slim = whole.select("doc_id", "text", "meta")
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select("doc_id").distinct()
    sample = labelled_sample(slim, labels, "quality", fit_rows).withColumn("view", F.lit("both"))
    sample = written(sample.select("doc_id", "text", "meta", "quality", "view"), "training")
    model = _fitted(sample)
    for turn in range(rounds):
        scores = written(_scored(slim, model).select("doc_id", "text_p", "meta_p"), "scores")
        unlabelled = scores.join(known, "doc_id", "left_anti")
        # at most 4 * exchange rows
        taught = written(_pseudo_labels(unlabelled, exchange, turn), "taught")
        more = slim.join(F.broadcast(taught), "doc_id").select("doc_id", "text", "meta", "quality", "view")
        sample = written(sample.unionByName(more), "training")
        model = _fitted(sample)
    odds = [F.log(F.greatest(p, F.lit(1e-6)) / F.greatest(1 - p, F.lit(1e-6))) for p in (F.col("text_p"), F.col("meta_p"))]
    combined = 1 / (1 + F.exp(-(odds[0] + odds[1])))
    return (
        _scored(whole, model)
        .withColumn("quality_score", combined)
        .withColumn("kept", F.col("quality_score") >= THRESHOLD)
        .drop("meta")
    )


def _fitted(sample: DataFrame) -> bytes:
    found = one_task(sample, _learn, "model binary")
    return bytes(found[0]["model"]) if found else pickle.dumps(None)
