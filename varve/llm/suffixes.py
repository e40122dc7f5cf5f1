"""Exact substring dedup over bytes by bucket-pointer refinement.

Strings that may repeat are brought together by their anchors (see :mod:`varve.llm.anchors`): a context
that an earlier one equals is a duplicate as a whole. The distinct contexts of an anchor are then
suffix-sorted to the depth of the window: positions start in buckets of equal 8-grams, and a bucket is
refined by the bucket numbers at a later offset, first 8, then 16, 32 and 64 places on; each round
reuses the numbers of the round before, so depth doubles, and the last round reaches exactly the
window. In a final bucket every position but the earliest is a duplicate.

An anchor with more than ``GROUP_CONTEXTS`` contexts is not refined in one task: its windows are
hashed, and their first positions found by an aggregation that combines before the shuffle.

Defined results: a null or empty text has no bytes; a null id comes before all others; rows that share an
id are one document seen again: they are no sources for each other, and what is found for the id holds for each;
columns named like a result are replaced, and ``doc`` and ``spans`` are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.llm import columns
from varve.llm.anchors import contexts, covered, shared_contexts, spans_by_doc
from varve.llm.columns import bytes_of, texts_of
from varve.session import shuffle_partitions, written

WINDOW_BYTES = 100
ANCHOR_BYTES = 20
STEP_BYTES = 500_000
#: Bytes of contexts that are refined at once, and contexts of one anchor that a task may hold.
CHUNK_BYTES = 1_000_000
GROUP_CONTEXTS = 5_000
FIRST_GRAM = 8
LEAST = -(2**63)

_SPAN = "doc bigint, start int, end int"


def _byte_symbols(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return columns.byte_symbols(buf), offsets


def buckets(buf: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Bucket numbers of the strings of ``window`` bytes at ``starts``: equal where the strings are."""
    depth = min(FIRST_GRAM, window)
    count = len(buf) - depth + 1
    packed = np.zeros(count, np.uint64)
    for j in range(depth):
        packed = (packed << np.uint64(8)) | buf[j : j + count].astype(np.uint64)
    pointer = np.unique(packed, return_inverse=True)[1]
    while depth < window:
        step = min(depth, window - depth)
        last = depth + step == window
        at = starts if last else np.arange(len(pointer) - step)
        pairs = pointer[at] * np.int64(len(pointer) + 1) + pointer[at + step]
        pointer = np.unique(pairs, return_inverse=True)[1]
        depth += step
        if last:
            return pointer
    return pointer[starts]


def _refine(window: int):
    """Duplicate runs among contexts that come sorted by anchor, document and place."""

    def solve(docs, places, texts):
        sizes = np.array([len(t) for t in texts])
        count = sizes - window + 1
        offset = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        inner = np.arange(count.sum()) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count)
        starts = np.repeat(offset, count) + inner
        pointer = buckets(np.frombuffer(b"".join(texts), np.uint8), starts, window)
        repeated = np.ones(len(starts), bool)
        repeated[np.unique(pointer, return_index=True)[1]] = False
        return _runs(np.repeat(docs, count), np.repeat(places, count) + inner, repeated, window)

    def run(batches):
        docs, places, texts, held, last = [], [], [], 0, None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc", "start", "bytes")))
            for anchor, doc, start, text in rows:
                if held >= CHUNK_BYTES and anchor != last:
                    yield solve(docs, places, texts)
                    docs, places, texts, held = [], [], [], 0
                last = anchor
                docs.append(doc)
                places.append(start)
                texts.append(text)
                held += len(text)
        if texts:
            yield solve(docs, places, texts)

    return run


def _runs(docs, starts, repeated, window):
    """Runs of consecutive repeated windows as spans."""
    docs, starts = docs[repeated], starts[repeated]
    fresh = np.ones(len(docs), bool)
    fresh[1:] = (docs[1:] != docs[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(docs)) - 1
    ends = starts[last] + window if len(docs) else starts
    return pa.RecordBatch.from_arrays(
        [pa.array(docs[first], pa.int64()), pa.array(starts[first], pa.int32()), pa.array(ends, pa.int32())],
        ["doc", "start", "end"],
    )


def _cut_out(window: int):
    """The bytes of each wanted context."""

    def run(batches):
        for batch in batches:
            lists = batch.column("wanted").to_pylist()
            for doc, wanted, text in zip(batch.column("doc").to_pylist(), lists, texts_of(batch.column("text"))):
                if wanted:
                    pieces = [text[w["start"] : w["start"] + w["windows"] + window - 1] for w in wanted]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([w["anchor"] for w in wanted], pa.int64()),
                            pa.array([w["crowded"] for w in wanted], pa.bool_()),
                            pa.array([doc] * len(wanted), pa.int64()),
                            pa.array([w["start"] for w in wanted], pa.int32()),
                            pa.array(pieces, pa.binary()),
                        ],
                        ["anchor", "crowded", "doc", "start", "bytes"],
                    )

    return run


def _each_window(window: int):
    """Hash and place of every window of the contexts of crowded anchors."""

    def run(batches):
        for batch in batches:
            buf, offsets = bytes_of(batch.column("bytes"))
            keys = [batch.column(c).to_numpy() for c in ("anchor", "doc", "start")]
            for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                symbols = columns.byte_symbols(buf[a:b])
                hashes = columns.gram_hashes(symbols, window).view(np.int64)
                count = len(hashes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count, keys[0][row])),
                        pa.array(hashes),
                        pa.array(np.full(count, keys[1][row])),
                        pa.array(keys[2][row] + np.arange(count), pa.int32()),
                    ],
                    ["anchor", "hashed", "doc", "start"],
                )

    return run


def repeat_spans(keyed: DataFrame, texts: DataFrame, window: int, k: int, group_contexts: int) -> DataFrame:
    """(doc, start, end) in bytes: strings of at least ``window`` bytes that also start earlier."""
    found = contexts(keyed, _byte_symbols, k, window, STEP_BYTES)
    judged = shared_contexts(found, "contexts")
    again = F.coalesce("more", F.array().cast("array<int>"))
    places = F.when(F.col("doc") > F.col("source"), F.concat(F.array(F.col("first").cast("int")), again)).otherwise(again)
    whole = judged.select("doc", "windows", F.explode(places).alias("start"))
    whole = whole.select("doc", "start", (F.col("start") + F.col("windows") + window - 1).alias("end"))

    distinct = judged.where("doc = source AND NOT alone")
    crowds = distinct.groupBy("anchor").count().where(F.col("count") > group_contexts).select("anchor", F.lit(True).alias("crowded"))
    wanted = (
        distinct.join(crowds, "anchor", "left")
        .groupBy("doc")
        .agg(
            F.collect_list(
                F.struct(
                    "anchor", F.col("first").cast("int").alias("start"), "windows", F.coalesce("crowded", F.lit(False)).alias("crowded")
                )
            ).alias("wanted")
        )
    )
    pieces = written(
        texts.select("doc", "text")
        .join(wanted, "doc", "left")
        .mapInArrow(_cut_out(window), "anchor bigint, crowded boolean, doc bigint, start int, bytes binary"),
        "pieces",
        "crowded",
    )
    refined = (
        pieces.where("NOT crowded")
        .repartition(shuffle_partitions(keyed.sparkSession), "anchor")
        .sortWithinPartitions("anchor", "doc", "start")
        .mapInArrow(_refine(window), _SPAN)
    )
    single = pieces.where("crowded").mapInArrow(_each_window(window), "anchor bigint, hashed bigint, doc bigint, start int")
    earliest = single.groupBy("anchor", "hashed").agg(F.min("doc").alias("source"))
    # two windows of one document in one crowd: the later start is the repeat
    within = single.groupBy("anchor", "hashed", "doc").agg(F.min("start").alias("first_start"), F.collect_list("start").alias("starts"))
    crowded = within.join(earliest, ["anchor", "hashed"]).select(
        "doc",
        F.explode(
            F.when(F.col("doc") > F.col("source"), F.col("starts")).otherwise(
                F.filter("starts", lambda s: s > F.col("first_start"))
            )
        ).alias("start"),
    )
    crowded = crowded.select("doc", "start", (F.col("start") + window).alias("end"))
    return whole.unionByName(refined).unionByName(crowded)


def without_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    window: int = WINDOW_BYTES,
    k: int = ANCHOR_BYTES,
    group_contexts: int = GROUP_CONTEXTS,
) -> DataFrame:
    """``docs`` with ``kept`` (the remaining bytes), ``n_bytes``, ``n_removed`` and ``n_spans``."""
    own = ("doc", "spans", "kept", "n_bytes", "n_removed", "n_spans")
    keyed = docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(LEAST)).alias("doc"), *[c for c in docs.columns if c not in own]
    )
    # placed by document, for cutting contexts out and again for the result
    texts = keyed.repartition(shuffle_partitions(docs.sparkSession), "doc")
    spans = spans_by_doc(repeat_spans(keyed, texts, window, k, group_contexts))
    marked = texts.join(spans, "doc", "left").drop("doc")
    plain = [f for f in marked.schema.fields if f.name != "spans"]
    more = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                kept, counts = [], ([], [], [])
                for text, spans in zip(texts_of(part.column("text")), part.column("spans").to_pylist()):
                    gone = covered(spans, len(text))
                    buf = np.frombuffer(text, np.uint8)
                    kept.append(buf[~gone].tobytes() if spans else text)
                    runs = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].any())
                    for values, value in zip(counts, (len(text), int(gone.sum()), runs)):
                        values.append(value)
                columns_ = [c for i, c in enumerate(part.columns) if part.schema.names[i] != "spans"]
                names = [n for n in part.schema.names if n != "spans"]
                yield pa.RecordBatch.from_arrays(
                    [*columns_, pa.array(kept, pa.binary()), *(pa.array(c, pa.int64()) for c in counts)],
                    [*names, "kept", "n_bytes", "n_removed", "n_spans"],
                )

    return marked.mapInArrow(run, T.StructType([*plain, T.StructField("kept", T.BinaryType()), *more]))
