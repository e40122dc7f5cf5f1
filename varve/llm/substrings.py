"""Substring dedup over words by hashed windows, which replace a greedy relative Lempel-Ziv parse.

Sources are all documents with smaller ids. Their text is grouped by content: a block holds the contexts that
share an anchor (see :mod:`varve.llm.anchors`), and a document meets only the blocks of its own anchors.
Whole contexts are looked up first by their hash; of a context that no earlier document has, each window is looked up
among the windows of its block. No match is extended: windows found are united to duplicate spans.

Defined results: a null or empty text has no words; a null id comes before all others; rows that
share an id are one document seen again, so they are no sources for each other, and what is found for the
id holds for each; columns named like a result are replaced, and ``doc`` and ``spans`` are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.llm.anchors import contexts, covered, shared_contexts, spans_by_doc
from varve.llm.columns import gram_hashes, texts_of, word_ends, word_hashes
from varve.session import shuffle_partitions

WINDOW_WORDS = 50
#: An anchor is this part of a window.
ANCHOR_SHARE = 5
STEP_BYTES = 2_000_000
LEAST = -(2**63)


def _word_symbols(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = word_ends(buf, offsets)
    return word_hashes(buf, starts, ends), np.searchsorted(starts, offsets)


def _keyed(docs: DataFrame, id_column: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(LEAST)).alias("doc"),
        *[c for c in docs.columns if c not in ("doc", "spans", "n_words", "kept", "n_removed")],
    )


def _windows_of(window: int):
    """Hashes of each window in the contexts listed with a text."""

    def run(batches):
        for batch in batches:
            lists = batch.column("wanted").to_pylist()
            for doc, wanted, text in zip(batch.column("doc").to_pylist(), lists, texts_of(batch.column("text"))):
                if not wanted:
                    continue
                buf = np.frombuffer(text, np.uint8)
                symbols, _ = _word_symbols(buf, np.array([0, len(buf)]))
                hashes = gram_hashes(symbols, window).view(np.int64)
                start = np.array([w["start"] for w in wanted])
                count = np.array([w["windows"] for w in wanted])
                at = np.repeat(start - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), doc, np.int64)),
                        pa.array(np.repeat(np.array([w["anchor"] for w in wanted], np.int64), count)),
                        pa.array(hashes[at]),
                        pa.array(at, pa.int32()),
                    ],
                    ["doc", "anchor", "hashed", "start"],
                )

    return run


def factor_spans(keyed: DataFrame, texts: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """(doc, start, end): runs of words covered by windows that also start in an earlier document.

    ``texts`` holds the same rows as ``keyed``, placed by ``doc``.
    """
    found = contexts(keyed, _word_symbols, max(1, window // ANCHOR_SHARE), window, STEP_BYTES)
    parsed = shared_contexts(found, "contexts")
    places = F.concat(F.array(F.col("first").cast("int")), F.coalesce("more", F.array().cast("array<int>")))
    phrases = parsed.where("doc > source").select("doc", "windows", F.explode(places).alias("start"))
    phrases = phrases.select("doc", "start", (F.col("start") + F.col("windows") + window - 1).alias("end"))

    # where a factor ends: contexts that no earlier document has as a whole, though it has their anchor
    ends = parsed.where("doc = source AND NOT alone").select("doc", "anchor", "windows", F.explode(places).alias("start"))
    wanted = ends.groupBy("doc").agg(F.collect_list(F.struct("anchor", "start", "windows")).alias("wanted"))
    windows = (
        texts.select("doc", "text")
        .join(wanted, "doc", "left")
        .mapInArrow(_windows_of(window), "doc bigint, anchor bigint, hashed bigint, start int")
    )
    first = windows.groupBy("anchor", "hashed").agg(F.min("doc").alias("source"))
    single = (
        windows.join(first, ["anchor", "hashed"])
        .where("doc > source")
        .select("doc", "start", (F.col("start") + window).alias("end"))
    )
    return phrases.unionByName(single)


def duplicate_spans(docs: DataFrame, id_column: str = "doc_id", window: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` with ``spans``: places [start, end) in words, not merged, or null where there are none."""
    keyed = _keyed(docs, id_column)
    # placed by document once; the parse at factor ends and the result both read this one exchange
    texts = keyed.repartition(shuffle_partitions(docs.sparkSession), "doc")
    spans = spans_by_doc(factor_spans(keyed, texts, window))
    return texts.join(spans, "doc", "left").drop("doc")


def without_duplicates(docs: DataFrame, id_column: str = "doc_id", window: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` with duplicate words cut out of ``text``, and ``n_words``, ``n_removed`` and ``kept``.

    ``kept`` holds the remaining words joined by one space. ``text`` keeps its own white space between words
    that stay, and is untouched in a document that loses nothing.
    """
    marked = duplicate_spans(docs, id_column, window)
    plain = [f for f in marked.schema.fields if f.name != "spans"]
    more = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts, counts, removed, kept = [], [], [], []
                old = part.column("text")
                for row, (text, spans) in enumerate(zip(texts_of(old), part.column("spans").to_pylist())):
                    words = None if spans else text.split()
                    if words is not None:
                        counts.append(len(words))
                        removed.append(0)
                        kept.append(b" ".join(words))
                        texts.append(text if old[row].is_valid else None)
                        continue
                    starts, ends = word_ends(buf := np.frombuffer(text, np.uint8), np.array([0, len(buf)]))
                    gone = covered(spans, len(starts))
                    counts.append(len(starts))
                    removed.append(int(gone.sum()))
                    kept.append(b" ".join([text[a:b] for a, b in zip(starts[~gone], ends[~gone])]))
                    texts.append(_cut(text, starts, ends, gone))
                at = part.schema.get_field_index("text")
                columns = [c for i, c in enumerate(part.columns) if part.schema.names[i] != "spans"]
                names = [n for n in part.schema.names if n != "spans"]
                columns[names.index("text")] = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    [*names, "n_words", "n_removed", "kept"],
                )

    return marked.mapInArrow(run, T.StructType(plain + more))


def _cut(text: bytes, starts: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> bytes:
    """``text`` without the words that are gone and the white space after each."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
    pieces, last = [], 0
    for first, stop in zip(edge[::2], edge[1::2]):
        pieces.append(text[last : starts[first]])
        last = starts[stop] if stop < len(starts) else ends[stop - 1]
    return b"".join([*pieces, text[last:]])
