"""Windows of symbols grouped by anchors, so that equal windows meet without shuffling every window.

A window's anchor is the run of ``k`` symbols in it with the smallest hash, the leftmost of equals. Equal
windows have equal anchors at equal places. Consecutive windows with one anchor form a context:
the symbols from the first window's start to the last window's end. Two contexts with equal symbols hold
equal windows, so only contexts are shuffled; single windows matter only where contexts with one
anchor differ.

An anchor shared by a third of all documents is a hot key. Counting anchors and finding a context's first
document are aggregations that combine before the shuffle; the joins are plain equi-joins that
adaptive execution splits when skewed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.columns import BASE, mixed, powers, steps
from varve.session import dropped, fresh_path, written

_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)

CONTEXTS = "doc bigint, anchor bigint, context bigint, first bigint, windows int, more array<int>"


class Contexts:
    """Contexts of the rows in one run of symbols; ``offsets`` cuts the symbols into rows."""

    def __init__(self, symbols: np.ndarray, offsets: np.ndarray, k: int, window: int):
        size = len(symbols)
        count = max(size - window + 1, 0)
        if not count:
            self.row = self.start = self.windows = np.zeros(0, np.int64)
            self.anchor = self.context = np.zeros(0, np.int64)
            return
        back = powers(size + 1, _INVERSE)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(symbols * powers(size), out=sums[1:])
        grams = mixed((sums[k:] - sums[:-k]) * back[: size - k + 1])
        least = (grams & _HIGH) | np.arange(len(grams), dtype=np.uint64)
        span, width = window - k + 1, 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        chosen = (least & _LOW).astype(np.int64)
        # windows over the border of two rows are none
        over = np.zeros(count + 1, np.int32)
        border = offsets[1:-1]
        border = border[(border > 0) & (border < size)]
        np.add.at(over, np.clip(border - window + 1, 0, count), 1)
        np.add.at(over, np.clip(border, 0, count), -1)
        valid = np.cumsum(over[:count]) == 0
        fresh = valid.copy()
        fresh[1:] &= (chosen[1:] != chosen[:-1]) | ~valid[:-1]
        start = np.flatnonzero(fresh)
        number = np.cumsum(fresh) - 1
        windows = np.bincount(number[valid], minlength=len(start)) if len(start) else np.zeros(0, np.int64)
        content = (sums[start + windows + window - 1] - sums[start]) * back[start]
        self.row = np.searchsorted(offsets, start, "right") - 1
        self.start = start - offsets[self.row]
        self.windows = windows
        self.anchor = grams[chosen[start]].view(np.int64)
        self.context = mixed(content + windows.astype(np.uint64) * BASE).view(np.int64)

    def grouped(self):
        """Equal contexts of a row as one: (index of the first, places of the others as list offsets, others)."""
        order = np.lexsort((self.start, self.context, self.anchor, self.row))
        keys = [x[order] for x in (self.row, self.anchor, self.context)]
        fresh = np.ones(len(order), bool)
        fresh[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        firsts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(firsts, len(order))) - 1
        others = self.start[order[~fresh]]
        return order[firsts], np.concatenate(([0], np.cumsum(sizes))), others


def contexts(docs: DataFrame, symbols_of, k: int, window: int, step_bytes: int) -> DataFrame:
    """One row per document and distinct context: first place, number of windows, further places.

    ``docs`` has ``doc`` (bigint, the document's rank among all) and ``text``; ``symbols_of`` maps bytes
    and offsets to 64-bit symbols and their offsets.
    """

    def run(batches):
        for batch in batches:
            docs_ = batch.column("doc").to_numpy(zero_copy_only=False)
            for first, _, buf, offsets in steps(batch.column("text"), step_bytes):
                found = Contexts(*symbols_of(buf, offsets), k, window)
                if not len(found.row):
                    continue
                index, ends, others = found.grouped()
                # null rather than an empty list, which is most of them and would cost bytes in the shuffle
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(others, pa.int32()), mask=pa.array(np.diff(ends) == 0)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs_[first + found.row[index]], pa.int64()),
                        pa.array(found.anchor[index]),
                        pa.array(found.context[index]),
                        pa.array(found.start[index], pa.int64()),
                        pa.array(found.windows[index], pa.int32()),
                        lists,
                    ],
                    ["doc", "anchor", "context", "first", "windows", "more"],
                )

    return docs.select("doc", "text").mapInArrow(run, CONTEXTS)


def shared_contexts(found: DataFrame, label: str) -> DataFrame:
    """Contexts that hold a repeat or may hold a part of one, with ``source`` (the context's first document) and
    ``alone`` (whether no other context has its anchor). Written once."""
    # 32 bits of the anchor are enough to count: a chance collision only keeps some rows too many
    short = F.shiftright("anchor", 32).cast("int")
    # the size of null is -1 in sessions without ANSI
    times = F.when(F.col("more").isNull(), 0).otherwise(F.size("more"))
    often = (
        found.select(short.alias("short"), (1 + times).alias("times"))
        .groupBy("short")
        .agg(F.sum("times").alias("times"))
        .where("times > 1")
        .select("short")
    )
    spark = found.sparkSession
    place = fresh_path(spark, label)
    kept = written(found.withColumn("short", short).join(often, "short").drop("short"), label, path=place)
    sources = kept.groupBy("anchor", "context").agg(F.min("doc").alias("source"))
    several = (
        sources.groupBy("anchor").agg(F.min("context").alias("low"), F.max("context").alias("high")).where("low < high")
    )
    judged = sources.join(several.select("anchor", F.lit(False).alias("alone")), "anchor", "left")
    judged = judged.select("anchor", "context", "source", F.coalesce("alone", F.lit(True)).alias("alone"))
    useful = kept.join(judged, ["anchor", "context"]).where("doc > source OR NOT alone OR more IS NOT NULL")
    out = written(useful.drop("context"), "judged")
    dropped(spark, place)
    return out


def spans_by_doc(spans: DataFrame) -> DataFrame:
    """(doc, spans): the [start, end) of each document, packed so that no shuffle carries single ones."""
    return spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def covered(spans: list, size: int) -> np.ndarray:
    """True at each place below ``size`` that a span covers."""
    edge = np.zeros(size + 1, np.int32)
    if spans:
        ends = np.array([(s["start"], s["end"]) for s in spans], np.int64).clip(0, size)
        np.add.at(edge, ends[:, 0], 1)
        np.add.at(edge, ends[:, 1], -1)
    return np.cumsum(edge[:size]) > 0
