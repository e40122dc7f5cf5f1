"""Exact top-k search by inner product, with distributed histogram selection.

Every vector is scored for every query, block by block, and nothing but counts leaves the tasks: a round cuts each query's range of
scores into ``BINS`` bins, adds the tasks' histograms up and goes on inside the bin that holds the query's k-th score. When bins are one score wide, the
k-th score is known; a last pass keeps what is above it, and of the rows that equal it the smallest ids.

A task reports its bins from the top down to the one where it has counted k scores itself: the k-th of all lies no lower, so lower bins can't hold it.
Equal vectors may fill any share of the table: they are one count, and in the last pass a task hands on at most k rows a query.

Vectors and queries are packed into blocks of rows; a query block is bounded by ``QUERY_VALUES`` components and is what a round broadcasts. Scores are products of
matrices of whole numbers, in the narrowest type that is exact for the vectors at hand. The table is read once per round and query block.

Defined results: a vector that is null, empty, or holds a null, non-finite or unusable component (a floor of 2**52 or more) takes no part, nor does a row
without id. Vectors are compared with those of their own length only. Rows that repeat an id are rows of their own, but none is a candidate for a query of its id.
Scores are exact up to 2**63.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varve.session import written

SCALE = 256
BINS = 512
#: Components of a query block.
QUERY_VALUES = 262_144
#: Scores that a task computes at a time.
STEP_SCORES = 2_000_000
LEAST = -(2**63)


def whole_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v, width, size): vectors as whole numbers, their lengths, and the squares' sum; only rows that take part."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            sizes = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, lists.value_lengths().fill_null(0).to_numpy())
            values = lists.flatten()
            flat = values.cast(pa.float64()).fill_null(np.nan).to_numpy()
            with np.errstate(invalid="ignore", over="ignore"):
                whole = np.floor(flat * SCALE)
                bad = ~(np.abs(whole) < 2.0**52)
                whole[bad] = 0
                ends = np.cumsum(sizes)
                sums = lambda x: np.concatenate(([0], np.cumsum(x)))
                errors = sums(bad)
                good = (sizes > 0) & (errors[ends] == errors[ends - sizes])
                own = np.repeat(np.arange(len(sizes)), sizes)
                square = np.bincount(own, whole * whole, len(sizes))
            good &= ~batch.column(0).is_null().to_numpy(zero_copy_only=False)
            kept = np.flatnonzero(good)
            lengths = sizes[kept]
            data = whole[good[own]].astype(np.int64)
            offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(kept)),
                    pa.ListArray.from_arrays(offsets, pa.array(data)),
                    pa.array(lengths, pa.int32()),
                    pa.array(square[kept], pa.float64()),
                ],
                ["id", "v", "width", "square"],
            )

    frame = rows.select(rows[id_column].cast("bigint").alias("id"), rows[vector].alias("v"))
    return frame.mapInArrow(run, "id bigint, v array<bigint>, width int, square double")


def top_k(rows: DataFrame, is_query, k: int, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the ``k`` highest inner products of each row for which ``is_query(id column)`` holds."""
    if k < 1:
        raise ValueError("k is 1 or more")
    vectors = written(whole_vectors(rows, id_column, vector), "vectors")
    asked = is_query(F.col("id"))
    widths = vectors.groupBy("width").agg(
        F.max("square").alias("square"), F.count(F.when(asked, 1)).alias("queries"), F.max(F.when(asked, F.col("square"))).alias("largest")
    )
    found = []
    for width, square, queries, largest in widths.where("queries > 0").orderBy("width").collect():  # one row per length of vectors
        candidates = vectors.where(F.col("width") == width).select("id", "v")
        blocks = -(-queries * width // QUERY_VALUES)
        # the queries, dealt evenly
        dealt = written(candidates.where(asked).repartition(blocks).withColumn("block", F.spark_partition_id()), "asked", "block")
        for block in range(blocks):
            own = dealt.where(F.col("block") == block).select("id", "v").toArrow()
            if own.num_rows:
                best = _selected(candidates, _matrix(own.column("v"), width), own.column("id").to_numpy(), k, square * largest)
                found.append(best.withColumn("block", F.lit(len(found))))
    if not found:
        return vectors.limit(0).select(
            F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias(id_column), F.col("id").alias("score")
        )
    rows = reduce(DataFrame.unionByName, found)
    order = Window.partitionBy("query_id", "block", "place").orderBy(F.col("score").desc(), F.col("id"))
    return (
        rows.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_column), "score")
    )


def _matrix(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(-1, width)


def _kind(square: float):
    """The narrowest type in which products up to the root of ``square``, and all partial sums, are exact."""
    limit = np.sqrt(square) + 1
    return np.float32 if limit < 2**24 else np.float64 if limit < 2**53 else np.int64


def _scores(batches, queries: np.ndarray, kind):
    """(ids, first query, scores) of blocks of vectors, scores by query and vector."""
    turned = queries.astype(kind)
    for batch in batches:
        ids = batch.column(0).to_numpy()
        vectors = _matrix(batch.column(1), queries.shape[1])
        high = max(1, min(len(ids), 4096))
        wide = max(1, STEP_SCORES // high)
        for i in range(0, len(ids), high):
            part = vectors[i : i + high].astype(kind).T.copy()
            for first in range(0, len(turned), wide):
                yield ids[i : i + high], first, (turned[first : first + wide] @ part).astype(np.int64)


def _selected(candidates: DataFrame, queries: np.ndarray, names: np.ndarray, k: int, square: float) -> DataFrame:
    """(query_id, place, id, score) of one block of queries; what is above each k-th score, and the smallest ids at it."""
    spark = candidates.sparkSession
    kind, count = _kind(square), len(names)
    reach = min(int(np.sqrt(square)) + 1, 2**62)
    step = -(-(2 * reach + 1) // BINS)
    low = np.full(count, -reach, np.int64)  # the k-th score lies from here
    high = np.full(count, reach + 1, np.int64)  # to below this
    above = np.zeros(count, np.int64)  # and so many from there on
    done = np.zeros(count, bool)  # fewer than k scores: all stay
    send = spark.sparkContext.broadcast
    fixed = send((queries, names))
    while True:
        shared = send((low, high, done, step))
        counts = candidates.mapInArrow(_histogram(fixed, shared, kind, k), "place int, bin int, times bigint")
        totals = counts.groupBy("place", "bin").agg(F.sum("times").alias("times"))
        down = Window.partitionBy("place").orderBy(F.col("bin").desc())
        reached = totals.withColumn("until", F.sum("times").over(down.rowsBetween(Window.unboundedPreceding, 0)))
        start = spark.createDataFrame(pa.table({"place": np.arange(count, dtype=np.int32), "over": above}))
        # the first bin, from above, with which the count is k or more
        bins = (
            reached.join(F.broadcast(start), "place")
            .where("until + over >= {0} and until - times + over < {0}".format(k))
            .select("place", "bin", (F.col("over") + F.col("until") - F.col("times")).alias("over"))
            .toArrow()  # one row per query of the block
        )
        at = bins.column("place").to_numpy()
        missing = np.ones(count, bool)
        missing[at] = False
        done |= missing
        low[at] += step * bins.column("bin").to_numpy().astype(np.int64)
        above[at] = bins.column("over").to_numpy()
        high = np.minimum(high, low + step)
        if step == 1 or done.all():
            break
        step = -(-step // BINS)
    low[done] = LEAST
    kth = send(low)

    def keep(batches):
        queries, names = fixed.value
        limits = kth.value
        # of a task's rows the k best of each query, so that equal scores don't pile up
        held = [[] for _ in names]
        for ids, first, scores in _scores(batches, queries, kind):
            own = names[first : first + len(scores)]
            hit = (scores >= limits[first : first + len(scores), None]) & (ids[None, :] != own[:, None])
            row, column = np.nonzero(hit)
            for r in np.unique(row):
                c = column[np.searchsorted(row, r) : np.searchsorted(row, r, "right")]
                old = held[first + r]
                score = np.concatenate([scores[r, c], old[0]]) if old else scores[r, c]
                name = np.concatenate([ids[c], old[1]]) if old else ids[c]
                best = np.lexsort((name, -score))[:k]
                held[first + r] = score[best], name[best]
        full = [i for i, x in enumerate(held) if x]
        if full:
            sizes = [len(held[i][0]) for i in full]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(names[full], sizes)),
                    pa.array(np.repeat(full, sizes), pa.int32()),
                    pa.array(np.concatenate([held[i][1] for i in full])),
                    pa.array(np.concatenate([held[i][0] for i in full])),
                ],
                ["query_id", "place", "id", "score"],
            )

    return candidates.mapInArrow(keep, "query_id bigint, place int, id bigint, score bigint")


def _histogram(fixed, shared, kind, k: int):
    """Counts by query and bin of a task's scores, from the top down to where they reach ``k``."""

    def run(batches):
        queries, names = fixed.value
        low, high, done, step = shared.value
        table = np.zeros((len(names), BINS), np.int64)
        for ids, first, scores in _scores(batches, queries, kind):
            stop = first + len(scores)
            # what lies above the range has been counted before
            counted = (scores >= low[first:stop, None]) & (scores < high[first:stop, None])
            counted &= (ids[None, :] != names[first:stop, None]) & ~done[first:stop, None]
            row, column = np.nonzero(counted)
            flat = row * BINS + (scores[row, column] - low[first + row]) // step
            table[first:stop] += np.bincount(flat, minlength=len(scores) * BINS).reshape(-1, BINS)
        over = np.cumsum(table[:, ::-1], axis=1)[:, ::-1] - table  # scores in higher bins
        place, bin_ = np.nonzero((table > 0) & (over < k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int32()), pa.array(bin_, pa.int32()), pa.array(table[place, bin_])], ["place", "bin", "times"]
        )

    return run
