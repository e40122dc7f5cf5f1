"""Shards of near-equal bytes by sampled splitters.

Rows are ordered by (hash of the text, doc_id), so equal texts are neighbours. A sample that takes
a row with a chance in proportion to its size gives quantile boundaries; ranges that turn out
overfull are sampled anew and subdivided, within a group of equal texts by doc_id. Exact range totals
then place each row by its offset in bytes, and a shard is one stretch of offsets.

Defined results: a null text has no bytes and goes with the empty texts; repeated rows are rows
of their own; an empty table gives empty shards; columns named like a result are replaced.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varve.session import fresh_path, written

#: Bytes that a row costs besides its text.
ROW_BYTES = 8
#: Bytes of a range, which one task sorts; there are at least ``RANGES_PER_SHARD`` per shard.
RANGE_BYTES = 64_000_000
RANGES_PER_SHARD = 4
#: Samples per range, and how much larger than planned a range may be.
SAMPLES = 24
OVERFULL = 1.5
LEAST = -(2**63)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        *[c for c in docs.columns if c not in ("shard", "slot", "size", "group_key", "order_key", "law", "range")],
        (F.octet_length(text).cast("bigint") + ROW_BYTES).alias("size"),
        F.xxhash64(text).alias("group_key"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST)).alias("order_key"),
    )


def _drawn(keys: DataFrame, step: float, turn: int) -> list[tuple[int, int]]:
    """Sorted keys of about one row per ``step`` bytes; the draw is fixed by key and turn."""
    chance = F.pmod(F.xxhash64("group_key", "order_key", F.lit(turn)), F.lit(1 << 40)) / float(1 << 40)
    rows = keys.where(chance < F.col("size") / step).select("group_key", "order_key").distinct().collect()
    return sorted((r[0], r[1]) for r in rows)


def _range_of(splitters: list[tuple[int, int]]):
    """Range number of each key: how many splitters are not above it."""
    groups = np.array([s[0] for s in splitters], np.int64)
    orders = np.array([s[1] for s in splitters], np.int64)

    @F.pandas_udf("int")
    def find(group: pd.Series, order: pd.Series) -> pd.Series:
        group, order = group.to_numpy(), order.to_numpy()
        low, high = np.searchsorted(groups, group, "left"), np.searchsorted(groups, group, "right")
        for i in np.flatnonzero(high > low):
            low[i] += np.searchsorted(orders[low[i] : high[i]], order[i], "right")
        return pd.Series(low.astype(np.int32))

    return find("group_key", "order_key")


def _totals(ranged: DataFrame) -> dict[int, tuple[int, int]]:
    rows = ranged.groupBy("range").agg(F.sum("size"), F.count(F.lit(1))).collect()
    return {r[0]: (r[1], r[2]) for r in rows}


def splitters_for(keys: DataFrame, total: int, ranges: int) -> tuple[list[tuple[int, int]], dict[int, tuple[int, int]]]:
    """Boundary keys of about ``ranges`` ranges, and each range's bytes and rows."""
    goal = total / ranges
    drawn = _drawn(keys, goal / SAMPLES, 0)
    splitters = sorted({drawn[i] for i in range(SAMPLES, len(drawn), SAMPLES)})
    turn = 0
    while True:
        totals = _totals(keys.withColumn("range", _range_of(splitters)))
        full = [r for r, (size, rows) in totals.items() if size > OVERFULL * goal and rows > 1]
        turn += 1
        if not full or turn > 4:
            return splitters, totals
        inside = keys.withColumn("range", _range_of(splitters)).where(F.col("range").isin(full))
        more = set()
        by_range: dict[int, list[tuple[int, int]]] = {}
        for key in _drawn(inside, goal / SAMPLES, turn):
            at = bisect_left(splitters, key)
            by_range.setdefault(at + (at < len(splitters) and splitters[at] == key), []).append(key)
        for at, found in by_range.items():
            pieces = max(2, -(-totals.get(at, (0, 0))[0] // int(goal)))
            more |= {found[len(found) * i // pieces] for i in range(1, pieces)}
        if more <= set(splitters):
            return splitters, totals
        splitters = sorted(more.union(splitters))


def assign_shards(docs: DataFrame, shards: int, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``, dealt out by range and sorted within.

    Shards differ by less than two of the largest rows; slots count from 0 in each shard, in key order.
    """
    # sizes and keys only, so that sampling and counting never read a text again
    keys = written(_keyed(docs).select("size", "group_key", "order_key"), "keys")
    total, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = max(shards * RANGES_PER_SHARD, -(-total // range_bytes))
    splitters, totals = splitters_for(keys, total, ranges) if rows else ([], {})
    starts, size_before, rows_before = [], 0, 0
    for number in range(len(splitters) + 1):
        starts.append((number, size_before, rows_before))
        size, count = totals.get(number, (0, 0))
        size_before, rows_before = size_before + size, rows_before + count
    spark = docs.sparkSession
    start = spark.createDataFrame(starts, "range int, bytes_before bigint, rows_before bigint")
    in_range = Window.partitionBy("range").orderBy("group_key", "order_key").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        _keyed(docs)
        .withColumn("range", _range_of(splitters))
        .withColumn("bytes_to", F.sum("size").over(in_range))
        .withColumn("rows_to", F.count(F.lit(1)).over(in_range))
        .join(F.broadcast(start), "range")  # one row per range
    )
    middle = F.col("bytes_before") + F.col("bytes_to") - F.floor(F.col("size") / 2)
    shard = F.least(F.lit(shards - 1), F.floor(middle * F.lit(shards) / F.lit(max(total, 1)))).cast("int")
    return placed.withColumn("shard", shard).withColumn("position", F.col("rows_before") + F.col("rows_to") - 1)


def write_shards(docs: DataFrame, path: str, shards: int, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write the rows in folders ``shard=n`` under ``path`` and read them back with ``size``, ``shard`` and ``slot``."""
    spark = docs.sparkSession
    hidden = ["group_key", "order_key", "range", "bytes_to", "rows_to", "bytes_before", "rows_before"]
    out = assign_shards(docs, shards, range_bytes).drop(*hidden)
    out.write.partitionBy("shard").parquet(path)
    stored = spark.read.schema(out.schema).parquet(path)
    # a shard's rows have consecutive positions; the first of each shard is its slot 0
    first = stored.groupBy("shard").agg(F.min("position").alias("first"))
    slotted = stored.join(F.broadcast(first), "shard")  # one row per shard
    return slotted.withColumn("slot", F.col("position") - F.col("first")).drop("position", "first")


def shards_in(spark, label: str = "shards") -> str:
    return fresh_path(spark, label)
