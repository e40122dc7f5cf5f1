"""Placement of rows on partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varve.functions.text import djb2
from varve.operators.graph import adjacency_list, out_degree
from varve.session import written

# Fixed value: how many partitions nodes are placed on.
WORD_PARTITIONS = 150


def place_by_word_hash(df: DataFrame, key: str, parts: int = WORD_PARTITIONS) -> DataFrame:
    """Put each row on partition ``djb2(key) % parts``, kept as column ``part``.

    All rows of a key share a partition, so fold frequent keys first.
    """
    tagged = df.withColumn("part", (djb2(F.col(key)) % parts).cast("int"))
    return tagged.repartitionById(parts, "part")


def place_rows_by_word_hash(df: DataFrame, key: str, parts: int = WORD_PARTITIONS) -> DataFrame:
    """All rows placed by word hash, with ``part`` as in :func:`place_by_word_hash` and ``slot``, a part of that part.

    A word partition that a frequent key fills is dealt by lot to as many slots as leave each about half a fair share of the
    rows, and every slot is a Spark partition. That makes at most three times ``parts`` of them, of which the largest has about one and a half times the mean.
    """
    tagged = df.withColumn("_part", (djb2(F.col(key)) % parts).cast("int")).withColumn("_turn", F.monotonically_increasing_id())
    # a table: a task that is run again deals the same rows to the same slots
    tagged = written(tagged, "tagged")
    sizes = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))  # one row per word partition
    total = sizes.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    share = max(total / (2 * parts), 1.0)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    slots = F.ceil(F.col("_rows") / share).cast("int")
    layout = sizes.withColumn("_slots", slots).withColumn("_first", F.coalesce(F.sum("_slots").over(before), F.lit(0)))
    layout = written(layout.drop("_rows"), "layout")
    count = max(layout.agg(F.sum("_slots")).first()[0] or 1, 1)
    slot = F.pmod(F.xxhash64("_turn"), F.col("_slots")).cast("int")
    dealt = tagged.join(F.broadcast(layout), "_part").withColumn("_slot", slot)
    placed = dealt.withColumn("_place", (F.col("_first") + F.col("_slot")).cast("int")).repartitionById(count, "_place")
    return placed.select(*df.columns, F.col("_part").alias("part"), F.col("_slot").alias("slot"))


def nodes_by_word_hash(edges: DataFrame, parts: int = WORD_PARTITIONS) -> DataFrame:
    """(src, out_degree, part) placed by word hash, one row per source.

    Sources are counted before they move, so a hub costs its partition one row.
    """
    return place_by_word_hash(out_degree(edges), "src", parts)


def adjacency_by_word_hash(edges: DataFrame, parts: int = WORD_PARTITIONS, **how) -> DataFrame:
    """Adjacency lists placed by word hash: (src, list_part, neighbors, part).

    Lists come in numbered parts of bounded length, so a hub moves as several rows, none of them large.
    """
    lists = adjacency_list(edges, **how).withColumnRenamed("part", "list_part")
    return place_by_word_hash(lists, "src", parts)
