"""Adjacency as sorted lists of node numbers, kept as gaps.

A node dictionary numbers the nodes in order. A source's distinct targets, sorted by number, become rows of at most ``per_row``: the first
number, and from each to the next a gap. Gaps are small, repeat often and so take few bits in a columnar file, where names or
shares would stand once per edge. Numbers of copies are left out where all are 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.operators.blocks import global_position
from varve.operators.graph import NEIGHBORS_PER_ROW, adjacency_list
from varve.session import setting, written


def node_dictionary(edges: DataFrame) -> DataFrame:
    """(node, number) of all ends of ``edges``, numbered in order; written."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    return written(global_position(ends, ["node"], name="number"), "dictionary")


def numbered_edges(folded: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(src, dst, copies) by node numbers; written."""
    sources = dictionary.select(F.col("node").alias("src"), F.col("number").alias("_s"))
    targets = dictionary.select(F.col("node").alias("dst"), F.col("number").alias("_d"))
    joined = folded.join(sources, "src").join(targets, "dst")
    # names too many to broadcast become hash tables, as long as a partition's share is small; the edges stream past them unsorted
    with setting(dictionary.sparkSession, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m"):
        return written(joined.select(F.col("_s").alias("src"), F.col("_d").alias("dst"), "copies"), "numbered")


def gap_lists(numbered: DataFrame, per_row: int = NEIGHBORS_PER_ROW) -> DataFrame:
    """(src, part, first, gaps, copies): the lists of :func:`adjacency_list`, with gaps from 0 on and null for copies that are all 1."""
    lists = adjacency_list(numbered, per_row)
    # each target beside the one before it, the first beside itself; one pass, as looking up by place in a lambda would make a list's cost its square
    dst = F.col("neighbors.dst")
    before = F.concat(F.slice(dst, 1, 1), F.slice(dst, F.lit(1), F.size("neighbors") - 1))
    gap = F.zip_with(dst, before, lambda d, b: (d - b).cast("bigint"))
    several = F.when(F.exists("neighbors", lambda n: n["copies"] > 1), F.col("neighbors.copies"))
    return lists.select("src", "part", F.get(dst, 0).alias("first"), gap.alias("gaps"), several.alias("copies"))


def spread_lists(given: DataFrame) -> DataFrame:
    """(dst, amount) of rows (first, gaps, copies, share): ``share`` times its copies for every target of the list."""

    def decode(batches):
        for batch in batches:
            gaps, copies = batch.column("gaps"), batch.column("copies")
            sizes = gaps.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            steps = gaps.flatten().to_numpy()
            total = np.cumsum(steps)
            begin = np.cumsum(sizes) - sizes
            # every list begins with a gap of 0, so the sum there is the sum before it
            dst = total + np.repeat(batch.column("first").to_numpy() - total[begin], sizes)
            amount = np.repeat(batch.column("share").to_numpy(zero_copy_only=False), sizes)
            counted = ~copies.is_null().to_numpy(zero_copy_only=False)
            amount[np.repeat(counted, sizes)] *= copies.flatten().to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(dst), pa.array(amount)], ["dst", "amount"])

    return given.select("first", "gaps", "copies", "share").mapInArrow(decode, "dst bigint, amount double")
