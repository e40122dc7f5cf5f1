"""Edge-list operators: degrees, adjacency, rank spreading, source-only nodes.

A graph is a multigraph edge list ``(src, dst)``; parallel edges count separately.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varve.functions.exact import exact_sum
from varve.operators.blocks import Running, in_blocks, running
from varve.session import shuffle_partitions, written

HUB_EDGES = 1_000_000
#: Hash buckets per partition in which sources are counted to find hubs.
SIEVE = 64
NEIGHBORS_PER_ROW = 10_000


def out_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def adjacency_list(edges: DataFrame, per_row: int = NEIGHBORS_PER_ROW) -> DataFrame:
    """(src, part, neighbors) with neighbors as sorted (dst, copies) pairs.

    A node of more than ``per_row`` distinct targets gets several parts, numbered
    from 0, so no single row has to hold a hub. Edges with ``copies`` are folded already.
    """
    folded = edges
    if "copies" not in edges.columns:
        folded = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies"))
    ranked = running(
        in_blocks(folded, ["src", "dst"]), ["src"], [Running("_nth", "sum", F.lit(1), before=True)]
    )
    part = F.floor(F.col("_nth") / per_row).alias("part")
    return ranked.groupBy("src", part).agg(
        F.sort_array(F.collect_list(F.struct("dst", "copies"))).alias("neighbors")
    )


def hubs(edges: DataFrame, parts: int, at_least: int = HUB_EDGES) -> DataFrame:
    """(src, out_degree, slots) of sources too large for one of ``parts`` partitions.

    Each has more than 1/parts of all edges, so there are fewer than ``parts``, and
    their slots, enough for a fair share each, add up to less than twice that.
    """
    return hubs_of(out_degree(edges), parts, at_least)


def hubs_of(degree: DataFrame, parts: int, at_least: int = HUB_EDGES) -> DataFrame:
    """What :func:`hubs` returns, of sources counted before."""
    fair_share = degree.agg(
        F.greatest(F.sum("out_degree") / parts, F.lit(float(at_least))).alias("share")
    ).scalar()
    return degree.where(F.col("out_degree") > fair_share).withColumn(
        "slots", F.ceil(F.col("out_degree") / fair_share)
    )


def heavy_sources(edges: DataFrame, parts: int, at_least: int = HUB_EDGES, copies: str | None = None) -> DataFrame:
    """What :func:`hubs` returns, without an exchange of all sources.

    Sources are first counted together, by hash, in ``SIEVE`` buckets per partition. Bucket counts of tasks add up, so that summary is
    ``SIEVE * parts`` rows whatever the graph. A hub's bucket holds at least the hub's edges, so all hubs lie in the few buckets above a fair
    share; only the sources there, about one in ``SIEVE`` besides the hubs, are counted one by one.
    ``copies`` names a column that says how many edges a row stands for.
    """
    weight = F.col(copies) if copies else F.lit(1)
    bucket = F.pmod(F.xxhash64("src"), F.lit(SIEVE * parts)).alias("_bucket")
    counts = written(edges.groupBy(bucket).agg(F.sum(weight).alias("_edges")), "sieve")
    total = counts.agg(F.coalesce(F.sum("_edges"), F.lit(0))).first()[0]
    fair_share = max(total / parts, float(at_least))
    heavy = counts.where(F.col("_edges") > fair_share).select("_bucket")  # fewer than ``parts``
    suspects = edges.withColumn("_bucket", bucket).join(F.broadcast(heavy), "_bucket", "left_semi")
    degree = suspects.groupBy("src").agg(F.sum(weight).alias("out_degree"))
    return degree.where(F.col("out_degree") > fair_share).withColumn("slots", F.ceil(F.col("out_degree") / fair_share))


def name_number(name: str) -> Column:
    """A name's 64-bit hash."""
    return F.xxhash64(name)


def node_names(edges: DataFrame) -> DataFrame:
    """(node, out_degree, number) of all ends of ``edges``, written: from one pass over them, as both ends are counted together."""
    out = F.struct(F.col("src").alias("node"), F.lit(1).alias("out"))
    into = F.struct(F.col("dst").alias("node"), F.lit(0).alias("out"))
    nodes = edges.select(F.inline(F.array(out, into))).groupBy("node").agg(F.sum("out").alias("out_degree"))
    return written(nodes.withColumn("number", name_number("node")), "names")


def have_own_numbers(names: DataFrame) -> bool:
    """Whether no two names have the same number."""
    return names.groupBy("number").count().where("count > 1").isEmpty()


def folded_edges(edges: DataFrame) -> DataFrame:
    """(src, dst, copies) of edges with both ends, written once: what degrees, hubs and shares are derived from."""
    whole = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    return written(whole.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies")), "folded")


def edge_shares(
    edges: DataFrame, parts: int, fold: bool = True, slotted: bool = False, degree: DataFrame | None = None
) -> DataFrame:
    """(src, dst, share) hashed on ``src``: the part of a source's rank that dst gets.

    One exchange serves the degree and, with ``fold``, the merging of parallel
    edges into one row. Every source must fit a partition; :func:`hub_shares`
    takes the others, and ``slotted`` adds the slot 0 to go with them. ``degree(src, out_degree)`` saves counting again, for which a
    partition's edges would be sorted.
    """
    keys = ["src"]
    if slotted:
        keys = ["src", "slot"]
        edges = edges.withColumn("slot", F.lit(0))
    placed = edges.repartition(parts, *keys)
    if "copies" in edges.columns:
        pass  # folded before
    elif fold:
        placed = placed.groupBy(*keys, "dst").agg(F.count(F.lit(1)).alias("copies"))
    else:
        placed = placed.withColumn("copies", F.lit(1))
    if degree is not None:
        counted = (degree.withColumn("slot", F.lit(0)) if slotted else degree).hint("shuffle_hash")
        return placed.join(counted, keys).select(*keys, "dst", (F.col("copies") / F.col("out_degree")).alias("share"))
    degree = F.sum("copies").over(Window.partitionBy(*keys))
    return placed.select(*keys, "dst", (F.col("copies") / degree).alias("share"))


def hub_shares(edges: DataFrame, hub_rows: DataFrame) -> DataFrame:
    """Edge shares of hub sources, dealt to their slots by dst; ``hub_rows`` is the bounded hub list."""
    folded = edges.join(F.broadcast(hub_rows.select("src")), "src", "left_semi")
    if "copies" not in edges.columns:
        folded = folded.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies"))
    slot = F.pmod(F.xxhash64("dst"), F.col("slots")).cast("int")
    share = F.col("copies") / F.col("out_degree")
    return folded.join(F.broadcast(hub_rows), "src").select(
        "src", slot.alias("slot"), "dst", share.alias("share")
    )


def target_lists(shares: DataFrame, per_row: int = NEIGHBORS_PER_ROW) -> DataFrame:
    """Edge shares as lists: one row for the targets that get the same share of a source, or several of about ``per_row`` targets.

    A source's shares add up to 1, so the share itself says how many targets may have it. Shares that are hashed on their source, or on it
    and its slot, stay where they are.
    """
    keys = [c for c in shares.columns if c not in ("dst", "share")]
    rows = F.ceil(F.lit(1.0) / (F.col("share") * per_row))
    row = F.pmod(F.xxhash64("dst", F.lit(0)), rows).alias("_row")
    return shares.groupBy(*keys, "share", row).agg(F.collect_list("dst").alias("targets")).drop("_row")


def to_targets(shares: DataFrame, amount: Column) -> DataFrame:
    """(dst, amount) rows of shares, one by one or as :func:`target_lists`."""
    if "targets" in shares.columns:
        return shares.select("targets", amount.alias("amount")).select(F.explode("targets").alias("dst"), "amount")
    return shares.select("dst", amount.alias("amount"))


def in_slots(ranks: DataFrame, hub_rows: DataFrame) -> DataFrame:
    """Ranks with ``slot``, a hub's rank once per slot it has."""
    slots = F.broadcast(hub_rows.select(F.col("src").alias("node"), "slots"))
    last = F.coalesce("slots", F.lit(1)) - 1
    each = F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("slot")
    return ranks.join(slots, "node", "left").select("node", "rank", each)


def spread(shares: DataFrame, ranks: DataFrame) -> DataFrame:
    """(dst, amount) rows: every edge hands on its share of the source's rank.

    Ranks with slots meet the edges of their slot, others all edges of the node. The ranks, one row per
    node, become the hash table; the edges, or lists of targets, stream past it unsorted.
    """
    match = shares.src == ranks.node
    if "slot" in ranks.columns:
        match &= shares.slot == ranks.slot
    return to_targets(shares.join(ranks.hint("shuffle_hash"), match), F.col("share") * F.col("rank"))


def gathered(amounts: DataFrame, name: str, shape=lambda total: total, exact: bool = False) -> DataFrame:
    """Sum by target, combined before the shuffle; an ``exact`` sum is the same for any order and width."""
    total: Column = exact_sum(F.col("amount")) if exact else F.sum("amount")
    return amounts.groupBy(F.col("dst").alias("node")).agg(shape(total).alias(name))


def first_ranks(edges: DataFrame) -> DataFrame:
    """Rank 1.0 for every node with out-edges."""
    return edges.select(F.col("src").alias("node")).distinct().withColumn("rank", F.lit(1.0))


def rank_contributions(edges: DataFrame, ranks: DataFrame, exact: bool = False) -> DataFrame:
    """What each node receives in one round from ``ranks(node, rank)``. ``edges`` are read once, and folded."""
    spark = edges.sparkSession
    parts = shuffle_partitions(spark)
    folded = folded_edges(edges)
    hub_list = heavy_sources(folded, parts, copies="copies")
    hub_rows = hub_list.collect()  # fewer than `parts` rows
    if not hub_rows:
        return gathered(spread(edge_shares(folded, parts), ranks), "contribution", exact=exact)
    hub_rows = spark.createDataFrame(hub_rows, hub_list.schema)
    regular = folded.join(F.broadcast(hub_rows), "src", "left_anti")
    shares = edge_shares(regular, parts, slotted=True).unionByName(hub_shares(folded, hub_rows))
    return gathered(spread(shares, in_slots(ranks, hub_rows)), "contribution", exact=exact)


def source_only_nodes(edges: DataFrame) -> DataFrame:
    """Nodes with out-edges and no in-edges, with value 0."""
    sources = edges.select(F.col("src").alias("node")).distinct()
    targets = edges.select(F.col("dst").alias("node")).distinct()
    return sources.join(targets, "node", "left_anti").withColumn("rank", F.lit(0.0))
