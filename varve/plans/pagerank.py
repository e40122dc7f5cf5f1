"""Fixed-round, unnormalised PageRank over a multigraph edge list."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Literal

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.operators.compact import gap_lists, node_dictionary, numbered_edges, spread_lists
from varve.operators.graph import (
    HUB_EDGES,
    NEIGHBORS_PER_ROW,
    edge_shares,
    folded_edges,
    gathered,
    have_own_numbers,
    heavy_sources,
    hub_shares,
    hubs_of,
    in_slots,
    name_number,
    node_names,
    out_degree,
    spread,
    target_lists,
    to_targets,
)
from varve.plans.manifest import Manifest, digest
from varve.session import planned_width, shuffle_partitions, shuffle_width, written, written_bucketed

# Rounds, damping and the constant every ranked node gets.
ROUNDS = 10
DAMPING = 0.85
CONSTANT = 0.15

#: Edges of a partition, at most about, where the data sets the width: files of few names are far smaller than their rows.
EDGES_PER_PART = 1_000_000


def pagerank(
    edges: DataFrame,
    rounds: int = ROUNDS,
    *,
    store: Literal["plan", "memory", "table"] = "table",
    parts: int | Literal["data"] | None = None,
    cut_every: int | None = None,
    hub_edges: int = HUB_EDGES,
    landed: bool = False,
    exact: bool = False,
) -> DataFrame:
    """``(node, rank)`` after ``rounds`` rounds of 0.15 + 0.85 * received rank.

    Ranks start at 1.0 on nodes with out-edges. After a round only nodes that
    received something are left, so nodes at the end of no ``rounds``-long walk
    are not in the result, and sinks pass nothing on.

    ``store`` says where the edge shares live between rounds: in the plan (one
    lazy query), in executor memory and disk, or in a table bucketed on ``src``.
    The last two write the parsed edges once, so that the source is read in one
    pass (``landed`` says they are a table already), and keep edges and ranks co-partitioned, which leaves one exchange per
    round. ``cut_every`` writes the ranks to a table every so many rounds, so that
    lost executors cost at most that many rounds; a plan that is one lazy query can't be cut.
    :func:`resumable_pagerank` also survives the loss of the session.

    ``parts`` is the number of partitions of edges and ranks, the session's shuffle width by default, or as many as the
    bytes and the number of the written edges ask for with "data". With another
    number than the session's the rounds are planned at that width and their result is written.

    Sources with more edges than a partition's fair share are dealt to slots by
    target, and their few ranks are repeated per slot. The ranks then need an
    exchange of their own in each round; the edges stay where they are.

    Rounds over names go by their 64-bit hashes, which a fraction of the time and of the bytes is enough for; the ranks get their names back at
    the end. All names are first written once with their numbers and out-degrees, and where two have one number the names themselves are used.

    With ``exact``, what a node receives is summed without rounding in between, so that ranks are the same bit for bit whatever the width,
    the store, or the order in which tasks end.
    """
    if cut_every and store == "plan":
        raise ValueError("store='plan' is one lazy query and can't be cut; take 'table' or 'memory'")
    spark = edges.sparkSession
    # Both ends are needed. Said here, the rounds need no null filters of their own
    # and share one edge exchange even when everything stays in the plan.
    edges = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    if not landed and (store != "plan" or parts == "data"):
        edges, landed = written(edges, "edges"), True
    if parts == "data":
        parts = max(planned_width(edges), -(-edges.count() // EDGES_PER_PART))
    how = (rounds, store, cut_every, hub_edges, exact)
    if parts is None or parts == shuffle_partitions(spark):
        return _named(edges, shuffle_partitions(spark), *how)
    with shuffle_width(spark, parts):
        return written(_named(edges, parts, *how), "ranks")


def _named(edges: DataFrame, parts: int, *how) -> DataFrame:
    """All rounds, over numbers where the nodes are names that have numbers of their own."""
    ends = edges.select("src", "dst").schema
    if any(field.dataType != T.StringType() for field in ends):
        return _ranked(edges, parts, *how)
    names = node_names(edges)
    if not have_own_numbers(names):
        return _ranked(edges, parts, *how)
    numbered = edges.select(name_number("src").alias("src"), name_number("dst").alias("dst"))
    degree = names.where("out_degree > 0").select(F.col("number").alias("src"), "out_degree")
    ranks = _ranked(numbered, parts, *how, degree=degree)
    return ranks.withColumnRenamed("node", "number").join(names, "number").select("node", "rank")


@dataclass(frozen=True)
class _Shares:
    """Edge shares, and the hubs whose shares lie in slots."""

    rows: DataFrame
    hubs: DataFrame | None

    @property
    def keys(self) -> list[str]:
        return ["src", "slot"] if self.hubs is not None else ["src"]

    def on(self, rows: DataFrame) -> _Shares:
        return _Shares(rows, self.hubs)

    def first(self) -> DataFrame:
        """Every source still has rank 1.0 in the first round: no join needed."""
        return to_targets(self.rows, F.col("share"))

    def handed(self, ranks: DataFrame) -> DataFrame:
        return spread(self.rows, ranks if self.hubs is None else in_slots(ranks, self.hubs))


def _shares(edges: DataFrame, parts: int, hub_edges: int, fold: bool, degree: DataFrame | None = None) -> _Shares:
    spark = edges.sparkSession
    hub_list = heavy_sources(edges, parts, hub_edges) if degree is None else hubs_of(degree, parts, hub_edges)
    rows = hub_list.collect()  # fewer than `parts` rows
    if not rows:
        return _Shares(edge_shares(edges, parts, fold=fold, degree=degree), None)
    hub_rows = spark.createDataFrame(rows, hub_list.schema)
    regular = edges.join(F.broadcast(hub_rows), "src", "left_anti")
    return _Shares(edge_shares(regular, parts, slotted=True, degree=degree).unionByName(hub_shares(edges, hub_rows)), hub_rows)


def _received(amounts: DataFrame, exact: bool) -> DataFrame:
    return gathered(amounts, "rank", lambda total: F.lit(CONSTANT) + F.lit(DAMPING) * total, exact)


def _ranked(edges, parts, rounds, store, cut_every, hub_edges, exact, degree=None) -> DataFrame:
    """All rounds, where shuffles have ``parts`` partitions. ``degree`` holds the out-degrees where they are written already."""
    # a plan would repeat the fold in every round; a stored edge set pays for it once
    shares = _shares(edges, parts, hub_edges, fold=store != "plan" or exact, degree=degree)
    if store == "plan" and shares.hubs is None and not exact:
        shares = _kept_in_plan(edges, out_degree(edges) if degree is None else degree, parts)
    elif store != "plan":
        placed = shares.rows if shares.hubs is None else shares.rows.repartition(parts, *shares.keys)
        shares = shares.on(target_lists(placed))
    if store == "memory":
        shares = shares.on(shares.rows.persist(StorageLevel.MEMORY_AND_DISK))
        shares.rows.count()
    elif store == "table":
        shares = shares.on(written_bucketed(shares.rows, "shares", parts, *shares.keys))

    amounts = shares.first()
    for number in range(1, rounds + 1):
        ranks = _received(amounts, exact)
        if number == rounds:
            break
        if cut_every and number % cut_every == 0:
            ranks = written_bucketed(ranks, "ranks", parts, "node")
        amounts = shares.handed(ranks)

    if store == "memory":
        ranks = written(ranks, "ranks")
        shares.rows.unpersist()
    return ranks


def _kept_in_plan(edges: DataFrame, degree: DataFrame, parts: int) -> _Shares:
    """Target lists in the plan, behind an exchange that all rounds read. The lists are made at another width, as Spark would
    take an exchange for needless, and make the lists in every round, if its rows lay so already."""
    placed = edges.repartition(parts + 1, "src").join(degree.hint("shuffle_hash"), "src")
    shares = placed.select("src", "dst", (F.lit(1.0) / F.col("out_degree")).alias("share"))
    return _Shares(target_lists(shares).repartition(parts, "src"), None)


def compact_pagerank(
    edges: DataFrame, rounds: int = ROUNDS, *, hub_edges: int = HUB_EDGES, per_row: int = NEIGHBORS_PER_ROW, exact: bool = False
) -> DataFrame:
    """Like :func:`pagerank` over gap-coded adjacency lists, bucketed on the source: a round reads a few bits an edge instead of
    two names and a share, and joins one row per list instead of one per edge. Lists of hubs are dealt to slots.
    """
    spark = edges.sparkSession
    parts = shuffle_partitions(spark)
    folded = folded_edges(edges)
    dictionary = node_dictionary(folded)
    numbered = numbered_edges(folded, dictionary)
    hub_list = heavy_sources(numbered, parts, hub_edges, copies="copies")
    hubs = spark.createDataFrame(hub_list.collect(), hub_list.schema)  # fewer than `parts` rows
    degree = numbered.groupBy("src").agg(F.sum("copies").alias("out_degree"))
    lists = gap_lists(numbered, per_row).join(degree, "src").join(F.broadcast(hubs.select("src", "slots")), "src", "left")
    slot = F.pmod("part", F.coalesce("slots", F.lit(1))).cast("int")
    lists = written_bucketed(lists.withColumn("slot", slot).drop("slots"), "lists", parts, "src", "slot")

    share = F.lit(1.0) / F.col("out_degree")
    amounts = spread_lists(lists.withColumn("share", share))
    for number in range(1, rounds + 1):
        ranks = _received(amounts, exact)
        if number == rounds:
            break
        held = in_slots(ranks, hubs)
        match = (lists.src == held.node) & (lists.slot == held.slot)
        given = lists.join(held.hint("shuffle_hash"), match)
        amounts = spread_lists(given.withColumn("share", F.col("rank") / F.col("out_degree")))
    return ranks.withColumnRenamed("node", "number").join(dictionary, "number").select("node", "rank")


def resumable_pagerank(
    edges: DataFrame,
    folder: str,
    rounds: int = ROUNDS,
    *,
    cut_every: int = 1,
    parts: int | None = None,
    hub_edges: int = HUB_EDGES,
    exact: bool = True,
) -> DataFrame:
    """Like :func:`pagerank` with ``store="table"``, where ``folder`` keeps what is finished: the edge shares, and the ranks of every
    ``cut_every``-th and of the last round. A call with the same edges goes on from the last round on record there, in this session or another,
    also for more ``rounds`` than before.

    A table counts as finished when the manifest in ``folder`` says so and its rows fit what the manifest says of them; what a lost session
    left half-written is never read. Other edges, widths or sums are another job, so one folder may serve many. Nothing is deleted.
    """
    spark = edges.sparkSession
    parts = parts or shuffle_partitions(spark)
    edges = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).select("src", "dst")
    count, total = digest(edges)
    job = json.dumps(["pagerank", edges.schema.simpleString(), count, total, parts, hub_edges, exact])
    manifest = Manifest(spark, folder, job)
    with shuffle_width(spark, parts):
        shares = _kept_shares(manifest, edges, parts, hub_edges)
        done, ranks = manifest.last("ranks", rounds) or (0, None)
        amounts = shares.handed(ranks) if done else shares.first()
        for number in range(done + 1, rounds + 1):
            ranks = _received(amounts, exact)
            if number == rounds or number % cut_every == 0:
                ranks = manifest.save(ranks, "ranks", number, parts, "node")
            amounts = shares.handed(ranks)
    return ranks


def _kept_shares(manifest: Manifest, edges: DataFrame, parts: int, hub_edges: int) -> _Shares:
    """Edge shares from the record, else made and put there; hubs are on record first, as shares lie in their slots."""
    rows, hubs = manifest.last("shares", 0), manifest.last("hubs", 0)
    if rows and hubs:
        return _Shares(rows[1], hubs[1] if hubs[1].limit(1).count() else None)
    shares = _shares(written(edges, "edges"), parts, hub_edges, fold=True)
    schema = edges.select("src").withColumns({"out_degree": F.lit(0).cast("bigint"), "slots": F.lit(0).cast("bigint")}).schema
    hubs = shares.hubs if shares.hubs is not None else edges.sparkSession.createDataFrame([], schema)
    manifest.save(hubs, "hubs", 0, 1, "src")
    return shares.on(manifest.save(shares.rows, "shares", 0, parts, *shares.keys))
