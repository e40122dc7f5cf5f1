import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from varve.functions.text import djb2
from varve.operators import compact, graph
from varve.operators.links import parse_links
from varve.operators.partitioning import place_by_word_hash, place_rows_by_word_hash
from varve.plans import pagerank as plans
from varve.plans.manifest import Manifest
from varve.plans.pagerank import pagerank, resumable_pagerank
from varve.session import file_bytes, fresh_path, planned_width, shuffle_width, written

CHAIN_AND_CYCLE = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 10), (10, 9), (10, 11)]


def brute_force(edges, rounds):
    targets = {}
    for s, d in edges:
        targets.setdefault(s, []).append(d)
    ranks = dict.fromkeys(targets, 1.0)
    for _ in range(rounds):
        got = {}
        for s, rank in ranks.items():
            for d in targets.get(s, ()):
                got[d] = got.get(d, 0.0) + rank / len(targets[s])
        ranks = {n: 0.15 + 0.85 * v for n, v in got.items()}
    return ranks


def frame(spark, edges):
    kind = "string" if edges and isinstance(edges[0][0], str) else "bigint"
    return spark.createDataFrame(edges, f"src {kind}, dst {kind}")


def ranks_of(df):
    return {r["node"]: r["rank"] for r in df.collect()}


def test_chain_dies_out_and_cycle_stays(spark):
    edges = frame(spark, CHAIN_AND_CYCLE)
    five = ranks_of(pagerank(edges, rounds=5))
    assert five == pytest.approx({9: 0.3660055859375, 10: 0.50824843749, 11: 0.3660055859375})
    one = ranks_of(pagerank(edges, rounds=1))
    assert one == pytest.approx({2: 1.0, 3: 1.0, 4: 1.0, 5: 1.0, 10: 1.0, 9: 0.575, 11: 0.575})


def test_acyclic_graph_ends_empty(spark):
    edges = frame(spark, [("o1", "c1"), ("o2", "c1"), ("o3", "c2")])
    assert pagerank(edges, rounds=2).count() == 0


def test_parallel_edges_and_self_loop(spark):
    ranks = ranks_of(pagerank(frame(spark, [("a", "b"), ("a", "b"), ("a", "c"), ("d", "d")]), rounds=1))
    assert ranks == pytest.approx({"b": 0.15 + 0.85 * 2 / 3, "c": 0.15 + 0.85 / 3, "d": 1.0})
    degree = {r["src"]: r["out_degree"] for r in graph.out_degree(frame(spark, [("a", "b"), ("a", "b"), ("a", "c")])).collect()}
    assert degree == {"a": 3}


@pytest.fixture(scope="module")
def hub_graph():
    """A third of all edges leave node 0, a third of the rest is one repeated edge."""
    rng = random.Random(11)
    edges = [(0, rng.randint(0, 80)) for _ in range(400)] + [(7, 8)] * 260
    edges += [(rng.randint(1, 80), rng.randint(0, 80)) for _ in range(540)]
    return edges


@pytest.mark.parametrize(
    "how",
    [
        {"store": "plan"},
        {"store": "memory"},
        {"store": "table"},
        {"store": "table", "cut_every": 2},
        {"store": "memory", "cut_every": 3},
        {"store": "table", "parts": 5},
        {"store": "table", "hub_edges": 1},
        {"store": "memory", "hub_edges": 1},
        {"store": "plan", "hub_edges": 1, "parts": 3},
    ],
    ids=str,
)
def test_variants_agree_with_brute_force(spark, hub_graph, how):
    got = ranks_of(pagerank(frame(spark, hub_graph), rounds=4, **how))
    assert got == pytest.approx(brute_force(hub_graph, 4))


def test_a_lazy_plan_refuses_to_be_cut(spark, hub_graph):
    with pytest.raises(ValueError):
        pagerank(frame(spark, hub_graph), rounds=4, store="plan", cut_every=2)


def test_any_number_of_parts_costs_one_exchange_per_round_and_no_sort(spark, hub_graph, monkeypatch):
    texts = []
    from varve.plans import pagerank as module

    def spy(df, label, *more):
        if label == "ranks":
            texts.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, label, *more)

    from varve.session import written

    monkeypatch.setattr(module, "written", spy)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ranks_of(pagerank(frame(spark, hub_graph), rounds=5, store="table", parts=150))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == pytest.approx(brute_force(hub_graph, 5))
    assert spark.conf.get("spark.sql.shuffle.partitions") != "150"
    (text,) = texts
    assert text.count("Exchange hashpartitioning") == 5 and text.count(", 150)") >= 5
    assert text.count("Sort [") == 0 and text.count("ShuffledHashJoin") == 4


def test_hubs_are_few_and_found(spark, hub_graph):
    rows = graph.hubs(frame(spark, hub_graph), 8, at_least=1).collect()
    found = {r["src"]: r["out_degree"] for r in rows}
    assert all(r["slots"] == -(-r["out_degree"] // 150) for r in rows)
    degree = {s: sum(1 for a, _ in hub_graph if a == s) for s in (0, 7)}
    assert found == degree
    assert len(found) < 8


@pytest.mark.parametrize("parts, at_least", [(8, 1), (3, 1), (50, 1), (8, 300), (2, 10_000)])
def test_heavy_sources_are_the_hubs(spark, hub_graph, parts, at_least):
    edges = frame(spark, hub_graph)
    want = sorted(map(tuple, graph.hubs(edges, parts, at_least).collect()))
    assert sorted(map(tuple, graph.heavy_sources(edges, parts, at_least).collect())) == want
    folded = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies"))
    assert sorted(map(tuple, graph.heavy_sources(folded, parts, at_least, copies="copies").collect())) == want


def test_heavy_sources_exchange_only_suspects(spark):
    edges = written(frame(spark, [(0, i) for i in range(500)] + [(i, 0) for i in range(1, 20_001)]), "edges")
    found = graph.heavy_sources(edges, 50, at_least=400)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.index("BroadcastHashJoin") > text.index("Exchange hashpartitioning(src")  # the sieve stands below the exchange
    assert [tuple(r)[:2] for r in found.collect()] == [(0, 500)]
    # of 20,000 sources about one in SIEVE shares a bucket with the hub
    counted = edges.where(F.pmod(F.xxhash64("src"), F.lit(graph.SIEVE * 50)) == F.pmod(F.xxhash64(F.lit(0).cast("bigint")), F.lit(graph.SIEVE * 50)))
    assert counted.select("src").distinct().count() < 40


def test_no_heavy_sources(spark):
    assert graph.heavy_sources(frame(spark, []), 8).count() == 0
    assert graph.heavy_sources(frame(spark, [(i, 0) for i in range(100)]), 8, at_least=1).count() == 0


def test_contributions_read_the_edges_once(spark, hub_graph, monkeypatch):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    edges = frame(spark, hub_graph).mapInArrow(seen, "src bigint, dst bigint")
    ranks = graph.first_ranks(frame(spark, hub_graph))
    graph.rank_contributions(edges, ranks).collect()
    assert reads.value == len(hub_graph)


def test_exact_ranks_are_the_same_bit_for_bit(spark, hub_graph):
    edges = written(frame(spark, hub_graph), "edges")
    variants = [
        {"parts": 4}, {"parts": 8}, {"parts": 150}, {"store": "memory"}, {"store": "plan"}, {"cut_every": 2},
        {"hub_edges": 1}, {"hub_edges": 1, "parts": 5, "store": "memory"},
    ]
    found = [ranks_of(pagerank(edges, rounds=6, exact=True, **how)) for how in variants]
    assert all(f == found[0] for f in found)
    assert found[0] == pytest.approx(brute_force(hub_graph, 6))


def test_contributions_are_exact_sums(spark):
    # a tenth from each of ten, and the reverse of it: only a sum that is rounded once is 1
    edges = frame(spark, [(i, j) for i in range(10) for j in range(10)])
    ranks = spark.createDataFrame([(i, 1.0) for i in range(10)], "node bigint, rank double")
    got = {r["contribution"] for r in graph.rank_contributions(edges, ranks, exact=True).collect()}
    assert got == {math.fsum([0.1] * 10)}


class Lost(Exception):
    pass


@pytest.mark.parametrize("hub_edges", [1_000_000, 1])
def test_a_new_session_resumes_at_the_last_whole_round(spark, hub_graph, monkeypatch, hub_edges):
    folder = fresh_path(spark, "job")
    save = Manifest.save
    saved = []

    def failing(self, df, kind, number, buckets, *keys):
        if kind == "ranks" and number == 7:
            # a table that was begun, and the session that wrote it is gone
            df.limit(3).write.parquet(f"{folder}/ranks-7-begun")
            raise Lost
        saved.append((kind, number))
        return save(self, df, kind, number, buckets, *keys)

    how = {"rounds": 10, "cut_every": 1, "hub_edges": hub_edges}
    monkeypatch.setattr(Manifest, "save", failing)
    with pytest.raises(Lost):
        resumable_pagerank(frame(spark, hub_graph), folder, **how)
    assert saved == [("hubs", 0), ("shares", 0)] + [("ranks", n) for n in range(1, 7)]

    monkeypatch.setattr(Manifest, "save", lambda self, df, kind, number, *more: saved.append((kind, number)) or save(self, df, kind, number, *more))
    saved.clear()
    other = spark.newSession()
    got = ranks_of(resumable_pagerank(frame(other, hub_graph), folder, **how))
    assert saved == [("ranks", n) for n in range(7, 11)]  # nothing before round 7 was done again
    assert got == ranks_of(pagerank(frame(spark, hub_graph), exact=True, hub_edges=hub_edges))
    saved.clear()
    assert ranks_of(resumable_pagerank(frame(other, hub_graph), folder, **how)) == got and not saved


def test_damaged_tables_are_passed_over(spark, hub_graph):
    folder = fresh_path(spark, "job")
    edges = frame(spark, hub_graph)
    want = ranks_of(resumable_pagerank(edges, folder, rounds=4))
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{folder}/manifest").collect()]
    paths = {x["number"]: x["path"] for x in lines if x["kind"] == "ranks"}
    # one row more in the last table, and files that are no parquet in the one before
    spark.createDataFrame([(-1, 1.0)], "node bigint, rank double").coalesce(1).write.mode("append").parquet(paths[4])
    spark.createDataFrame([("no table",)], "value string").write.mode("overwrite").text(paths[3])
    manifest = Manifest(spark, folder, lines[0]["job"])
    assert manifest.last("ranks", 4)[0] == 2
    assert ranks_of(resumable_pagerank(edges, folder, rounds=4)) == want


def test_other_edges_are_another_job(spark, hub_graph):
    folder = fresh_path(spark, "job")
    resumable_pagerank(frame(spark, hub_graph), folder, rounds=3)
    other = hub_graph[1:]
    assert ranks_of(resumable_pagerank(frame(spark, other), folder, rounds=3)) == pytest.approx(brute_force(other, 3))
    # fewer rounds than are on record
    assert ranks_of(resumable_pagerank(frame(spark, other), folder, rounds=2)) == pytest.approx(brute_force(other, 2))


def test_width_follows_the_bytes(spark, monkeypatch):
    edges = written(frame(spark, [(i, i * 7919 % 100_003) for i in range(100_000)]).repartition(4), "edges")
    size = file_bytes(edges)
    assert size == sum(f.length() for f in spark._jvm.java.io.File(edges.inputFiles()[0][7:]).getParentFile().listFiles() if f.getName().endswith(".parquet"))
    assert planned_width(edges) == min(spark.sparkContext.defaultParallelism, -(-size // (1 << 20)))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        assert planned_width(edges) == -(-size // 16384)
        seen = []
        monkeypatch.setattr(plans, "shuffle_width", lambda s, n: seen.append(n) or shuffle_width(s, n))
        pagerank(edges, rounds=2, parts="data")
        pagerank(edges, rounds=2, parts=150)
        assert seen == [-(-file_bytes(edges) // 16384), 150] or abs(seen[0] - size / 16384) < 0.3 * seen[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_width_follows_the_number_of_edges(spark, monkeypatch):
    # few names over and over: a file far smaller than its rows
    pairs = [("a" * 20, "b"), ("b", "a" * 20), ("b", "c")] * 300
    edges = written(frame(spark, pairs), "edges")
    assert planned_width(edges) == 1
    seen = []
    monkeypatch.setattr(plans, "shuffle_width", lambda s, n: seen.append(n) or shuffle_width(s, n))
    monkeypatch.setattr(plans, "EDGES_PER_PART", 100)
    assert ranks_of(pagerank(edges, rounds=2, parts="data")) == pytest.approx(brute_force(pairs, 2))
    assert seen == [9]


def test_no_slot_holds_a_whole_hub(spark):
    edges = frame(spark, [(0, i) for i in range(4000)] + [(i, 0) for i in range(1, 4001)])
    hub_rows = graph.hubs(edges, 8, at_least=1)
    sizes = [r["count"] for r in graph.hub_shares(edges, hub_rows).groupBy("src", "slot").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1200 and sum(sizes) == 4000


def test_hub_rounds_move_ranks_not_edges(spark, hub_graph):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pagerank(frame(spark, hub_graph), rounds=4, store="table", hub_edges=1)
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Bucketed: true") == 3
    assert text.count("Exchange hashpartitioning(node") == 3  # ranks, in their slots
    assert text.count("Exchange hashpartitioning(dst") == 4  # amounts
    assert text.count("Exchange hashpartitioning") == 7


def test_lazy_plan_exchanges_edges_once_and_counts_degrees_once(spark, hub_graph):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pagerank(frame(spark, hub_graph), rounds=4, store="plan")
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in text and "Sort [" not in text
        assert text.count("Exchange hashpartitioning(dst") == 4
        assert plan.count() == len(brute_force(hub_graph, 4))
        run = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the rest are the edges and the degrees, again and again the same exchange
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", text)) == {"src", "dst"}
    assert run.count("ReusedExchange") > 0 or "AdaptiveSparkPlan" in run


def as_names(edges):
    return [(f"node {s}", f"node {d}") for s, d in edges]


def test_rounds_over_names_go_by_numbers_and_read_the_source_twice(spark, hub_graph, monkeypatch):
    reads, kinds = spark.sparkContext.accumulator(0), []
    received = plans._received
    monkeypatch.setattr(plans, "_received", lambda amounts, exact: kinds.append(amounts.schema["dst"].dataType.simpleString()) or received(amounts, exact))

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    edges = as_names(hub_graph)
    got = ranks_of(pagerank(frame(spark, edges).mapInArrow(seen, "src string, dst string"), rounds=4, store="plan"))
    assert got == pytest.approx(brute_force(edges, 4))
    assert set(kinds) == {"bigint"} and reads.value == 2 * len(edges)


def test_lazy_plan_makes_its_lists_once(spark, hub_graph):
    edges = as_names(hub_graph)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pagerank(frame(spark, edges), rounds=6, store="plan")
        assert ranks_of(plan) == pytest.approx(brute_force(edges, 6))
        run = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert 1 <= run.count("functions=[collect_list(dst") <= 2  # once, in two steps at most


@pytest.mark.parametrize(
    "how",
    [
        {"store": "plan"}, {"store": "memory"}, {"store": "table"}, {"cut_every": 2}, {"parts": 5}, {"parts": "data"}, {"exact": True},
        {"hub_edges": 1}, {"store": "memory", "hub_edges": 1}, {"store": "plan", "hub_edges": 1}, {"store": "plan", "exact": True},
    ],
    ids=str,
)
@pytest.mark.parametrize("clash", [False, True])
def test_names_agree_with_brute_force_also_where_numbers_clash(spark, hub_graph, monkeypatch, how, clash):
    if clash:
        for module in (graph, plans):
            monkeypatch.setattr(module, "name_number", lambda name: F.length(name).cast("bigint"))
    edges = as_names(hub_graph)
    holes = frame(spark, [*edges, (None, "node 1"), ("node 2", None)])
    assert ranks_of(pagerank(holes, rounds=3, **how)) == pytest.approx(brute_force(edges, 3))


def test_target_lists_hold_all_edges_in_rows_of_bounded_length(spark, hub_graph):
    edges = frame(spark, [(-1, i) for i in range(4000)] + hub_graph)
    shares = written(graph.edge_shares(edges, 8), "shares")
    lists = graph.target_lists(shares, per_row=100)
    assert max(len(r["targets"]) for r in lists.collect()) < 200
    again = lists.select("src", F.explode("targets").alias("dst"), "share")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, shares.collect()))
    known = graph.edge_shares(edges, 8, degree=graph.out_degree(edges))
    assert sorted(map(tuple, known.collect())) == sorted(map(tuple, shares.collect()))


@pytest.mark.parametrize("hub_edges", [1, 1_000_000])
def test_stored_shares_are_lists_and_made_without_a_window(spark, hub_graph, monkeypatch, hub_edges):
    edges, seen = as_names(hub_graph), []
    keep = plans.written_bucketed

    def spy(df, label, *more):
        seen.append((label, df.count(), df._jdf.queryExecution().executedPlan().toString()))
        return keep(df, label, *more)

    monkeypatch.setattr(plans, "written_bucketed", spy)
    assert ranks_of(pagerank(frame(spark, edges), rounds=3, hub_edges=hub_edges)) == pytest.approx(brute_force(edges, 3))
    ((label, rows, text),) = seen
    assert label == "shares" and rows < len(set(edges)) / 2 and "Window" not in text


def test_stored_edges_leave_one_exchange_per_round(spark, hub_graph):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pagerank(frame(spark, hub_graph), rounds=6, store="table")
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 6
    assert text.count("Bucketed: true") == 5


def test_adjacency_list_splits_hubs(spark, hub_graph):
    rows = graph.adjacency_list(frame(spark, hub_graph), per_row=10).collect()
    assert max(len(r["neighbors"]) for r in rows) == 10
    assert len([r for r in rows if r["src"] == 0]) > 1
    back = sorted((r["src"], n["dst"]) for r in rows for n in r["neighbors"] for _ in range(n["copies"]))
    assert back == sorted(hub_graph)


def test_contributions_of_any_ranks(spark, hub_graph):
    edges = frame(spark, hub_graph)
    got = {r["node"]: r["contribution"] for r in graph.rank_contributions(edges, graph.first_ranks(edges)).collect()}
    want = {n: (v - 0.15) / 0.85 for n, v in brute_force(hub_graph, 1).items()}
    assert got == pytest.approx(want)


def test_source_only_nodes(spark):
    nodes = graph.source_only_nodes(frame(spark, [("a", "b"), ("b", "c"), ("a", "c"), ("d", "a")]))
    assert [tuple(r) for r in nodes.collect()] == [("d", 0.0)]


@pytest.mark.parametrize(
    "line, by_line, by_field",
    [
        ("a\tb", True, True),
        ("a\tcategory:b", False, True),
        ("category:a\tb", True, True),
        ("category:a\thelp:b", True, False),
        ("talk:a\tb", False, False),
        ("Category:A\tB", True, True),
    ],
)
def test_namespace_table(spark, line, by_line, by_field):
    lines = spark.createDataFrame([(line,)], "value string")
    assert bool(parse_links(lines, "line").count()) == by_line
    assert bool(parse_links(lines, "field").count()) == by_field


def test_only_the_first_tab_splits(spark):
    lines = spark.createDataFrame([("A\tb\tc",), ("a\t",), ("\tb",), ("notab",), ("# x\ty",)], "value string")
    got = sorted(tuple(r) for r in parse_links(lines).collect())
    assert got == [("", "b"), ("# x", "y"), ("a", ""), ("a", "b\tc")]
    assert parse_links(lines, comment="#").count() == 3


@pytest.mark.parametrize("text, value", [("", 5381), ("a", 177670), ("hello world", 894552257), ("émile 😀", 426648373)])
def test_djb2(spark, text, value):
    assert spark.createDataFrame([(text,)], "k string").select(djb2(F.col("k"))).first()[0] == value


def test_word_hash_places_rows(spark):
    df = spark.createDataFrame([(f"w{i}",) for i in range(500)], "k string")
    placed = place_by_word_hash(df, "k", 13)
    assert placed.where(F.spark_partition_id() != F.col("part")).count() == 0
    assert placed.select("part").distinct().count() == 13


@pytest.mark.parametrize("rows", [0, 1, 3000])
def test_a_hot_word_partition_is_spread(spark, rows):
    words = ["hot" if i % 3 == 0 else f"w{i % 40}" for i in range(rows)]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "k string, i int").repartition(4)
    placed = place_rows_by_word_hash(df, "k", 13).withColumn("on", F.spark_partition_id())
    got = placed.collect()
    assert sorted((r["k"], r["i"]) for r in got) == sorted((w, i) for i, w in enumerate(words))
    want = {r["k"]: r["h"] % 13 for r in df.select("k", djb2(F.col("k")).alias("h")).collect()}
    assert all(r["part"] == want[r["k"]] for r in got)
    assert len({(r["part"], r["slot"]) for r in got}) == len({r["on"] for r in got}) <= 39
    if rows > 1:
        sizes = [sum(r["on"] == p for r in got) for p in {r["on"] for r in got}]
        assert max(sizes) < 2 * sum(sizes) / len(sizes)
        assert len({r["slot"] for r in got if r["k"] == "hot"}) >= 8


@pytest.mark.parametrize("how", [{}, {"hub_edges": 1, "per_row": 7}, {"exact": True, "per_row": 3}], ids=str)
def test_compact_lists_give_the_same_ranks(spark, hub_graph, how):
    names = [(f"page {s:03}", f"page {d:03}") for s, d in hub_graph]
    for edges in (hub_graph, names, CHAIN_AND_CYCLE):
        got = ranks_of(plans.compact_pagerank(frame(spark, edges), rounds=4, **how))
        assert got == pytest.approx(brute_force(edges, 4))
    assert plans.compact_pagerank(frame(spark, [("a", "b")]), rounds=2).count() == 0


def test_gap_lists_hold_the_edges_in_fewer_bytes(spark):
    rng = random.Random(4)
    edges = frame(spark, [(f"Category:Page_{rng.randrange(3_000)}", f"Page_{int(rng.paretovariate(0.7)) % 3_000}") for _ in range(60_000)])
    folded = graph.folded_edges(edges)
    dictionary = compact.node_dictionary(folded)
    numbered = compact.numbered_edges(folded, dictionary)
    lists = written(compact.gap_lists(numbered, per_row=50), "lists")
    assert lists.agg(F.max(F.size("gaps"))).first()[0] <= 50
    back = compact.spread_lists(lists.withColumn("share", F.lit(1.0))).groupBy("dst").agg(F.sum("amount").alias("n"))
    want = numbered.groupBy("dst").agg(F.sum("copies").cast("double").alias("n"))
    assert back.exceptAll(want).count() == 0 and back.count() == want.count()
    shares = written(graph.edge_shares(folded, 8), "shares")
    assert file_bytes(lists) < 0.7 * file_bytes(shares)  # 0.62


def test_numbering_sorts_no_edges_and_gaps_take_one_pass(spark, monkeypatch):
    edges = frame(spark, [(f"n{i % 7}", f"m{i}") for i in range(200)] + [("n1", "m1"), ("n1", "m1"), ("n0", "n1")])
    folded = graph.folded_edges(edges)
    dictionary = compact.node_dictionary(folded)
    numbered = compact.numbered_edges(folded, dictionary)
    lists = compact.gap_lists(numbered, per_row=20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(compact, "written", lambda df, label: df if df.collect() else None)
        plan = compact.numbered_edges(folded, dictionary)._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Sort [" not in plan and plan.count("ShuffledHashJoin") == 2
    # a lambda that looks into the whole list would make its cost the square of the list's length
    lambdas = re.findall(r"lambdafunction\((.*?), lambda", lists._jdf.queryExecution().optimizedPlan().toString())
    assert lambdas and not [f for f in lambdas if "neighbors" in f or "_dst" in f]
    targets = {}
    for src, dst, copies in numbered.collect():
        targets.setdefault(src, []).append((dst, copies))
    got = {}
    for r in sorted(lists.collect(), key=lambda r: (r["src"], r["part"])):
        assert r["gaps"][0] == 0
        place = r["first"]
        for i, gap in enumerate(r["gaps"]):
            place += gap
            got.setdefault(r["src"], []).append((place, r["copies"][i] if r["copies"] else 1))
    assert got == {src: sorted(found) for src, found in targets.items()}
