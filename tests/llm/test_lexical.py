import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from varve.llm import lexical

SCHEMA = "doc_id bigint, text string"


def search(spark, docs, items, k=20, schema=SCHEMA, parts=3):
    index = lexical.build_index(spark.createDataFrame(docs, schema).repartition(parts))
    found = lexical.search(index, spark.createDataFrame(items, "item_id bigint, text string"), k)
    return sorted(map(tuple, found.collect()), key=lambda r: (r[0] is not None, r))


def corpus(rnd, count, vocabulary):
    weights = [1 / (i + 1) for i in range(vocabulary)]
    text = lambda n: " ".join(f"T{i}" for i in rnd.choices(range(vocabulary), weights, k=n))
    return [(i, text(rnd.choice([0, 1, 3, 20, 200]))) for i in range(count)]


@pytest.mark.parametrize("segment, block", [(8_000_000, 200_000), (400, 30)])
def test_equals_brute_force(spark, monkeypatch, segment, block):
    monkeypatch.setattr(lexical, "QUERY_TERMS", block)
    monkeypatch.setattr(lexical, "SEGMENT_BYTES", segment)
    rnd = random.Random(3)
    docs, items = corpus(rnd, 300, 40), corpus(rnd, 25, 60)
    for k in (1, 7, 1000):
        assert search(spark, docs, items, k) == brute.ranked(docs, items, k)


def test_terms(spark):
    docs = [(1, "Ab-c ÉT_a9 b"), (2, "ab c Ét"), (3, "éT")]
    items = [(1, "AB"), (2, "éT"), (3, "a9 b"), (4, "_ -!")]
    got = search(spark, docs, items)
    assert got == brute.ranked(docs, items, 20)
    # only A-Z are lowered, and a no-break space is part of a term
    assert [r[:3] for r in got if r[0] > 1] == [(2, 1, 3), (3, 1, 1)]


def test_ties_repeats_nulls_and_clashing_names(spark):
    docs = [(None, "x y", 1), (5, "x y", 2), (5, "x y", None), (2, "y x", 4), (9, None, 5), (8, "", 6), (None, None, 7)]
    items = [(1, "x x"), (1, "x"), (None, "y"), (7, None), (8, ""), (9, "unknown")]
    got = search(spark, docs, items, k=3, schema="doc_id bigint, text string, ids int")
    by_item = {}
    for item, rank, doc, score in got:
        assert score > 0
        by_item.setdefault(item, []).append((rank, doc))
    assert sorted(by_item[1]) == sorted([(1, 2), (2, 5), (3, 5)] * 2)
    assert by_item[None] == [(1, 2), (2, 5), (3, 5)]
    assert set(by_item) == {1, None}
    everything = search(spark, docs, items[1:2], k=9, schema="doc_id bigint, text string, ids int")
    assert [r[2] for r in everything] == [2, 5, 5, None]


def test_empty_tables(spark):
    assert search(spark, [], [(1, "x")]) == []
    assert search(spark, [(1, None), (2, "!")], [(1, "x")]) == []
    assert search(spark, [(1, "x")], []) == []


def test_long_texts(spark):
    docs = [(1, "a " * 300_000), (2, "a b"), (3, "b " * 10), (4, "c")]
    items = [(1, "a b"), (2, "b " * 50_000)]
    assert search(spark, docs, items) == brute.ranked(docs, items, 20)


def test_strata_below_the_threshold_are_not_visited(spark):
    visited = []

    class Counted(lexical._Best):
        def _take(self, number, score, ids, empty):
            visited.append((score > 0).sum())
            super()._take(number, score, ids, empty)

    # a hundred strata of which those of short texts alone can win
    docs = [(i, "needle " + "hay " * (1 + i % 100)) for i in range(2_000)]
    index = lexical.build_index(spark.createDataFrame(docs, SCHEMA).coalesce(1))
    rows = index.rows.where("term is null or term = 'needle'").selectExpr("*", "if(term is null, -1, 0) AS number")
    parts = rows.orderBy("segment", "number").toArrow().to_batches()
    best = Counted(*(lexical.np.array([x]) for x in (0, 0, 700)), 5)
    for part in lexical._segments(iter(parts)):
        best.visit(*lexical._joined(part))
    assert sum(visited) < 1000  # of 2,000
    assert best.top[0][1].tolist() == [0, 100, 200, 300, 400]


def test_index_holds_every_document(spark):
    docs = [(i, f"w{i} common") for i in range(500)]
    index = lexical.build_index(spark.createDataFrame(docs, SCHEMA).repartition(4))
    assert (index.documents, index.terms) == (500, 1000)
    ids = index.rows.where("term is null").select(F.explode("ids").alias("id"))
    assert sorted(r.id for r in ids.collect()) == list(range(500))
    assert index.rows.where("term = 'common'").agg(F.sum(F.size("docs"))).first()[0] == 500
