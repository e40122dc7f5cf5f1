import pytest

from varve.llm import decontamination as D
from varve.llm import queries as Q

from .brute import contamination, sha
from .data import SF_DIR, frame, pairs, rows_by, table


def test_query_against_brute_force(spark):
    expected = contamination(pairs(table("documents")), pairs(table("benchmark"), "item_id"))
    got = rows_by(Q.op1_decontamination(spark, SF_DIR))
    assert len(got) == len(expected)
    for name, (n_words, n_hit, items) in expected.items():
        row = got[name]
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (n_words, n_hit, len(items))
        assert row["items_sha256"] == sha(",".join(items).encode())
        assert row["contaminated"] == (n_hit > 0 and 20 * n_hit >= n_words)
    assert any(r["contaminated"] for r in got.values())


SHORT = [(1, "a b a b c"), (2, "b c"), (3, "A-B c"), (4, None), (5, ""), (6, "x"), (7, "b c"), (None, "q r")]
DOCS = [(1, "a b a b c d"), (2, None), (3, ""), (4, "zz B,C zz x"), (5, "c b a"), (6, "q r q"), (6, "q r q"), (7, "a b c b")]


@pytest.mark.parametrize("window, block_words", [(3, 1000), (3, 2), (13, 1000), (1, 1)])
def test_small_cases_in_one_and_many_blocks(spark, window, block_words):
    docs = frame(spark, [(i, t, "extra") for i, t in DOCS], "doc_id bigint, text string, items string")
    items = frame(spark, SHORT, "item_id bigint, text string")
    marked = D.mark(docs, items, window, block_words).withColumn("n_hit", D.n_hit())
    expected = contamination(DOCS, SHORT, window)
    got = marked.collect()
    assert len(got) == len(DOCS)
    for row in got:
        assert (row["n_words"], row["n_hit"], row["items"]) == expected[row["doc_id"]], row


def test_empty_tables_and_long_text(spark):
    items = frame(spark, SHORT, "item_id bigint, text string")
    docs = frame(spark, DOCS)
    assert D.mark(docs.limit(0), items).count() == 0
    assert all(r["spans"] == [] for r in D.mark(docs, items.limit(0)).collect())
    long = frame(spark, [(1, "k " * 300_000 + "a b c")])
    assert D.mark(long, items, 3).first()["spans"] == [[300_000, 300_003]]


def test_removal(spark):
    items = frame(spark, [(1, "alpha beta gamma")], "item_id bigint, text string")
    docs = frame(spark, [(1, "Alpha, beta gamma! rest"), (2, "alpha beta"), (3, None), (4, "w " * 100 + "alpha beta gamma")])
    cut = {r["doc_id"]: r["text"] for r in D.without_spans(D.mark(docs, items, 3)).collect()}
    assert cut == {1: "! rest", 2: "alpha beta", 3: None, 4: "w " * 100}
    kept = D.decontaminate(docs, items)
    assert kept.columns == ["doc_id", "text"]
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {2: "alpha beta", 3: None, 4: "w " * 100 + "alpha beta gamma"}
