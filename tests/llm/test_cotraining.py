from varve.llm import cotraining as C
from varve.llm import queries as Q

from .data import frame, rows_by, table


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = rows_by(C.classify(docs, labels.where("doc_id % 3 <> 0"), rounds=1).drop("text"))
    assert len(got) == 1000
    held = labels.where("doc_id % 3 = 0").collect()
    right = sum(got[r["doc_id"]]["kept"] == bool(r["quality"]) for r in held)
    assert right >= 0.9 * len(held)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = rows_by(Q.op10_quality_classifier(spark, sf_dir))
    labels = table("labels", sf_dir)
    assert len(got) == len(table("documents", sf_dir))
    assert sum(got[i]["kept"] == bool(q) for i, q in zip(labels.doc_id, labels.quality)) >= 0.8 * len(labels)


def test_pseudo_labels(spark):
    rows = [(1, 0.99, 0.5), (2, 0.97, 0.5), (3, 0.96, 0.5), (4, 0.5, 0.01), (5, 0.99, 0.01), (6, 0.5, 0.5), (7, None, 0.5)]
    taught = C._pseudo_labels(frame(spark, rows, "doc_id bigint, text_p double, meta_p double"), 2, 0)
    assert sorted(map(tuple, taught.collect())) == [(1, 1, "meta"), (2, 1, "meta"), (4, 0, "text")]


def test_edges(spark):
    rows = [(1, None, None, None, 1), (2, "", "en", -5, 1), (2, "", "en", -5, 1), (None, "text " * 100_000, "en", 9, 1)]
    docs = frame(spark, rows, "doc_id bigint, text string, lang string, n_chars bigint, meta int")
    none = frame(spark, [], "doc_id bigint, quality int")
    got = C.classify(docs, none, rounds=1).collect()
    assert len(got) == 4 and {r["quality_score"] for r in got} == {got[0]["quality_score"]}
    assert all(r["kept"] for r in got)
    assert C.classify(docs.limit(0), none, rounds=1).count() == 0
