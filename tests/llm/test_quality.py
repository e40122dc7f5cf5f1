
from varve.llm import queries as Q
from varve.llm import quality as R

from .brute import quality_counts
from .data import SF_DIR, frame, pairs, rows_by, table


def test_query_counts_against_brute_force_and_labels(spark):
    got = rows_by(Q.op5_quality_rules(spark, SF_DIR))
    docs = pairs(table("documents"))
    assert len(got) == len(docs)
    for name, text in docs:
        counts = quality_counts(text)
        assert tuple(got[name][n] for n in R.COUNTS) == counts, name
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert got[name]["base_failed"] == failed
        assert not (failed and got[name]["kept"])
    labels = table("labels")
    judged = [(got[i]["quality_score"] >= 0.5) == bool(q) for i, q in zip(labels.doc_id, labels.quality)]
    assert sum(judged) >= 0.95 * len(judged)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = rows_by(R.judge(docs, labels.where("doc_id % 3 <> 0")).select("doc_id", "quality_score"))
    held = [r for r in labels.where("doc_id % 3 = 0").collect()]
    right = sum((got[r["doc_id"]]["quality_score"] >= 0.5) == bool(r["quality"]) for r in held)
    assert right >= 0.9 * len(held)


ODD = [None, "", " \t\n ", "a", "a b c a b c", "x\n\nx\nx", "  x\n  x\n x", "#*$%&|<> é€😀", "w " * 200, "a\x00b c d", "one two three\rfour\x0bfive"]


def test_odd_texts_without_labels(spark):
    rows = [(i, t, 1.0) for i, t in enumerate(ODD)] + [(3, "a", 1.0), (None, "b", 2.0)]
    docs = frame(spark, rows, "doc_id bigint, text string, kept double")
    labels = frame(spark, [(1, 1), (None, 0)], "doc_id bigint, quality int")
    got = R.judge(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[n] for n in R.COUNTS) == quality_counts(r["text"])
        assert r["quality_score"] == 1.0 and r["kept"] == (not r["base_failed"])
    assert R.judge(docs.limit(0), labels).count() == 0


def test_long_text(spark):
    text = " ".join(f"w{i % 5000}" for i in range(200_000))
    row = R.judge(frame(spark, [(1, text)]), frame(spark, [], "doc_id bigint, quality int")).first()
    assert (row["n_words"], row["n_repeat_words"], row["base_failed"]) == (200_000, 200_000, True)
