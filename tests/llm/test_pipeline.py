import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline as P
from varve.llm import bpe, toxicity

from .brute import components, contamination, repeated_words
from .data import pairs, table

SF_DIR = "/root/testdata/sf0.01"  # the smallest with enough labels


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    results = []
    for _, stage in P.STAGES:
        docs = P.written(stage(spark, docs, SF_DIR), "stage")
        results.append(docs)
    frames = [r.toPandas().sort_values("doc_id") for r in results]
    assert all(list(r.columns) == columns for r in results[:-1])

    tagged = toxicity.tag_documents(spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    clean = {r["doc_id"] for r in tagged.where("predicted = 0").collect()}
    assert set(frames[0].doc_id) == clean and 800 < len(clean) < 1000

    linked = components(pairs(frames[0]))
    assert frames[1].doc_id.tolist() == sorted(k for k, (_, c) in linked.items() if k == c)
    assert len(frames[1]) < len(frames[0])

    kept = repeated_words(pairs(frames[1]))
    assert frames[2].doc_id.tolist() == frames[1].doc_id.tolist()
    for (name, text), before, chars in zip(pairs(frames[2]), frames[1].text, frames[2].n_chars):
        n, words = kept[name]
        assert text.split() == words if len(words) < n else text == before
        assert chars == len(text)

    judged = contamination(pairs(frames[2]), pairs(table("benchmark", SF_DIR), "item_id"))
    left = [k for k, (n, hit, _) in judged.items() if not (hit and 20 * hit >= n)]
    assert frames[3].doc_id.tolist() == sorted(left)

    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(P.RANKS)), special_tokens={}
    )
    for text, ids, n in zip(frames[4].text, frames[4].ids, frames[4].n_tokens):
        assert list(ids) == library.encode_ordinary(text) and n == len(ids)

    whole = registry.queries()["pipeline"](spark, SF_DIR).toPandas().sort_values("doc_id")
    assert whole.doc_id.tolist() == frames[4].doc_id.tolist() and whole.text.tolist() == frames[4].text.tolist()


def through_all_stages(spark, docs):
    out = []
    for _, stage in P.STAGES:
        docs = P.written(stage(spark, docs, SF_DIR), "stage")
        out.append(docs)
    return out


def test_nulls_repeated_rows_long_texts_and_clashing_names(spark):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = ["doc", "spans", "predicted", "score", "kept", "n_words", "n_removed", "component", "hash", "items", "tokens"]
    long = " ".join(f"w{i}" for i in range(60_000))
    odd = [(None, None), (None, ""), (900_001, None), (900_002, ""), (900_003, " \n"), (900_004, long), (900_004, long)]
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], given.schema)
    first = given.orderBy("doc_id").limit(200)
    docs = first.unionByName(first.limit(50)).unionByName(odd)
    docs = P.written(docs.select("*", *[F.lit(f"own {n}").alias(n) for n in names]), "docs")
    results = through_all_stages(spark, docs)
    for frame in results:
        assert frame.columns[: len(docs.columns)] == docs.columns or frame is results[-1]
        rows = frame.collect()
        # rows of no words stay; the others of one id are one document from the second stage on
        assert sorted(str(r["text"]) for r in rows if r["doc_id"] is None) == ["", "None"]
        assert {900_001, 900_002, 900_003, 900_004} <= {r["doc_id"] for r in rows}
        assert all(r[n] == f"own {n}" for r in rows for n in names)
        if frame is not results[0]:
            ids = [r["doc_id"] for r in rows if r["doc_id"] is not None]
            assert len(ids) == len(set(ids))
    assert results[0].where("doc_id = 900004").count() == 2
    encoded = {r["doc_id"]: r for r in results[-1].collect()}
    assert encoded[900_001]["n_tokens"] == encoded[900_002]["n_tokens"] == 0 and encoded[900_004]["text"] == long


def test_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    results = through_all_stages(spark, docs)
    assert [r.count() for r in results] == [0] * 5
    assert all(r.columns == docs.columns for r in results[:-1])


def test_every_operator_is_registered():
    names = [n for n in registry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
