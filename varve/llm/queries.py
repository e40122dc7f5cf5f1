"""The registered queries of this folder, and their SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm import (
    bpe,
    cotraining,
    decontamination,
    jaccard,
    lexical,
    main_text,
    periodic,
    quality,
    sharding,
    substrings,
    suffixes,
    topk,
    toxicity,
)
from varve.llm.twins import ORACLES  # noqa: F401  the registry reads it here

SHARDS = 24
RESULTS = 20
NEIGHBOURS = 5
RANKS = "byte_bpe_multi_50k.tiktoken"


def _table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark, sf_dir):
    marked = decontamination.mark(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark")
    )
    return marked.select(
        "doc_id",
        "n_words",
        decontamination.n_hit().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


def op2_main_text(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extract_main_text(pages)


def op3_byte_bpe(spark, sf_dir):
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    encoded = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern)
    decoded = bpe.decode(encoded.drop("text"), path)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_substring_dedup(spark, sf_dir):
    kept = substrings.without_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_quality_rules(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "quality_score")


def op6_jaccard_join(spark, sf_dir):
    found = jaccard.similarity_components(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op7_suffix_dedup(spark, sf_dir):
    kept = suffixes.without_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_sharding(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = sharding.write_shards(docs, sharding.shards_in(spark), SHARDS)
    return stored.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    tagged = toxicity.tag_documents(docs, _table(spark, sf_dir, "labels"))
    return tagged.select("doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), "score", "predicted", "spans")


def op10_quality_classifier(spark, sf_dir):
    scored = cotraining.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "text_p", "meta_p", "quality_score", "kept")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), where one text in ten goes on periodically from a word on: h = crc32 of the id's digits, divisible by 10."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    n, g = F.size("words"), F.floor(h / 10)
    listed = docs.withColumn("words", words)
    placed = listed.withColumn("a", F.when(n > 0, (g % n).cast("int")))
    placed = placed.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)).cast("int"))
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    changed = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", source(i))), " ")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir):
    docs = with_planted_periods(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    marked = periodic.mark_runs(docs)
    # greatest length / period, compared as fractions; then the smallest start and period
    order = F.expr(
        """array_sort(runs, (x, y) -> CASE
             WHEN x.length * y.period <> y.length * x.period THEN IF(x.length * y.period > y.length * x.period, -1, 1)
             WHEN x.start <> y.start THEN IF(x.start < y.start, -1, 1)
             WHEN x.period <> y.period THEN IF(x.period < y.period, -1, 1)
             ELSE 0 END)"""
    )
    line = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    best = marked.withColumn("best", F.get(order, F.lit(0)))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_lexical_search(spark, sf_dir):
    index = lexical.build_index(_table(spark, sf_dir, "documents"))
    return lexical.search(index, _table(spark, sf_dir, "benchmark"), RESULTS)


def op13_topk_search(spark, sf_dir):
    return topk.top_k(_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0, NEIGHBOURS)


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_main_text,
        op3_byte_bpe,
        op4_substring_dedup,
        op5_quality_rules,
        op6_jaccard_join,
        op7_suffix_dedup,
        op8_sharding,
        op9_toxicity,
        op10_quality_classifier,
        op11_periodic_runs,
        op12_lexical_search,
        op13_topk_search,
    )
}
