"""Cleaning of a training corpus: five stages over the table ``documents``, each on what the one before kept.

Toxic documents go; of near duplicates one stays; passages that an earlier document has are cut out; documents
contaminated by the benchmark go; the rest is encoded.

Defined results: rows without words (null, empty or white space) are in no way duplicates, toxic or contaminated and stay, with no tokens, also several
without id. Rows that repeat an id and its text are one document from the second stage on; an id may stand for several different texts.
Further columns are carried along, whatever their names. An empty table stays empty.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import functions as F

from varve.llm import bpe, decontamination, jaccard, substrings, toxicity
from varve.session import written

RANKS = "byte_bpe_multi_50k.tiktoken"


#: Columns of ``documents``; a stage sees these and carries all others as one.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def carrying(stage):
    """``stage`` on a table with any further columns, whose names then can't clash with what the stage adds on its way."""

    @wraps(stage)
    def run(spark, docs, sf_dir):
        others = [c for c in docs.columns if c not in COLUMNS]
        if not others:
            return stage(spark, docs, sf_dir)
        parts = [docs[c].alias(f"_{i}") for i, c in enumerate(others)]
        packed = docs.select(*[docs[c] for c in docs.columns if c in COLUMNS], F.struct(*parts).alias("_carried"))
        out = stage(spark, packed, sf_dir)
        added = [c for c in out.columns if c not in packed.columns]
        kept = [c for c in docs.columns if c not in added]  # a column that the stage returns replaces one of its name
        return out.select(*[F.col(f"_carried._{others.index(c)}").alias(c) if c in others else F.col(c) for c in kept], *added)

    return run


@carrying
def drop_toxic(spark, docs, sf_dir):
    """Documents that the tagger doesn't call toxic."""
    tagged = toxicity.tag_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return tagged.where("predicted = 0").select(*docs.columns)


@carrying
def drop_near_duplicates(spark, docs, sf_dir):
    """Of each group of linked documents the one of smallest id."""
    return jaccard.one_of_each_group(docs)


@carrying
def cut_repeated_passages(spark, docs, sf_dir):
    """All documents, without the words of passages that an earlier one has; ``n_chars`` follows the text."""
    cut = substrings.without_duplicates(docs)
    counted = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", counted).select(*docs.columns)


@carrying
def drop_contaminated(spark, docs, sf_dir):
    """Documents that the benchmark doesn't contaminate."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@carrying
def encode(spark, docs, sf_dir):
    """The documents with their token ids."""
    return bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]


def run(spark, sf_dir):
    """All stages over ``documents``; each one's result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


#: The tagger is fitted, which SQL can't express; tests compare each stage with brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
