"""Whole jobs, from an input path to an output path."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import SparkSession

from varve.operators.links import parse_links
from varve.plans.pagerank import pagerank
from varve.sources import sinks
from varve.sources.text import scan_csv, scan_lines

# The sort columns of the CSV job and the sort field of the text job.
SORT_KEYS = ("cca2", "timestamp")
SORT_FIELD = 2


def sort_csv(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    keys: Sequence[str] = SORT_KEYS,
    unique: Sequence[str] = (),
    schema: str | None = None,
) -> None:
    """Sort a CSV with a header by ``keys`` and append it, without one, to ``output_path``."""
    sinks.append_sorted_csv(scan_csv(spark, input_path, schema), output_path, keys, unique)


def sort_text(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    field: int = SORT_FIELD,
    header: str | None = None,
) -> None:
    """Sort comma-separated lines by one string field."""
    sinks.write_sorted_lines(scan_lines(spark, input_path), output_path, field, header)


def rank_links(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    namespace: Literal["line", "field"] = "line",
    layout: Literal["tuple", "tsv"] = "tuple",
    **how,
) -> None:
    """PageRank over link files; ``how`` goes to :func:`~varve.plans.pagerank.pagerank`."""
    ranks = pagerank(parse_links(scan_lines(spark, input_path), namespace), **how)
    write = sinks.write_rank_tuples if layout == "tuple" else sinks.write_rank_tsv
    write(ranks, output_path)
