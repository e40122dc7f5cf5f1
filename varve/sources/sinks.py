"""Sinks. Every one writes as many part files as the frame has partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.operators.ordering import sort_lines, sort_rows

# Fixed layouts of the two rank outputs.
RANK_TUPLE_LAYOUT = "('%s', %s)"
RANK_TSV_SEPARATOR = "\t"

# Spark's own CSV layout would cut timestamps to milliseconds.
MICROS_LAYOUT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def plain_number(column: str):
    """A double as text without an exponent from 1e7 on, where the text of a cast has one; up to 1e16."""
    text = F.col(column).cast("string")
    # the shortest digits that give the number back, with zeros behind them cut down to one
    digits = F.regexp_replace(text.try_cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(F.abs(F.col(column)).between(1e7, 1e16), digits).otherwise(text)


def write_rank_tuples(ranks: DataFrame, path: str) -> None:
    """One ``('node', rank)`` line per node."""
    node, rank = F.col("node").cast("string"), plain_number("rank")
    ranks.select(F.format_string(RANK_TUPLE_LAYOUT, node, rank).alias("value")).write.text(path)


def write_rank_tsv(ranks: DataFrame, path: str) -> None:
    """One ``node<TAB>rank`` line per node."""
    node, rank = F.col("node").cast("string"), plain_number("rank")
    ranks.select(F.concat_ws(RANK_TSV_SEPARATOR, node, rank).alias("value")).write.text(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Add the rows to a CSV folder, without a header."""
    df.write.mode("append").option("timestampNTZFormat", MICROS_LAYOUT).option(
        "timestampFormat", f"{MICROS_LAYOUT}XXX"
    ).csv(path)


def append_sorted_csv(df: DataFrame, path: str, keys: Sequence[str], unique: Sequence[str] = ()) -> None:
    """Append in sorted order: part files follow each other along the keys."""
    append_csv(sort_rows(df, keys, unique), path)


def write_sorted_lines(
    lines: DataFrame, path: str, index: int, header: str | None = None, sep: str = ","
) -> None:
    """Raw lines sorted by one field, as part files whose names follow the order.

    Reading the parts in name order gives the one sorted file, without pushing
    the whole table through one task.
    """
    sort_lines(lines, index, header, sep).write.text(path)


def join_fields(fields: str, sep: str = ","):
    """Fields back to one line, each as a string."""
    return F.array_join(fields, sep).alias("value")
