"""Global sorts that stay balanced when one key, or one row, is very common."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.operators.blocks import global_position

_TIE = "_tie"


def _ordered_by(df: DataFrame, keys: Sequence[str], unique: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The frame and the columns that order it, down to single rows.

    Without ``unique`` columns all others are tie-breakers, and last an id that is fixed per input row: exact
    copies are interchangeable, but with it even one row that fills a third of the table is spread.
    """
    if unique:
        return df, [*keys, *unique]
    rest = [f.name for f in df.schema.fields if f.name not in keys and "map<" not in f.dataType.simpleString()]
    return df.withColumn(_TIE, F.monotonically_increasing_id()), [*keys, *rest, _TIE]


def sort_rows(df: DataFrame, keys: Sequence[str], unique: Sequence[str] = ()) -> DataFrame:
    """Ascending global sort on ``keys``, nulls first, in one range exchange.

    ``unique`` names columns that tell rows with equal keys apart. They join the
    range partitioning, so one frequent key is spread over many partitions.
    """
    tied, order = _ordered_by(df, keys, unique)
    return tied.orderBy(*order).drop(_TIE)


def sort_position(
    df: DataFrame, keys: Sequence[str], unique: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """Every row with its 0-based position in the order of :func:`sort_rows`."""
    tied, order = _ordered_by(df, keys, unique)
    return global_position(tied, order, name=name).drop(_TIE)


def keyed_lines(lines: DataFrame, index: int, header: str | None = None, sep: str = ",") -> DataFrame:
    """(sort_key, value): field ``index`` of each raw line, split on every separator.

    A header is sorted among the rows; pass ``header`` to leave it out.
    """
    if header is not None:
        lines = lines.where(F.col("value") != F.lit(header))
    return lines.select(F.get(F.split("value", sep, -1), index).alias("sort_key"), "value")


def sort_lines(lines: DataFrame, index: int, header: str | None = None, sep: str = ",") -> DataFrame:
    """Lines ordered by one string field (code-point order); ties follow the line itself."""
    return sort_rows(keyed_lines(lines, index, header, sep), ["sort_key"]).select("value")
