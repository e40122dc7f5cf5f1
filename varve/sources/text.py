"""Text and CSV sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a string split on line boundaries breaks at besides the line feed: CR, VT, FF, FS, GS, RS, NEL, LS, PS.
INNER_LINE_BREAKS = "[\\r\\x0B\\x0C\\x1C\\x1D\\x1E\\x85\\u2028\\u2029]"


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line as ``value``; ``path`` may be a glob."""
    return spark.read.text(path)


def scan_file_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of whole files with the ``file`` they came from, as a split of the whole file's text on line boundaries has them.

    Files are read in splits, never as one row each, so their size does not matter. A break at the end of a line feed's line
    leaves an empty line before the feed, but none at the end of a file that ends without one. Such files show by their size: their lines
    hold one byte more, with a feed each, than they do.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("_size"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row")).alias("_at"),
    )
    # a feed takes a carriage return before it along
    pieces = F.split(F.regexp_replace("value", "\\r\\z", ""), INNER_LINE_BREAKS, -1)
    ends = F.col("value").rlike(INNER_LINE_BREAKS + r"\z")
    whole = lines.where(~ends).select("file", F.explode(pieces).alias("value"))
    # only lines with a break at their end are joined: the last of a file without a final feed has one piece less
    # counted by split first, in plain numbers that a hash table takes: the greatest struct of a file would have every split's lines sorted
    splits = lines.groupBy("file", F.col("_at.file_block_start")).agg(
        F.sum(F.octet_length("value") + 1).alias("_bytes"), F.max("_size").alias("_size"), F.max("_at.row").alias("row")
    )
    open_files = splits.groupBy("file").agg(
        F.sum("_bytes").alias("_bytes"), F.max("_size").alias("_size"), F.max(F.struct("file_block_start", "row")).alias("_last")
    )
    last = open_files.where(F.col("_bytes") > F.col("_size")).select("file", F.col("_last").alias("_at"), F.lit(True).alias("_open"))
    broken = lines.where(ends).join(last, ["file", "_at"], "left")
    all_pieces = F.split("value", INNER_LINE_BREAKS, -1)
    without_last = F.slice(all_pieces, 1, F.size(all_pieces) - 1)
    return whole.unionByName(broken.select("file", F.explode(F.when(F.col("_open"), without_last).otherwise(pieces)).alias("value")))


def scan_fields(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Positional string fields per line; quotes have no meaning here."""
    return scan_lines(spark, path).select(split_fields(sep))


def split_fields(sep: str = ","):
    return F.split("value", sep, -1).alias("fields")


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred, at the cost of one more pass."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)
