"""Finished tables of a long job, on record beside them, so that another session can go on where one stopped.

A job's folder holds its tables, each under a name of its own, and a manifest: one line per table, added after the table was written. A line has the number of
rows and a digest of them. A table without a line was never finished; one that no longer fits its line was damaged.
Neither is ever read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.session import read_bucketed, written_bucketed

_LINE = "job string, kind string, number int, path string, schema string, buckets int, keys array<string>, row_count bigint, digest string"


def digest(df: DataFrame) -> tuple[int, str]:
    """Number of rows, and a sum of their hashes that doesn't depend on their order."""
    row = F.xxhash64(*df.columns).cast("decimal(20,0)")
    rows, total = df.agg(F.count(F.lit(1)), F.sum(row)).first()
    return rows, str(total or 0)


class Manifest:
    """The tables of one ``job`` in ``folder``; the job's name tells what it computes, and from what."""

    def __init__(self, spark: SparkSession, folder: str, job: str):
        self.spark, self.folder, self.job = spark, folder.rstrip("/"), job

    @property
    def _path(self) -> str:
        return f"{self.folder}/manifest"

    def save(self, df: DataFrame, kind: str, number: int, buckets: int, *keys: str) -> DataFrame:
        """``df`` written and put on record; the frame returned reads the table."""
        path = f"{self.folder}/{kind}-{number}-{uuid.uuid4().hex}"
        table = written_bucketed(df, kind, buckets, *keys, path=path)
        rows, total = digest(table)
        line = (self.job, kind, number, path, table.schema.json(), buckets, list(keys), rows, total)
        # one file, which appears as a whole or not at all
        self.spark.createDataFrame([line], _LINE).coalesce(1).write.mode("append").json(self._path)
        return table

    def lines(self, kind: str) -> list:
        """What is on record, the highest number first; one line per table of the job."""
        try:
            found = self.spark.read.schema(_LINE).json(self._path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            return []
        mine = found.where((F.col("job") == self.job) & (F.col("kind") == kind))
        return mine.orderBy(F.col("number").desc(), "path").collect()

    def last(self, kind: str, at_most: int) -> tuple[int, DataFrame] | None:
        """The table of the highest number up to ``at_most`` that is whole, with its number."""
        for line in self.lines(kind):
            if line["number"] <= at_most:
                table = self._read(line)
                if table is not None:
                    return line["number"], table
        return None

    def _read(self, line) -> DataFrame | None:
        schema = T.StructType.fromJson(json.loads(line["schema"]))
        try:
            table = read_bucketed(self.spark, line["path"], schema, line["buckets"], *line["keys"])
            whole = digest(table) == (line["row_count"], line["digest"])
        except Exception:  # files that are missing or can't be decoded: the table is not whole
            return None
        return table if whole else None
