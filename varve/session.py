"""Session-level settings: where written tables go and how wide shuffles are."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Below this, a partition of a small table costs more than the core it would use.
LEAST_PARTITION_BYTES = 1 << 20

_local_dirs: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary
    folder of its own, one per application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="run-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Whether Spark deletes a query's shuffle files as soon as the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, name: str, value):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def shuffle_width(spark: SparkSession, width: int):
    """Shuffles planned inside have ``width`` partitions; frames must be written inside to be so planned."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def written(df: DataFrame, label: str, partition_by: str | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and survives lost executors.

    The shuffle files of the write go when it ends, as its own plan is never run again.
    """
    spark = df.sparkSession
    path = path or fresh_path(spark, label)
    with setting(spark, _CLEANUP, "true"):
        df.write.partitionBy(*([partition_by] if partition_by else [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Delete the scratch table at ``path``, which is of :func:`fresh_path`, once nothing reads it any more."""
    if not path.startswith(f"{scratch_dir(spark)}/"):
        raise ValueError(f"not a scratch table: {path}")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def written_bucketed(df: DataFrame, label: str, buckets: int, *keys: str, path: str | None = None) -> DataFrame:
    """Like :func:`written`, bucketed on ``keys`` so that joins on them need no exchange.

    The catalog entry is only a handle for the bucket layout. It is dropped at
    once; the files stay and the returned frame keeps reading them. With ``path`` they stand there, and
    :func:`read_bucketed` finds them again in any session.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    (
        df.write.format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path or fresh_path(spark, label))
        .saveAsTable(name)
    )
    return _without_handle(spark, name)


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, buckets: int, *keys: str) -> DataFrame:
    """What :func:`written_bucketed` wrote to ``path``."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    names = ", ".join(f"`{k}`" for k in keys)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return _without_handle(spark, name)


def _without_handle(spark: SparkSession, name: str) -> DataFrame:
    table = spark.table(name)
    table.schema  # resolve before the handle goes away
    spark.sql(f"DROP TABLE {name}")
    return table


def file_bytes(files: DataFrame) -> int:
    """Bytes of the files that a scan reads; no column is read for it."""
    sizes = files.select("_metadata.file_path", "_metadata.file_size").distinct()
    return sizes.agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0]


def planned_width(files: DataFrame) -> int:
    """Shuffle partitions for a table of these files: as many as the advisory size asks for, and enough to use the cores on smaller ones."""
    spark = files.sparkSession
    size = file_bytes(files)
    advised = _bytes_of(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"))
    return max(-(-size // advised), min(spark.sparkContext.defaultParallelism, -(-size // LEAST_PARTITION_BYTES)), 1)


def _bytes_of(text: str) -> int:
    match = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", text.strip().lower())
    if not match:
        raise ValueError(f"not a size: {text}")
    return int(match[1]) << 10 * " kmgt".index(match[2] or " ")
