"""Train/test split, shards and mini-batches, all repeatable from a seed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.operators.blocks import global_position, in_blocks, positions
from varve.operators.permutation import Permutation
from varve.session import written

# Fixed values of the training runs.
GLOBAL_BATCH = 256
SEED = 314

TRAIN_BELOW = "d"


def split_of(id_column: str):
    """'train' or 'test' by the first hex digit of the id's md5 (13 of 16 go to train)."""
    digit = F.substring(F.md5(F.col(id_column).cast("string")), 1, 1)
    return F.when(digit < TRAIN_BELOW, F.lit("train")).otherwise(F.lit("test"))


def assign_shards(examples: DataFrame, shards: int, seed: int = SEED, epoch: int = 0) -> DataFrame:
    """Shuffle by seed and epoch, then deal rows to shards in turn.

    Adds ``position``, ``shard`` and ``place`` (position within the shard). The
    first rows are dealt again at the end until the shards are equally long.
    """
    drawn = examples.withColumn(
        "_draw", F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(str(epoch)), F.col("id").cast("string")))
    )
    blocked = in_blocks(drawn, ["_draw", "id"])
    total = blocked.total
    padded = -(-total // shards) * shards
    ordered = positions(blocked, "_position")
    if total:
        first = F.col("_position").cast("bigint")
        dealt = F.explode(F.sequence(first, F.lit(padded - 1).cast("bigint"), F.lit(total).cast("bigint")))
    else:
        dealt = F.col("_position").cast("bigint")
    return ordered.select(*examples.columns, dealt.alias("position")).select(
        "*",
        (F.col("position") % shards).cast("int").alias("shard"),
        F.floor(F.col("position") / shards).alias("place"),
    )


def numbered(examples: DataFrame) -> DataFrame:
    """``examples`` with ``number``, their place by id, written once: what the epochs permute."""
    return written(global_position(examples, ["id"], name="number"), "numbered")


def assign_shards_permuted(rows: DataFrame, shards: int, seed: int = SEED, epoch: int = 0, total: int | None = None) -> DataFrame:
    """Like :func:`assign_shards` on :func:`numbered` rows, by a keyed permutation of their numbers: an epoch moves no row and sorts nothing.

    ``total`` is the number of rows, counted if it isn't given.
    """
    total = rows.count() if total is None else total
    kept = [c for c in rows.columns if c != "number"]
    if not total:
        return rows.select(*kept, F.col("number").alias("position")).select(
            "*", F.lit(0).alias("shard"), F.col("position").alias("place")
        )
    drawn = Permutation(total, f"{seed}:{epoch}").of(rows, "number", "_drawn")
    padded = -(-total // shards) * shards
    dealt = F.explode(F.sequence(F.col("_drawn"), F.lit(padded - 1).cast("bigint"), F.lit(total).cast("bigint")))
    return drawn.select(*kept, dealt.alias("position")).select(
        "*",
        (F.col("position") % shards).cast("int").alias("shard"),
        F.floor(F.col("position") / shards).alias("place"),
    )


def assign_batches(
    examples: DataFrame,
    shards: int = 1,
    global_batch: int = GLOBAL_BATCH,
    seed: int = SEED,
    epoch: int = 0,
) -> DataFrame:
    """Sharded rows with ``batch``: each shard takes floor(global_batch / shards) rows at a time."""
    size = batch_size(shards, global_batch)
    sharded = assign_shards(examples, shards, seed, epoch)
    return sharded.withColumn("batch", F.floor(F.col("place") / size))


def assign_batches_permuted(
    rows: DataFrame,
    shards: int = 1,
    global_batch: int = GLOBAL_BATCH,
    seed: int = SEED,
    epoch: int = 0,
    total: int | None = None,
) -> DataFrame:
    """Like :func:`assign_batches` on :func:`numbered` rows, without a sort."""
    size = batch_size(shards, global_batch)
    sharded = assign_shards_permuted(rows, shards, seed, epoch, total)
    return sharded.withColumn("batch", F.floor(F.col("place") / size))


def batch_size(shards: int, global_batch: int = GLOBAL_BATCH) -> int:
    if not 0 < shards <= global_batch:
        raise ValueError(f"{shards} shards need a global batch of at least as many rows, not {global_batch}")
    return global_batch // shards


def ordered_batches(examples: DataFrame, size: int = GLOBAL_BATCH) -> DataFrame:
    """Batches in id order, as a test loader reads them."""
    placed = global_position(examples, ["id"])
    return placed.withColumn("batch", F.floor(F.col("position") / size))
