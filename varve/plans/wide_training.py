"""Synchronous mini-batch SGD for models that no machine holds as a whole.

Features are cut into blocks. A row of the model table is one block's weights of all classes; the biases are a block of their own whose
only feature is 1. A step joins a batch's feature blocks with the weights, adds partial scores up per example, sends
each example's error back to its blocks, and updates every block where it lies. No task holds more than one block and one Arrow batch, and nothing of
the model returns to the driver; each step's model is a table, so a lost executor repeats one step at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.operators import gradients as G
from varve.operators.sharding import GLOBAL_BATCH, SEED, assign_batches, batch_size
from varve.plans.training import FOLDER_ROWS, step_width
from varve.session import shuffle_width, written

#: Weights of a block, about.
BLOCK_VALUES = 100_000
BIAS = -1

_MODEL = "block int, value array<double>, velocity array<double>"


def train_softmax_wide(
    examples: DataFrame,
    classes: int,
    features: int,
    *,
    block_features: int | None = None,
    shards: int = 4,
    global_batch: int = GLOBAL_BATCH,
    epochs: int = 1,
    seed: int = SEED,
    lr: float = G.LEARNING_RATE,
    momentum: float = G.MOMENTUM,
    weight_decay: float = G.WEIGHT_DECAY,
) -> DataFrame:
    """The parameters (param, pos, value, velocity) that :func:`varve.plans.training.train_softmax` finds, whatever the model's size."""
    spark = examples.sparkSession
    width = block_features or max(1, BLOCK_VALUES // classes)
    steps = -(-(-(-examples.count() // shards)) // batch_size(shards, global_batch))
    per_folder = max(1, FOLDER_ROWS // (batch_size(shards, global_batch) * shards))
    # a batch's features and errors, and three arrays of the model's size
    moved = step_width(spark, global_batch * (features + classes) + 3 * (features + 1) * classes)
    sizes = spark.range(0, -(-features // width)).select(
        F.col("id").cast("int").alias("block"), F.least(F.lit(width), features - F.col("id") * width).cast("int").alias("n")
    )
    zeros = F.array_repeat(F.lit(0.0), F.col("n") * classes)
    blocks = sizes.unionByName(spark.createDataFrame([(BIAS, 1)], "block int, n int"))
    model = written(blocks.select("block", zeros.alias("value"), zeros.alias("velocity")), "model")

    for epoch in range(epochs):
        batched = assign_batches(examples, shards, global_batch, seed, epoch)
        slab = F.floor(F.col("batch") / per_folder).cast("int").alias("slab")
        table = written(_in_blocks(batched, width).select("*", slab), "batches", "slab")
        for step in range(steps):
            mine = table.where((F.col("slab") == step // per_folder) & (F.col("batch") == step))
            mean = _block_gradients(mine, _example_errors(mine, model, classes), classes)
            with shuffle_width(spark, moved):
                model = written(_stepped(model, mean, lr, momentum, weight_decay), "model")
    return _as_rows(model, classes, features, width)


def _in_blocks(batched: DataFrame, width: int) -> DataFrame:
    """(batch, shard, position, label, block, x): one row per example and feature block, and one for the bias."""
    count = F.ceil(F.size("features") / width).cast("int")
    x = F.col("features").cast("array<double>")
    parts = F.transform(
        F.sequence(F.lit(0), count - 1), lambda b: F.struct(b.alias("block"), F.slice(x, b * width + 1, F.lit(width)).alias("x"))
    )
    bias = F.array(F.struct(F.lit(BIAS).alias("block"), F.array(F.lit(1.0)).alias("x")))
    return batched.select("batch", "shard", "position", "label", F.inline(F.concat(parts, bias)))


def _example_errors(rows: DataFrame, model: DataFrame, classes: int) -> DataFrame:
    """(position, error): softmax less the true class of each example of a batch."""

    def partial(batches):
        for batch in batches:
            x, w = batch.column("x"), batch.column("value")
            sums = np.empty((batch.num_rows, classes))
            block = batch.column("block").to_numpy()
            for b in np.unique(block):
                mine = np.flatnonzero(block == b)
                values = w[int(mine[0])].values.to_numpy().reshape(classes, -1)
                own = x.take(pa.array(mine)).flatten().to_numpy().reshape(len(mine), -1)
                sums[mine] = own @ values.T
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column("position").to_numpy(), classes)),
                    pa.array(np.repeat(batch.column("label").to_numpy().astype(np.int32), classes)),
                    pa.array(np.tile(np.arange(classes, dtype=np.int32), batch.num_rows)),
                    pa.array(sums.reshape(-1)),
                ],
                ["position", "label", "class", "score"],
            )

    joined = rows.join(model.select("block", "value"), "block").select("position", "label", "block", "x", "value")
    parts = joined.mapInArrow(partial, "position bigint, label int, class int, score double")
    # a row per example and class, combined before the shuffle
    scores = parts.groupBy("position", "label", "class").agg(F.sum("score").alias("score"))
    listed = scores.groupBy("position", "label").agg(F.sort_array(F.collect_list(F.struct("class", "score"))).alias("scores"))
    scored = listed.select("position", "label", F.col("scores.score").alias("scores"))

    def errors(batches):
        for batch in batches:
            error, _ = G._errors(batch.column("scores").flatten().to_numpy().reshape(-1, classes), batch.column("label").to_numpy())
            lists = pa.ListArray.from_arrays(np.arange(len(error) + 1, dtype=np.int32) * classes, error.reshape(-1))
            yield pa.RecordBatch.from_arrays([batch.column("position"), lists], ["position", "error"])

    return scored.mapInArrow(errors, "position bigint, error array<double>")


def _block_gradients(rows: DataFrame, errors: DataFrame, classes: int) -> DataFrame:
    """(block, gradient): the mean over shards of each shard's mean gradient; a block's rows come one after the other."""

    def partial(batches):
        block, sums = None, {}
        for batch in batches:
            keys = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if sums and keys[a] != block:
                    yield mean(block, sums)
                    sums = {}
                block, part = keys[a], batch.slice(a, b - a)
                x = part.column("x").flatten().to_numpy().reshape(b - a, -1)
                error = part.column("error").flatten().to_numpy().reshape(b - a, classes)
                shard = part.column("shard").to_numpy()
                for s in np.unique(shard).tolist():
                    mine = shard == s
                    old, n = sums.get(s, (0.0, 0))
                    sums[s] = old + error[mine].T @ x[mine], n + int(mine.sum())
        if sums:
            yield mean(block, sums)

    def mean(block, sums):
        gradient = sum(total / n for total, n in sums.values()) / len(sums)
        values = pa.array([gradient.reshape(-1)], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), values], ["block", "gradient"])

    joined = rows.join(errors, "position").select("block", "shard", "x", "error")
    placed = joined.repartition("block").sortWithinPartitions("block")
    return placed.mapInArrow(partial, "block int, gradient array<double>")


def _stepped(model: DataFrame, mean: DataFrame, lr: float, momentum: float, weight_decay: float) -> DataFrame:
    def update(batches):
        for batch in batches:
            value, velocity, gradient = (batch.column(c).flatten().to_numpy() for c in ("value", "velocity", "gradient"))
            offsets = batch.column("value").offsets
            offsets = pa.array(offsets.to_numpy() - offsets[0].as_py(), pa.int32())
            velocity = velocity * momentum + gradient + value * weight_decay
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (value - velocity * lr, velocity)]
            yield pa.RecordBatch.from_arrays([batch.column("block"), *lists], ["block", "value", "velocity"])

    return model.join(mean, "block").select("block", "value", "velocity", "gradient").mapInArrow(update, _MODEL)


def _as_rows(model: DataFrame, classes: int, features: int, width: int) -> DataFrame:
    cells = model.select("block", F.size("value").alias("_n"), F.posexplode(F.arrays_zip("value", "velocity")).alias("at", "cell"))
    per_class = F.col("_n") / classes
    weight = F.floor(F.col("at") / per_class) * features + F.col("block") * width + F.col("at") % per_class
    is_bias = F.col("block") == BIAS
    return cells.select(
        F.when(is_bias, "bias").otherwise("weight").alias("param"),
        F.when(is_bias, F.col("at")).otherwise(weight).cast("int").alias("pos"),
        "cell.value",
        "cell.velocity",
    )
