"""Synchronous data-parallel mini-batch SGD."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Literal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.operators import gradients as G
from varve.operators.sharding import (
    GLOBAL_BATCH,
    SEED,
    assign_batches,
    assign_batches_permuted,
    batch_size,
    numbered,
)
from varve.session import shuffle_partitions, shuffle_width, written

# Fixed values of the progress log: one line every 20 batches, and its layout.
REPORT_EVERY = 20
PROGRESS_LINE = "Train Epoch: %d [%d/%d (%.0f%%)]\tLoss: %.6f"

#: Rows that a folder of neighbouring batches holds, about; a step opens all files of one folder.
FOLDER_ROWS = 5_000
#: Products of a feature with a class's weight up to which one task makes a step sooner than a job of its own starts.
TASK_PRODUCTS = 2_000_000
#: Numbers that a step's shuffles hold a partition, about.
STEP_VALUES = 100_000

STATE_SCHEMA = "param string, pos int, value double, velocity double"
RUN_SCHEMA = f"{STATE_SCHEMA}, gradient double, step int"
PROGRESS_SCHEMA = (
    "epoch int, batch bigint, rows_seen bigint, total bigint, percent double, loss double"
)


@dataclass(frozen=True)
class Training:
    model: G.LinearModel
    params: DataFrame
    progress: DataFrame


def step_width(spark: SparkSession, values: int) -> int:
    """Shuffle partitions for a step that moves ``values`` numbers, up to the session's width. They are as many in every step, however large the table."""
    return max(1, min(shuffle_partitions(spark), -(-values // STEP_VALUES)))


def step_runs(steps: int, most: int, report_every: int) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of up to ``most`` steps. A run with steps to report ends with the last of them, so that their reports wait for no other."""
    first = 0
    while first < steps:
        end = min(first + most, steps)
        reported = (end - 1) // report_every * report_every
        if reported >= first:
            end = reported + 1
        yield first, end
        first = end


def train_softmax(
    examples: DataFrame,
    classes: int,
    features: int,
    *,
    shards: int = 4,
    global_batch: int = GLOBAL_BATCH,
    epochs: int = 1,
    seed: int = SEED,
    sync: Literal["gather", "allreduce"] = "allreduce",
    lr: float = G.LEARNING_RATE,
    momentum: float = G.MOMENTUM,
    weight_decay: float = G.WEIGHT_DECAY,
    report_every: int = REPORT_EVERY,
    transform: Callable[[DataFrame, int], DataFrame] | None = None,
    reshuffle: Literal["sort", "permute"] = "sort",
    exact: bool = False,
) -> Training:
    """Train on ``examples(id, features, label)``; every batch is one step.

    The epoch's rows are written once in batch order, in folders of neighbouring
    batches, so a step opens the files of one folder and skips other batches by
    their row-group statistics. Steps follow each other by nature; ``global_batch`` sets how much work a step has.
    Where that is less than starting a job, one task makes a run of steps, each with the same operators, and streams a folder's rows in
    batch order. A larger step is a job of its own and spread over the cluster; it shuffles parameters only, in as many partitions as
    these need. Only the model, whose size is fixed, comes back to the driver between jobs.
    ``transform`` maps the examples and the epoch's number to what that epoch trains on.

    ``reshuffle`` says how an epoch is shuffled: by a sort on drawn keys, or by a keyed permutation of positions that are numbered once.
    With ``exact`` the model is the same bit for bit however the examples are partitioned and in whatever order tasks end.
    """
    spark = examples.sparkSession
    model = G.LinearModel.zeros(classes, features)
    state = model.to_rows().append_column("velocity", pa.array([0.0] * (model.weight.size + classes)))
    total = examples.count()
    steps = -(-(-(-total // shards)) // batch_size(shards, global_batch))
    per_folder = max(1, FOLDER_ROWS // (batch_size(shards, global_batch) * shards))
    width = step_width(spark, shards * (model.weight.size + classes))
    in_task = global_batch * model.weight.size <= TASK_PRODUCTS
    how = (shards, sync, exact, lr, momentum, weight_decay)
    progress = []

    if reshuffle == "permute":
        examples = numbered(examples)
    for epoch in range(epochs):
        seen_now = transform(examples, epoch) if transform else examples
        if reshuffle == "permute":
            batched = assign_batches_permuted(seen_now, shards, global_batch, seed, epoch, total)
        else:
            batched = assign_batches(seen_now, shards, global_batch, seed, epoch)
        slab = F.floor(F.col("batch") / per_folder).cast("int").alias("slab")
        table = written(batched.select("batch", "shard", "features", "label", slab), "batches", "slab")
        for first, end in step_runs(steps, per_folder if in_task else 1, report_every):
            slabs = F.col("slab").between(first // per_folder, (end - 1) // per_folder)
            mine = table.where(slabs & F.col("batch").between(first, end - 1))
            if in_task:
                # one partition in any case, so this is no exchange
                ordered = mine.select("batch", "shard", "features", "label").coalesce(1).sortWithinPartitions("batch")
                made = ordered.mapInArrow(_run(state, model, first, end, report_every, *how), RUN_SCHEMA)
            else:
                made = _stepped(mine, spark.createDataFrame(state, STATE_SCHEMA), model, *how).withColumn("step", F.lit(first))
            with shuffle_width(spark, width):
                state, rest = _split(made.toArrow())  # model size, and two rows a report
            model = G.LinearModel.from_rows(state, classes, features)
            reports = {}
            for at, param, value in zip(*(rest[c].to_pylist() for c in ("step", "param", "gradient"))):
                reports.setdefault(at, {})[param] = value
            for step in range(-(-first // report_every) * report_every, end, report_every):
                seen = round(step * reports[step]["rows"] * shards)
                progress.append((epoch, step, seen, total, 100.0 * step / steps, reports[step]["loss"]))

    return Training(
        model,
        spark.createDataFrame(state, STATE_SCHEMA),
        spark.createDataFrame(progress, PROGRESS_SCHEMA),
    )


def _stepped(rows, params, model: G.LinearModel, shards: int, sync: str, exact: bool, lr: float, momentum: float, weight_decay: float):
    """The update by one batch's rows; rows and params are frames, or Arrow tables in a task."""
    local = G.shard_gradients(rows, model, exact)
    if sync == "gather":
        # every shard has the mean back; they are equal, so any one's copy makes the step
        mean = G.first_copy(G.gradient_mean_gather(local, exact))
    else:
        mean = G.gradient_mean_allreduce(local, shards, exact)
    return G.sgd_update(params, mean, lr, momentum, weight_decay)


def _split(stepped: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The model's rows, and those that come along."""
    is_model = pc.is_valid(stepped["value"])
    return stepped.filter(is_model).select(["param", "pos", "value", "velocity"]), stepped.filter(pc.invert(is_model))


def _run(state: pa.Table, model: G.LinearModel, first: int, end: int, report_every: int, *how):
    """Steps ``first`` to ``end`` on their rows in batch order: what comes along with the steps to report, and the model after the last."""
    classes, features = model.weight.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params, at, due = state, model, first
        for step, rows in _by_batch(batches):
            if step != due:
                raise ValueError(f"batch {due} is missing")
            due += 1
            params, rest = _split(_stepped(rows, params, at, *how))
            at = G.LinearModel.from_rows(params, classes, features)
            if step % report_every == 0:
                yield from _tagged(rest, step).to_batches()
        if due != end:
            raise ValueError(f"batch {due} is missing")
        gradients = pa.nulls(len(params), pa.float64())
        yield from _tagged(params.append_column("gradient", gradients), end - 1).to_batches()

    return run


def _tagged(rows: pa.Table, step: int) -> pa.Table:
    return rows.append_column("step", pa.array(np.full(len(rows), step, np.int32)))


def _by_batch(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Each batch's number and rows; they come ordered by it."""
    held, number = [], None
    for part in batches:
        numbers = part.column("batch").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if held and numbers[a] != number:
                yield int(number), pa.Table.from_batches(held)
                held = []
            number = numbers[a]
            held.append(part.slice(a, b - a))
    if held:
        yield int(number), pa.Table.from_batches(held)


def progress_lines(progress: DataFrame) -> DataFrame:
    return progress.select(
        F.format_string(
            PROGRESS_LINE,
            *[F.col(c) for c in ("epoch", "rows_seen", "total", "percent", "loss")],
        ).alias("line")
    )
