"""Linear softmax classifier: scores, gradients, their averaging, and the SGD step.

Parameters are a long table ``(param, pos, value)``: ``weight`` at
``class * features + feature`` and ``bias`` at ``class``. Their number is fixed
by the model and does not grow with the data.

The operators of a step take frames. Where one task holds all of a step's rows, they take Arrow tables instead and
return a table at once, with the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.functions.exact import LIMBS, built_once, exact_sum_named, exact_sum_over, exact_sums_by, limb_arrays, limbs_total, nearest

# Fixed values of the optimizer.
LEARNING_RATE = 0.1
MOMENTUM = 0.9
WEIGHT_DECAY = 1e-4

MODEL_VALUES_MAX = 10_000_000
#: Products that exact sums hold at a time.
EXACT_VALUES = 200_000


@dataclass(frozen=True)
class LinearModel:
    """Weights (classes x features) and biases, shipped to tasks with the function."""

    weight: np.ndarray
    bias: np.ndarray

    def __post_init__(self):
        if self.weight.size > MODEL_VALUES_MAX:
            raise ValueError("model too large to ship with every task")

    @classmethod
    def zeros(cls, classes: int, features: int) -> LinearModel:
        return cls(np.zeros((classes, features)), np.zeros(classes))

    @classmethod
    def from_rows(cls, rows: pa.Table, classes: int, features: int) -> LinearModel:
        model = cls.zeros(classes, features)
        pos, value = rows["pos"].to_numpy(), rows["value"].to_numpy()
        for param, held in (("weight", model.weight.reshape(-1)), ("bias", model.bias)):
            mine = _is(rows, param)
            held[pos[mine]] = value[mine]
        return model

    def to_rows(self) -> pa.Table:
        sizes = (self.weight.size, self.bias.size)
        return pa.table(
            {
                "param": ["weight"] * sizes[0] + ["bias"] * sizes[1],
                "pos": np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]),
                "value": np.concatenate([self.weight.reshape(-1), self.bias]),
            }
        )

    def scores(self, features: np.ndarray, exact: bool = False) -> np.ndarray:
        """Scores by row and class; ``exact`` ones don't depend on which rows come in one call, as a product of matrices may."""
        if exact:
            return np.einsum("rf,cf->rc", features, self.weight) + self.bias
        return features @ self.weight.T + self.bias


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != len(column) * width:
        raise ValueError(f"every feature array must have {width} values")
    return flat.reshape(len(column), width)


def linear_scores(examples: DataFrame, model: LinearModel, exact: bool = False) -> DataFrame:
    """Every row with ``scores``, one value per class; features are consumed. ``exact`` scores are the same in any partition."""
    kept = [c for c in examples.columns if c != "features"]
    width = model.weight.shape[1]

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(_matrix(batch.column("features"), width), exact)
            offsets = np.arange(len(scores) + 1, dtype=np.int32) * scores.shape[1]
            values = pa.ListArray.from_arrays(offsets, scores.reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], values], [*kept, "scores"]
            )

    fields = [examples.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField("scores", T.ArrayType(T.DoubleType()))])
    return examples.select(*kept, "features").mapInArrow(score, schema)


def shard_gradients(examples: DataFrame | pa.Table, model: LinearModel, exact: bool = False) -> DataFrame | pa.Table:
    """(shard, param, pos, value): gradient of each shard's mean loss.

    Tasks add up their rows per shard, so what is shuffled is parameters, not
    examples. The loss itself comes along as parameter ``loss`` and the row count
    as ``rows``. ``exact`` sums are limbs, whole numbers, up to the last division: the same for any partitions and order.
    """
    if exact:
        return _exact_gradients(examples, model)
    if isinstance(examples, pa.Table):
        sums = pa.Table.from_batches(_partial_sums(examples.to_batches(), model))
        total = sums["total"].to_numpy()
        value = np.where(_is(sums, "rows"), total, total / sums["n"].to_numpy())
        return sums.select(["shard", "param", "pos"]).append_column("value", pa.array(value))

    sums = examples.select("shard", "features", "label").mapInArrow(
        lambda batches: _partial_sums(batches, model), "shard int, param string, pos int, total double, n bigint"
    )
    # by parameter only: averaging over shards then needs no exchange of its own
    sums = sums.repartition("param", "pos")
    value = F.when(F.col("param") == "rows", F.sum("total")).otherwise(F.sum("total") / F.sum("n"))
    return sums.groupBy("shard", "param", "pos").agg(value.alias("value"))


def _partial_sums(batches: Iterable[pa.RecordBatch], model: LinearModel) -> Iterator[pa.RecordBatch]:
    """Each shard's sums over the batches, with their number of rows."""
    sums: dict[int, list] = {}
    for batch in batches:
        x = _matrix(batch.column("features"), model.weight.shape[1])
        label = batch.column("label").to_numpy(zero_copy_only=False)
        shard = batch.column("shard").to_numpy(zero_copy_only=False)
        error, loss = _errors(model.scores(x), label)
        for s in np.unique(shard):
            mine = shard == s
            parts = [error[mine].T @ x[mine], error[mine].sum(axis=0), loss[mine].sum(), mine.sum()]
            known = sums.get(int(s))
            sums[int(s)] = parts if known is None else [a + b for a, b in zip(known, parts)]
    for s, (weight, bias, loss, count) in sums.items():
        n_weight, n_bias = weight.size, bias.size
        yield pa.RecordBatch.from_pydict(
            {
                "shard": np.full(n_weight + n_bias + 2, s, dtype=np.int32),
                "param": ["weight"] * n_weight + ["bias"] * n_bias + ["loss", "rows"],
                "pos": np.concatenate(
                    [np.arange(n_weight), np.arange(n_bias), [0, 0]]
                ).astype(np.int32),
                "total": np.concatenate([weight.reshape(-1), bias, [loss, float(count)]]),
                "n": np.full(n_weight + n_bias + 2, count, dtype=np.int64),
            }
        )


def _is(rows: pa.Table, param: str) -> np.ndarray:
    return pc.equal(rows["param"], param).to_numpy()


def _errors(scores: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Softmax less the true class, and the loss, by row."""
    shifted = scores - scores.max(axis=1, keepdims=True)
    log_mass = np.log(np.exp(shifted).sum(axis=1, keepdims=True))
    rows = np.arange(len(label))
    error = np.exp(shifted - log_mass)
    error[rows, label] -= 1.0
    return error, log_mass[:, 0] - shifted[rows, label]


def _exact_gradients(examples: DataFrame | pa.Table, model: LinearModel) -> DataFrame | pa.Table:
    names = [f"l{i}" for i in range(LIMBS)]
    if isinstance(examples, pa.Table):
        sums = pa.Table.from_batches(_partial_limbs(examples.to_batches(), model))
        total = nearest(np.stack([sums[name].to_numpy() for name in names]))
        shard, is_rows = sums["shard"].to_numpy(), _is(sums, "rows")
        count = np.zeros(shard.max() + 1)
        count[shard[is_rows]] = total[is_rows]
        value = np.where(is_rows, total, total / count[shard])
        return sums.select(["shard", "param", "pos"]).append_column("value", pa.array(value))

    sums = examples.select("shard", "features", "label").mapInArrow(
        lambda batches: _partial_limbs(batches, model),
        "shard int, param string, pos int, " + ", ".join(f"{name} bigint" for name in names),
    )
    # by parameter only, as in the plain sums
    totals = sums.repartition("param", "pos").groupBy("shard", "param", "pos").agg(
        built_once(limbs_total, *names).alias("total")
    )
    rows = totals.where(F.col("param") == "rows").select("shard", F.col("total").alias("_rows"))  # one row per shard
    value = F.when(F.col("param") == "rows", F.col("total")).otherwise(F.col("total") / F.col("_rows"))
    return totals.join(F.broadcast(rows), "shard").select("shard", "param", "pos", value.alias("value"))


def _partial_limbs(batches: Iterable[pa.RecordBatch], model: LinearModel) -> Iterator[pa.RecordBatch]:
    """Each shard's sums over the batches, as limbs."""
    classes, width = model.weight.shape
    params = ["weight"] * (classes * width) + ["bias"] * classes + ["loss", "rows"]
    places = np.concatenate([np.arange(classes * width), np.arange(classes), [0, 0]]).astype(np.int32)
    step = max(1, EXACT_VALUES // (classes * width))
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        x = _matrix(batch.column("features"), width)
        label = batch.column("label").to_numpy(zero_copy_only=False)
        shard = batch.column("shard").to_numpy(zero_copy_only=False)
        error, loss = _errors(model.scores(x, exact=True), label)
        for s in np.unique(shard):
            held = sums.setdefault(int(s), np.zeros((LIMBS, len(params)), np.int64))
            mine = np.flatnonzero(shard == s)
            for first in range(0, len(mine), step):
                rows = mine[first : first + step]
                products = (error[rows, :, None] * x[rows, None, :]).reshape(len(rows), -1)
                values = np.concatenate([products, error[rows], loss[rows, None], np.ones((len(rows), 1))], axis=1)
                held += limb_arrays(values).sum(axis=1)
    for s, held in sums.items():
        columns = {"shard": np.full(len(params), s, np.int32), "param": params, "pos": places}
        yield pa.RecordBatch.from_pydict(columns | {f"l{i}": held[i] for i in range(LIMBS)})


def _numbered(*tables: pa.Table) -> tuple[np.ndarray, pa.Table]:
    """For all rows of the tables, one after the other, the number of their (param, pos), and these by number."""
    keys = pa.concat_tables([t.select(["param", "pos"]) for t in tables]).combine_chunks()
    param = keys["param"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
    _, first, number = np.unique(param << 32 | keys["pos"].to_numpy(), return_index=True, return_inverse=True)
    return number, keys.take(pa.array(first))


def _sums_by(rows: pa.Table, number: np.ndarray, groups: int, exact: bool) -> np.ndarray:
    value = rows["value"].to_numpy()
    return exact_sums_by(value, number, groups) if exact else np.bincount(number, value, groups)


def _exact_mean_over(name: str, *keys: str) -> Column:
    group = Window.partitionBy(*keys)
    return exact_sum_over(F.col(name), group) / F.count(name).over(group)


def gradient_mean_gather(gradients: DataFrame | pa.Table, exact: bool = False) -> DataFrame | pa.Table:
    """Gather, average, and hand the mean back to every shard.

    A window's group is one parameter's value per shard.
    """
    if isinstance(gradients, pa.Table):
        number, keys = _numbered(gradients)
        mean = _sums_by(gradients, number, len(keys), exact) / np.bincount(number)
        return gradients.select(["shard", "param", "pos"]).append_column("value", pa.array(mean[number]))
    mean = built_once(_exact_mean_over, "value", "param", "pos") if exact else F.avg("value").over(Window.partitionBy("param", "pos"))
    return gradients.select("shard", "param", "pos", mean.alias("value"))


def first_copy(handed: DataFrame | pa.Table) -> DataFrame | pa.Table:
    """(param, pos, value) of what every shard has, from the first of them."""
    if isinstance(handed, pa.Table):
        ordered = handed.sort_by("shard")
        number, keys = _numbered(ordered)
        first = np.unique(number, return_index=True)[1]
        return keys.append_column("value", ordered["value"].take(pa.array(first)))
    return handed.groupBy("param", "pos").agg(F.min_by("value", "shard").alias("value"))


def gradient_mean_allreduce(gradients: DataFrame | pa.Table, shards: int, exact: bool = False) -> DataFrame | pa.Table:
    """All-reduce: element-wise sum over the shards, divided by their number."""
    if isinstance(gradients, pa.Table):
        number, keys = _numbered(gradients)
        return keys.append_column("value", pa.array(_sums_by(gradients, number, len(keys), exact) / shards))
    total = built_once(exact_sum_named, "value") if exact else F.sum("value")
    return gradients.groupBy("param", "pos").agg((total / shards).alias("value"))


def sgd_update(
    params: DataFrame | pa.Table,
    gradients: DataFrame | pa.Table,
    lr: float = LEARNING_RATE,
    momentum: float = MOMENTUM,
    weight_decay: float = WEIGHT_DECAY,
) -> DataFrame | pa.Table:
    """New (param, pos, value, velocity) from params, their velocity and the mean gradient.

    ``gradient`` comes along. Gradient rows that belong to no parameter, such as
    the loss, are kept with neither value nor velocity. A parameter without a
    gradient stays as it is.
    """
    if isinstance(params, pa.Table):
        return _updated(params, gradients, lr, momentum, weight_decay)
    grad = gradients.select("param", "pos", F.col("value").alias("gradient"))
    joined = grad.join(params, ["param", "pos"], "full")
    moving = F.col("gradient").isNotNull()
    velocity = F.col("velocity") * momentum + F.col("gradient") + F.col("value") * weight_decay
    stepped = joined.withColumn("velocity", F.when(moving, velocity).otherwise(F.col("velocity")))
    value = F.when(moving, F.col("value") - F.col("velocity") * lr).otherwise(F.col("value"))
    return stepped.select("param", "pos", value.alias("value"), "velocity", "gradient")


def _updated(params: pa.Table, gradients: pa.Table, lr: float, momentum: float, weight_decay: float) -> pa.Table:
    number, keys = _numbered(params, gradients)
    held, moved = number[: len(params)], number[len(params) :]
    value, velocity, gradient = np.zeros((3, len(keys)))
    known, moving = np.zeros((2, len(keys)), bool)
    value[held], velocity[held], known[held] = params["value"].to_numpy(), params["velocity"].to_numpy(), True
    gradient[moved], moving[moved] = gradients["value"].to_numpy(), True
    velocity = np.where(moving, velocity * momentum + gradient + value * weight_decay, velocity)
    value = np.where(moving, value - velocity * lr, value)
    made = {"value": (value, ~known), "velocity": (velocity, ~known), "gradient": (gradient, ~moving)}
    for name, (column, missing) in made.items():
        keys = keys.append_column(name, pa.array(column, mask=missing))
    return keys
