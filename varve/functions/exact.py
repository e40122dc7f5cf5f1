"""Sums of doubles that don't depend on the order of their rows.

Adding doubles rounds at every step, so a sum changes with the width of a shuffle, a retry or the order of shards. Here every value is cut
into limbs, whole numbers of ``LIMB_BITS`` bits at fixed places; limbs are added as integers, which is exact and
associative, and the total is rounded to a double once, at the end.

Bits below ``2**LOW_BIT`` are cut off each value, so sums of values above ``2**(LOW_BIT + 52)`` in size are exact, and all are independent of order. Up to
``2**33`` rows of values below ``2**90`` fit a group; more than fits ends in an overflow error where the session is in ANSI mode.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from decimal import Decimal
from functools import lru_cache

import numpy as np
from pyspark import SparkContext
from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

LIMB_BITS = 30
LOW_BIT = -120
LIMBS = 7
_MASK = (1 << LIMB_BITS) - 1


def built_once(build: Callable[..., Column], *names: str) -> Column:
    """``build(*names)``, kept for the next call: an exact sum is hundreds of calls into the JVM, and a loop needs the same one in each step."""
    context = SparkContext._active_spark_context
    return _built(context and context._jvm, build, names)


@lru_cache(maxsize=64)
def _built(jvm, build: Callable[..., Column], names: tuple[str, ...]) -> Column:
    return build(*names)


def _place(i: int) -> float:
    return 2.0 ** (LOW_BIT + LIMB_BITS * i)


def limbs(value: Column) -> list[Column]:
    """``LIMBS`` whole numbers, lowest first; those of a value that is null or not finite are null."""
    finite = F.when(F.abs(value) < float("inf"), value)
    size, sign = F.abs(finite), F.signum(finite).cast("bigint")
    out = []
    for i in range(LIMBS):
        # the remainder of a division by a power of two is exact, and so is the division
        part = size if i == LIMBS - 1 else size % F.lit(_place(i + 1))
        out.append(F.floor(part / F.lit(_place(i))).cast("bigint") * sign)
    return out


def limb_arrays(values: np.ndarray) -> np.ndarray:
    """The same of an array of finite numbers, along a new first axis."""
    rest, sign = np.abs(values), np.sign(values).astype(np.int64)
    out = np.empty((LIMBS, *values.shape), np.int64)
    for i in reversed(range(LIMBS)):
        # both products are by a power of two, and what is taken off are leading bits, so all is exact; a remainder takes far longer
        part = np.floor(rest * (1 / _place(i)))
        rest = rest - part * _place(i)
        out[i] = part.astype(np.int64) * sign
    return out


def nearest(sums: np.ndarray) -> np.ndarray:
    """:func:`from_limbs` of an array of summed limbs along its first axis."""
    whole = sum(limb * (1 << LIMB_BITS * i) for i, limb in enumerate(sums.astype(object)))
    return np.array([math.ldexp(float(n), LOW_BIT) for n in whole], np.float64)


def exact_sums_by(values: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """:func:`exact_sum` of an array's finite values, by their group's number."""
    held = np.zeros((groups, LIMBS), np.int64)
    np.add.at(held, group, limb_arrays(values).T)
    return nearest(held.T)


def from_limbs(sums: list[Column]) -> Column:
    """The double nearest to the number that summed limbs stand for, ties to even.

    This runs once per group, in lambdas, so that the expression stays small.
    """
    zero = F.lit(0).cast("bigint")
    # two limbs more take what the highest sum carries over
    bound = F.array(F.array(*sums, zero, zero))
    signed = F.transform(bound, lambda a: F.struct(a.alias("a"), (_carried(a)["carry"] < 0).alias("negative")))
    digits = F.transform(
        signed,
        lambda x: F.struct(
            _carried(F.transform(x["a"], lambda s: F.when(x["negative"], -s).otherwise(s)))["digits"].alias("digits"), x["negative"].alias("negative")
        ),
    )
    value = F.transform(digits, lambda x: F.when(x["negative"], -_rounded(x["digits"])).otherwise(_rounded(x["digits"])))
    return F.get(value, 0)


def _carried(sums: Column) -> Column:
    """(carry, digits): limbs from 0 to the mask, the highest first, with what is over carried up; a carry left is -1 for a negative number."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

    def step(state: Column, s: Column) -> Column:
        full = state["carry"] + s
        digit = full.bitwiseAND(F.lit(_MASK).cast("bigint"))
        return F.struct(F.shiftright(full, LIMB_BITS).alias("carry"), F.array_prepend(state["digits"], digit).alias("digits"))

    return F.aggregate(sums, start, step)


def _rounded(digits: Column) -> Column:
    """From the highest limb that isn't 0, three hold more bits than a double, and one bit stands for all below."""
    number = lambda c: c.cast("decimal(38,0)")
    start = F.struct(
        number(F.lit(0)).alias("whole"), F.lit(0).alias("taken"), F.lit(False).alias("rest"), F.lit(LIMBS + 2).alias("place")
    )

    def step(state: Column, digit: Column) -> Column:
        take = (state["taken"] < 3) & ((state["taken"] > 0) | (digit > 0))
        longer = number(state["whole"] * F.lit(Decimal(1 << LIMB_BITS)) + digit.cast("decimal(19,0)"))
        return F.struct(
            F.when(take, longer).otherwise(state["whole"]).alias("whole"),
            (state["taken"] + take.cast("int")).alias("taken"),
            (state["rest"] | ((state["taken"] == 3) & (digit > 0))).alias("rest"),
            (state["place"] - F.when((state["taken"] == 3), 0).otherwise(1)).alias("place"),
        )

    def finish(state: Column) -> Column:
        whole = number(state["whole"] * F.lit(Decimal(2)) + state["rest"].cast("int").cast("decimal(19,0)"))
        places = F.array(*[F.lit(_place(i) / 2) for i in range(LIMBS + 2)])
        return whole.cast("double") * F.get(places, state["place"])

    return F.aggregate(digits, start, step, finish)


def exact_sum(value: Column) -> Column:
    """Aggregate like ``sum`` over doubles: null without values, and the same whatever the order of rows."""
    value = value.cast("double")
    # infinities and NaN add up to the same in any order
    special = F.sum(F.when(F.abs(value) < float("inf"), F.lit(None)).otherwise(value))
    total = from_limbs([F.coalesce(F.sum(limb), F.lit(0).cast("bigint")) for limb in limbs(value)])
    return F.when(F.count(value) > 0, F.coalesce(special, total))


def exact_sum_over(value: Column, window: WindowSpec) -> Column:
    """:func:`exact_sum` of finite values over a window."""
    total = from_limbs([F.coalesce(F.sum(limb).over(window), F.lit(0).cast("bigint")) for limb in limbs(value.cast("double"))])
    return F.when(F.count(value).over(window) > 0, total)


def exact_mean(value: Column) -> Column:
    return exact_sum(value) / F.count(value)


def exact_sum_named(name: str) -> Column:
    return exact_sum(F.col(name))


def limbs_total(*names: str) -> Column:
    """The double nearest to the sum of rows whose limbs are columns."""
    return from_limbs([F.sum(name) for name in names])
