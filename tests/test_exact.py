import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from varve.functions import exact


def summed(spark, groups):
    rows = [(g, v) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    return {r["g"]: r["s"] for r in df.groupBy("g").agg(exact.exact_sum(F.col("v")).alias("s")).collect()}


def test_sums_are_rounded_once(spark):
    rng = random.Random(1)
    draw = [
        lambda: rng.uniform(-1, 1),
        lambda: rng.uniform(-1, 1) * 10.0 ** rng.randint(-15, 20),
        lambda: rng.choice([1e16, 1.0, -1e16, 2.0**-60]),
        lambda: rng.random() * 2.0**80,
        lambda: -rng.random() * 2.0**-60,
    ]
    groups = {g: [draw[g % 5]() for _ in range(rng.choice([1, 2, 7, 300]))] for g in range(60)}
    got = summed(spark, groups)
    for g, values in groups.items():
        assert got[g] == math.fsum(values), values[:5]


def test_halves_round_to_even(spark):
    groups = {1: [2.0**53, 1.0], 2: [2.0**53 + 2, 1.0], 3: [2.0**53, 1.0, 2.0**-60], 4: [-(2.0**53), -1.0], 5: [1.0, -1.0], 6: [0.0, -0.0]}
    got = summed(spark, groups)
    assert got == {g: float(sum(map(Fraction, v))) for g, v in groups.items()}


def test_null_and_not_finite(spark):
    inf, nan = float("inf"), float("nan")
    got = summed(spark, {1: [None, None], 2: [None, 1.5], 3: [inf, 1.0], 4: [inf, -inf], 5: [nan, 1.0], 6: [-inf, 2.0]})
    assert got[1] is None and got[2] == 1.5 and got[3] == inf and math.isnan(got[4]) and math.isnan(got[5]) and got[6] == -inf


def test_bits_below_the_lowest_are_cut_from_each_value(spark):
    assert summed(spark, {1: [2.0**-121] * 4, 2: [1.0, 2.0**-119]}) == {1: 0.0, 2: 1.0}


def test_order_and_width_make_no_difference(spark):
    values = [(random.Random(i).lognormvariate(0, 12),) for i in range(2_000)]
    df = spark.createDataFrame(values, "v double")
    totals = {df.repartition(n, F.rand(n)).agg(exact.exact_sum(F.col("v"))).first()[0] for n in (1, 2, 7, 30)}
    assert totals == {math.fsum(v for v, in values)}
    plain = {df.repartition(n, F.rand(n)).agg(F.sum("v")).first()[0] for n in (1, 2, 7, 30)}
    assert len(plain) > 1  # the reason for all this


def test_arrays_have_the_same_limbs(spark):
    values = np.array([0.0, -1.5, 3e-30, 2.0**85, -math.pi * 1e9, 2.0**-120])
    rows = spark.createDataFrame([(float(v),) for v in values], "v double").select(*exact.limbs(F.col("v"))).collect()
    assert np.array(rows).T.tolist() == exact.limb_arrays(values).tolist()


def test_mean(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "v double")
    assert df.agg(exact.exact_mean(F.col("v"))).first()[0] == 1.5


@pytest.mark.parametrize("kind", ["float", "int"])
def test_other_numbers_are_doubles(spark, kind):
    assert spark.range(10).agg(exact.exact_sum(F.col("id").cast(kind))).first()[0] == 45.0


def test_arrays_have_the_same_sums(spark):
    rng = np.random.default_rng(2)
    values, group = rng.normal(size=200) * 2.0 ** rng.integers(-100, 80, 200), rng.integers(0, 7, 200)
    values[:4], group[:4] = (2.0**53, 1.0, 1.5, -1.5), (7, 7, 8, 8)
    found = exact.exact_sums_by(values, group, 9)
    assert found.tolist() == [math.fsum(values[group == g]) for g in range(9)]
