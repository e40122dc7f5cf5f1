import random

import numpy as np
import pytest

from tests.llm import brute
from varve.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def nearest(spark, rows, k=5, schema=SCHEMA, every=50):
    found = topk.top_k(spark.createDataFrame(rows, schema).repartition(3), lambda v: v % every == 0, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


def vectors(count, width=8, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(size=width).astype(np.float32).tolist(), 0) for i in range(count)]


@pytest.mark.parametrize("bins, values", [(512, 262_144), (3, 20)])
def test_equals_brute_force(spark, monkeypatch, bins, values):
    monkeypatch.setattr(topk, "BINS", bins)
    monkeypatch.setattr(topk, "QUERY_VALUES", values)
    monkeypatch.setattr(topk, "STEP_SCORES", 1000)
    rows = vectors(400)
    assert nearest(spark, rows) == brute.nearest(rows, 5)
    assert nearest(spark, rows, k=399, every=200) == brute.nearest(rows, 399, 200)


def test_equal_vectors_go_by_id(spark):
    rng = random.Random(2)
    rows = [(i, [1.0, 0.5], 0) if rng.random() < 0.5 else (i, [rng.random(), rng.random()], 0) for i in range(300)]
    assert nearest(spark, rows) == brute.nearest(rows, 5)
    same = [(i, [0.1, -0.1], 0) for i in range(200)]
    assert [r[2] for r in nearest(spark, same) if r[0] == 0] == [1, 2, 3, 4, 5]
    assert [r[2] for r in nearest(spark, same) if r[0] == 50] == [0, 1, 2, 3, 4]


def test_few_vectors_and_empty_tables(spark):
    assert nearest(spark, []) == []
    assert nearest(spark, [(0, [1.0], 0)]) == []
    assert nearest(spark, [(1, [1.0], 0), (2, [1.0], 0)]) == []
    assert nearest(spark, [(0, [1.0], 0), (7, [-1.0], 0)]) == [(0, 1, 7, -65536)]


def test_vectors_that_take_no_part(spark):
    rows = [
        (0, [1.0, 1.0], 0), (1, None, 0), (2, [], 0), (3, [1.0, None], 0), (4, [float("nan"), 1.0], 0),
        (5, [float("inf"), 1.0], 0), (6, [1.0], 0), (None, [9.0, 9.0], 0), (8, [0.001, -0.001], 0), (50, [1e30, 1.0], 0),
        (100, None, 0), (150, [2.0], 0),
    ]
    assert nearest(spark, rows) == [(0, 1, 8, -256), (150, 1, 6, 131072)]


def test_repeated_ids(spark):
    rows = [(0, [1.0], 0), (0, [2.0], 0), (3, [1.0], 0), (3, [1.0], 1)]
    assert nearest(spark, rows) == sorted([(0, 1, 3, 65536), (0, 2, 3, 65536), (0, 1, 3, 131072), (0, 2, 3, 131072)])


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    for scale in (30.0, 1e4, 1e6):  # float32, float64, whole numbers
        rows = [(i, (rng.normal(size=4) * scale).astype(np.float32).tolist(), 0) for i in range(120)]
        assert nearest(spark, rows) == brute.nearest(rows, 5)
    kinds = [topk._kind(x) for x in (2.0**40, 2.0**60, 2.0**110)]
    assert kinds == [np.float32, np.float64, np.int64]


def test_histograms_are_cut_at_k(spark):
    rows = topk.whole_vectors(spark.createDataFrame(vectors(300, 2), SCHEMA).coalesce(1)).select("id", "v").toArrow().to_batches()

    class Held:
        def __init__(self, value):
            self.value = value

    queries, names = np.array([[256, 0]]), np.array([-1])
    shared = Held((np.array([-2000]), np.array([2096]), np.zeros(1, bool), 8))
    (counts,) = topk._histogram(Held((queries, names)), shared, np.float64, 5)(iter(rows))
    times = counts.column("times").to_numpy()
    assert times.sum() >= 5 and len(times) <= 5
