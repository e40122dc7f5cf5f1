import pytest
from pyspark.sql import functions as F

from varve.operators import permutation, sharding
from varve.operators.permutation import Permutation


def drawn(spark, n, key="k"):
    rows = Permutation(n, key).of(spark.range(n).withColumnRenamed("id", "at"), "at", "to")
    return [r["to"] for r in rows.orderBy("at").collect()]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 16, 17, 101, 1000])
def test_every_position_once(spark, n):
    assert sorted(drawn(spark, n)) == list(range(n))


def test_keys_give_different_orders(spark):
    a, b = drawn(spark, 400, "a"), drawn(spark, 400, "b")
    assert a == drawn(spark, 400, "a") and a != b
    assert sum(x == y for x, y in zip(a, b)) < 12
    assert sum(abs(x - y) == 1 for x, y in zip(a, a[1:])) < 12  # neighbours part
    assert abs(sum(i * x for i, x in enumerate(a)) / sum(i * i for i in range(400)) - 0.75) < 0.08  # no trend


def test_numbers_beyond_the_last_are_fewer_than_the_root():
    for n in (2, 10, 99, 100, 101, 10**6 + 3, 10**12 + 7):
        high, low = Permutation(n, "k").digits
        assert n <= high * low < n + high and high <= n**0.5 + 1


def test_long_ways_end_within(spark, monkeypatch):
    # one digit of one value each round: every number beyond needs several steps
    class Slow(Permutation):
        def once(self, position):
            return F.when(position == 49, 0).otherwise(position + 1).cast("bigint")

        @property
        def digits(self):
            return 5, 10

    ways = {r["beyond"]: r["within"] for r in Slow(30, "k").outside(spark).collect()}
    assert ways == {i: 0 for i in range(30, 50)}


def test_large_tables_are_refused():
    with pytest.raises(ValueError):
        Permutation(permutation.MAX_POSITIONS + 1, "k")


def test_epochs_deal_every_row_and_sort_nothing(spark):
    rows = sharding.numbered(spark.range(0, 3030, 10).withColumn("label", F.lit(1)))
    seen = []
    for epoch in range(3):
        dealt = sharding.assign_shards_permuted(rows, 4, epoch=epoch, total=303)
        text = dealt._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in text and "hashpartitioning" not in text and "Sort" not in text
        got = dealt.collect()
        assert dealt.columns == ["id", "label", "position", "shard", "place"]
        assert sorted(r["position"] for r in got) == list(range(304))  # one row twice, so that shards are equal
        assert all(r["shard"] == r["position"] % 4 and r["place"] == r["position"] // 4 for r in got)
        seen.append([r["id"] for r in sorted(got, key=lambda r: r["position"])])
        assert seen[-1][303] == seen[-1][0] and len(set(seen[-1])) == 303
    assert seen[0] != seen[1] != seen[2]


def test_no_rows(spark):
    rows = sharding.numbered(spark.range(0))
    assert sharding.assign_shards_permuted(rows, 4).count() == 0
    assert sharding.assign_shards_permuted(rows, 4).columns == ["id", "position", "shard", "place"]
