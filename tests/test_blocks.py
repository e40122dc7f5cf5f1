import random

import pytest
from pyspark.sql import functions as F

from varve.operators import blocks
from varve.operators.blocks import Running, global_position, in_blocks, next_value, running
from varve.operators.ordering import keyed_lines, sort_lines, sort_position, sort_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds nearly all rows, some keys are null."""
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.9 else rng.choice(["a", "z", None]), rng.randint(0, 50), i, rng.randint(-9, 9)) for i in range(3000)]
    return spark.createDataFrame(rows, "g string, t int, id int, v int"), rows


def _by_group(rows):
    groups = {}
    for g, t, i, v in rows:
        groups.setdefault(g, []).append((t, i, v))
    return {g: sorted(r) for g, r in groups.items()}


@pytest.mark.parametrize("count", [1, 2, 7, 40])
def test_running_matches_brute_force(skewed, count):
    df, rows = skewed
    blocked = in_blocks(df, ["g", "t", "id"], blocks=count)
    assert blocked.rows.select(blocks.BLOCK).distinct().count() == count
    measures = [
        Running("total", "sum", F.col("v")),
        Running("seen", "sum", F.lit(1), before=True),
        Running("peak", "max", F.when(F.col("v") > 5, F.col("v")), before=True),
        Running("low", "min", F.col("v")),
    ]
    got = {r["id"]: r for r in running(blocked, ["g"], measures).collect()}
    assert len(got) == len(rows)
    for group in _by_group(rows).values():
        total, peak, low = 0, None, None
        for seen, (_, i, v) in enumerate(group):
            assert (got[i]["seen"], got[i]["peak"]) == (seen, peak)
            total += v
            low = v if low is None else min(low, v)
            assert (got[i]["total"], got[i]["low"]) == (total, low)
            if v > 5:
                peak = v if peak is None else max(peak, v)


@pytest.mark.parametrize("count", [1, 7, 40])
def test_next_value_crosses_blocks(skewed, count):
    df, rows = skewed
    got = {r["id"]: r["nxt"] for r in next_value(in_blocks(df, ["g", "t", "id"], blocks=count), ["g"], "v", "nxt").collect()}
    for group in _by_group(rows).values():
        following = [v for _, _, v in group[1:]] + [None]
        assert [got[i] for _, i, _ in group] == following


def test_hot_group_is_spread_over_blocks(skewed):
    df, _ = skewed
    blocked = in_blocks(df, ["g", "t", "id"], blocks=10)
    sizes = [r["count"] for r in blocked.rows.groupBy(blocks.BLOCK).count().collect()]
    assert max(sizes) < 900


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_running_and_positions_exchange_rows_once(skewed):
    df, _ = skewed
    blocked = in_blocks(df, ["g", "t", "id"], blocks=10)
    text = plan_of(running(blocked, ["g"], [Running("seen", "sum", F.lit(1), before=True)]))
    assert text.count("Exchange shufflepartitionidpassthrough") == 1
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Exchange" not in plan_of(blocks.positions(blocked)).replace("BroadcastExchange", "").split("Window")[0]


def test_long_common_beginnings_fill_blocks_evenly(spark):
    df = spark.range(40_000).selectExpr("id", "repeat('p', 300) || sha2(string(id), 256) AS s")
    sizes = [r["count"] for r in in_blocks(df, ["s", "id"], blocks=8).rows.groupBy(blocks.BLOCK).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * 40_000 / 8


def test_a_common_row_is_spread_by_sorts(spark):
    df = spark.range(20_000).selectExpr("if(id % 4 = 0, string(id), 'same') AS s")
    ordered = sort_rows(df, ["s"])
    assert plan_of(ordered).count("Exchange rangepartitioning") == 1 and plan_of(ordered).count("Exchange") == 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # which would join such small partitions
    try:
        sizes = [r["count"] for r in blocks.as_blocks(ordered).rows.groupBy(blocks.BLOCK).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 5_500


def test_keys_of_every_common_type(spark):
    df = spark.range(3000).selectExpr(
        "id", "cast(id % 7 as string) || '\"\\\\é' AS s", "timestamp_micros(id * 1234567) AS t",
        "cast(id / 7 as double) AS d", "cast(id as decimal(20, 3)) AS m", "date_from_unix_date(id % 50) AS day",
        "if(id % 3 = 0, null, id % 5) AS n", "id % 2 = 0 AS b", "cast(id / 3 as float) AS f",
        "cast(timestamp_micros(id * 7654321) as timestamp_ntz) AS z",
    )
    for key in ("s", "t", "d", "m", "day", "n", "b", "f", "z"):
        blocked = in_blocks(df, [key, "id"], blocks=9)
        placed = running(blocked, (), [Running("at", "sum", F.lit(1), before=True)])
        got = [r["id"] for r in placed.orderBy("at").select("id").collect()]
        assert got == [r["id"] for r in df.orderBy(key, "id").select("id").collect()], key


def test_long_text_keys_keep_their_order(spark):
    df = spark.range(2000).selectExpr("id", "repeat('x', 40 * cast(id % 20 as int)) || id AS s")
    blocked = in_blocks(df, ["s", "id"], blocks=9)
    placed = running(blocked, (), [Running("at", "sum", F.lit(1), before=True)])
    got = [r["id"] for r in placed.orderBy("at").select("id").collect()]
    assert got == [r["id"] for r in df.orderBy("s", "id").select("id").collect()]


def test_group_must_lead_the_keys(skewed):
    df, _ = skewed
    with pytest.raises(ValueError):
        running(in_blocks(df, ["t", "g", "id"], blocks=2), ["g"], [Running("n", "sum", F.lit(1))])


def test_empty_input(spark):
    empty = spark.createDataFrame([], "g string, id int")
    assert global_position(empty, ["g", "id"]).count() == 0


def test_two_key_sort(spark):
    df = spark.createDataFrame([("US", 3), ("FR", 2), ("US", 1), ("FR", 1), ("US", 1), (None, 9)], "cca2 string, timestamp int")
    want = [(None, 9), ("FR", 1), ("FR", 2), ("US", 1), ("US", 1), ("US", 3)]
    assert [tuple(r) for r in sort_rows(df, ["cca2", "timestamp"]).collect()] == want
    placed = sort_position(df, ["cca2", "timestamp"]).orderBy("position").collect()
    assert [(r[0], r[1]) for r in placed] == want
    assert [r["position"] for r in placed] == list(range(6))


def test_one_key_line_sort_and_header(spark):
    lines = spark.createDataFrame([("h,h,name",), ("1,a,US",), ("2,\"b,c\",FR",), ("3,a,FR",), ("4",)], "value string")
    ordered = [r["value"] for r in sort_lines(lines, 2, header="h,h,name").collect()]
    assert ordered == ["4", "3,a,FR", "1,a,US", '2,"b,c",FR']
    assert "h,h,name" in [r["value"] for r in sort_lines(lines, 2).collect()]
    # quotes have no meaning: field 2 of the quoted line is the tail of its second column
    assert keyed_lines(lines, 2).where("value like '2,%'").first()["sort_key"] == 'c"'
