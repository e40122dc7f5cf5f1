"""Input frames for the registered queries, derived from the given tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.operators.blocks import in_blocks, next_value
from varve.operators.sharding import split_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Graphs -------------------------------------------------------------------


def handoff_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user -> user of the next event of the same type."""
    events = table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "user_id")
    blocked = in_blocks(events, ["event_type", "ts", "event_id"])
    following = next_value(blocked, ["event_type"], "user_id", "dst")
    return following.where("dst is not null").select(F.col("user_id").alias("src"), "dst")


HANDOFF_SQL = """
handoff AS (
  SELECT user_id AS src, nxt AS dst FROM (
    SELECT user_id, lead(user_id) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS nxt FROM events
  ) WHERE nxt IS NOT NULL)"""


def link_names() -> tuple[Column, Column]:
    """The page names of a line item's part and supplier."""
    part = (
        F.when(F.col("l_partkey") % 10 == 0, "Category:Part_")
        .when(F.col("l_partkey") % 10 == 1, "Talk:Part_")
        .otherwise("Part_")
    )
    supplier = (
        F.when(F.col("l_suppkey") % 10 == 0, "Category:Supplier_")
        .when(F.col("l_suppkey") % 10 == 1, "Help:Supplier_")
        .otherwise("Supplier_")
    )
    return F.concat(part, F.col("l_partkey").cast("string")), F.concat(supplier, F.col("l_suppkey").cast("string"))


def link_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two link lines per line item, part <-> supplier, with namespaces, stray tabs and missing tabs."""
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber")
    part, supplier = link_names()
    gap = F.when(F.col("l_linenumber") == 5, " ").otherwise("\t")
    tail = F.when(F.col("l_linenumber") == 3, "\tx").otherwise("")
    forward = F.concat(part, gap, supplier, tail)
    backward = F.concat(supplier, F.lit("\t"), part)
    return items.select(F.explode(F.array(forward, backward)).alias("value"))


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(number, value): both names of a line item with a line break between, and for every third number one at the end."""
    items = table(spark, sf_dir, "lineitem")
    part, supplier = link_names()
    tail = F.when(F.col("l_linenumber") % 3 == 0, "\u2028").otherwise("")
    return items.select(F.col("l_linenumber").alias("number"), F.concat(part, F.lit("\x0b"), supplier, tail).alias("value"))


LINK_LINES_SQL = """
names AS (
  SELECT l_linenumber AS n,
    CASE l_partkey % 10 WHEN 0 THEN 'Category:Part_' WHEN 1 THEN 'Talk:Part_' ELSE 'Part_' END || l_partkey AS p,
    CASE l_suppkey % 10 WHEN 0 THEN 'Category:Supplier_' WHEN 1 THEN 'Help:Supplier_' ELSE 'Supplier_' END || l_suppkey AS s
  FROM lineitem),
lines AS (
  SELECT p || CASE WHEN n = 5 THEN ' ' ELSE chr(9) END || s || CASE WHEN n = 3 THEN chr(9) || 'x' ELSE '' END AS value FROM names
  UNION ALL SELECT s || chr(9) || p FROM names),
cut AS (
  SELECT lower(value) AS v, strpos(lower(value), chr(9)) AS t FROM lines WHERE strpos(value, chr(9)) > 0),
links_line AS (
  SELECT v[:t-1] AS src, v[t+1:] AS dst FROM cut
  WHERE strpos(v, ':') = 0 OR starts_with(v, 'category:')),
links_field AS (
  SELECT v[:t-1] AS src, v[t+1:] AS dst FROM cut
  WHERE (strpos(v[:t-1], ':') = 0 OR starts_with(v[:t-1], 'category:'))
    AND (strpos(v[t+1:], ':') = 0 OR starts_with(v[t+1:], 'category:')))"""


def flag_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """return flag <-> supplier: three nodes hold half of all edges as sources."""
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_suppkey")
    flag = F.col("l_returnflag")
    supplier = F.col("l_suppkey").cast("string")
    both = F.array(
        F.struct(flag.alias("src"), supplier.alias("dst")), F.struct(supplier.alias("src"), flag.alias("dst"))
    )
    return items.select(F.inline(both))


FLAG_SQL = """
flags AS (
  SELECT l_returnflag AS src, CAST(l_suppkey AS VARCHAR) AS dst FROM lineitem
  UNION ALL SELECT CAST(l_suppkey AS VARCHAR), l_returnflag FROM lineitem)"""


def order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order -> customer: acyclic, and every order is a source only."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("src"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("dst"),
    )


ORDER_EDGES_SQL = """
order_edges AS (SELECT 'o' || o_orderkey AS src, 'c' || o_custkey AS dst FROM orders)"""


def ladder_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order -> customer -> nation -> region, acyclic."""
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")

    def named(prefix: str, key: str):
        return F.concat(F.lit(prefix), F.col(key).cast("string"))

    upper = customers.select(named("c", "c_custkey").alias("src"), named("n", "c_nationkey").alias("dst"))
    top = nations.select(named("n", "n_nationkey").alias("src"), named("r", "n_regionkey").alias("dst"))
    return order_edges(spark, sf_dir).unionByName(upper).unionByName(top)


LADDER_SQL = f"""{ORDER_EDGES_SQL},
ladder AS (
  SELECT src, dst FROM order_edges
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation)"""


# Sort inputs --------------------------------------------------------------


def sort_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under the sort columns' own names."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("cca2"),
        F.col("ts").alias("timestamp"),
        "user_id",
        "value",
    )


ORDER_LINE_HEADER = "f0,f1,cca2,f3,f4,f5,f6,f7,f8,f9,f10,f11,f12,f13,timestamp"


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-field lines: priority at index 2, date at 14."""
    orders = table(spark, sf_dir, "orders")
    fields = [
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
        F.col("o_orderpriority"),
        *[F.lit(f"k{i}") for i in range(3, 14)],
        F.date_format("o_orderdate", "yyyy-MM-dd"),
    ]
    return orders.select(F.concat_ws(",", *fields).alias("value"))


ORDER_LINES_SQL = """
order_lines AS (
  SELECT concat_ws(',', o_orderkey, o_custkey, o_orderpriority,
    'k3','k4','k5','k6','k7','k8','k9','k10','k11','k12','k13', strftime(o_orderdate, '%Y-%m-%d')) AS value,
    o_orderpriority AS sort_key
  FROM orders)"""


# Labelled examples --------------------------------------------------------

CLASSES = 10
FEATURES = 64


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features"), "label"
    )


def train_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples(spark, sf_dir).where(split_of("id") == "train")


def test_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples(spark, sf_dir).where(split_of("id") == "test")


EXAMPLES_SQL = """
examples AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, label,
    CASE WHEN substr(md5(CAST(vec_id AS VARCHAR)), 1, 1) < 'd' THEN 'train' ELSE 'test' END AS split
  FROM embeddings),
train AS (SELECT id, x, label FROM examples WHERE split = 'train'),
test AS (SELECT id, x, label FROM examples WHERE split = 'test')"""


# Phase logs ---------------------------------------------------------------

PHASE_OF = {
    "click": "forward",
    "view": "backward",
    "purchase": "optimize",
    "error": "communication",
    "signup": "tick",
}


def phase_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.create_map(*[F.lit(text) for pair in PHASE_OF.items() for text in pair])
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"),
        "ts",
        "event_id",
        names[F.col("event_type")].alias("phase"),
        F.col("value").alias("duration"),
    )


_PHASE_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PHASE_OF.items())
PHASE_LOG_SQL = f"""
log AS (
  SELECT user_id AS run, ts, event_id, CASE event_type {_PHASE_CASE} END AS phase, value AS duration,
    epoch_us(ts) AS us
  FROM events)"""

TAGGED_SQL = f"""{PHASE_LOG_SQL},
ticked AS (
  SELECT *, phase = 'tick' AS is_tick,
    sum(CASE WHEN phase = 'tick' THEN 1 ELSE 0 END) OVER w AS ticks,
    max(CASE WHEN phase = 'tick' THEN us END) OVER (PARTITION BY run ORDER BY us, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_tick,
    min(us) OVER (PARTITION BY run) AS run_start
  FROM log WINDOW w AS (PARTITION BY run ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)),
tagged AS (
  SELECT run, event_id, phase, duration, CAST(ticks - CASE WHEN is_tick THEN 1 ELSE 0 END AS BIGINT) AS iteration,
    CASE WHEN is_tick THEN us - coalesce(last_tick, run_start) END AS took
  FROM ticked)"""
