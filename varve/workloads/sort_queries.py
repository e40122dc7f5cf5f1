"""Source, sink and global-order queries, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from varve.operators import ordering
from varve.operators.blocks import Running, as_blocks, in_blocks, positions, running
from varve.operators.blocks import global_position as position_of
from varve.plans import jobs
from varve.session import fresh_path
from varve.sources import sinks, text
from varve.workloads import inputs as I

EVENT_SCHEMA = "event_id bigint, cca2 string, timestamp timestamp_ntz, user_id bigint, value double"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _event_rows(df, *more):
    stamp = F.date_format("timestamp", MICROS).alias("timestamp")
    return df.select("event_id", "cca2", stamp, "user_id", "value", *more)


_FILE, _START, _ROW = "_file", "_start", "_row"


def _in_file_order(read, *within):
    """Rows of part files with ``position``: files by name, rows as they stand in them; per ``within`` if given."""
    rows = read.select("*", F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.file_block_start").alias(_START))
    # within a file the reader's increasing ids follow the lines
    rows = rows.withColumn(_ROW, F.monotonically_increasing_id())
    placed = running(in_blocks(rows, [*within, _FILE, _START, _ROW]), within, [Running("position", "sum", F.lit(1), before=True)])
    return placed.drop(_FILE, _START, _ROW).withColumn("position", F.col("position").cast("bigint"))


def scan_csv_header(spark, sf_dir):
    path = fresh_path(spark, "events")
    writer = I.sort_events(spark, sf_dir).write.option("header", True)
    writer.option("timestampNTZFormat", sinks.MICROS_LAYOUT).csv(path)
    return _event_rows(text.scan_csv(spark, path, EVENT_SCHEMA))


def scan_csv_inferred(spark, sf_dir):
    path = fresh_path(spark, "customers")
    I.table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    inferred = text.scan_csv(spark, path)
    return inferred.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


def scan_delimited_fields(spark, sf_dir):
    path = fresh_path(spark, "orders")
    I.order_lines(spark, sf_dir).write.text(path)
    fields = text.scan_fields(spark, path)
    return fields.select(
        F.get("fields", 0).alias("field_0"),
        F.get("fields", 2).alias("field_2"),
        F.get("fields", 14).alias("field_14"),
        F.size("fields").cast("bigint").alias("n_fields"),
    )


def sink_csv_append(spark, sf_dir):
    path = fresh_path(spark, "events")
    events = I.sort_events(spark, sf_dir)
    early = F.coalesce(F.col("cca2") < "p", F.lit(True))  # nulls sort first
    for half in (events.where(early), events.where(~early)):
        sinks.append_sorted_csv(half, path, ["cca2", "timestamp"], ["event_id"])
    # one folder, two sorted appends: each is in order by itself
    written_rows = _in_file_order(spark.read.schema(EVENT_SCHEMA).csv(path).withColumn("early", early), "early")
    return _event_rows(written_rows, F.col("early").cast("int").alias("early"), "position")


def sink_sorted_parts(spark, sf_dir):
    path = fresh_path(spark, "orders")
    lines = I.order_lines(spark, sf_dir).select(F.split("value", ",", -1).alias("fields"))
    sinks.write_sorted_lines(lines.select(sinks.join_fields("fields")), path, 2)
    return _in_file_order(text.scan_lines(spark, path))


def sort_csv_file(spark, sf_dir):
    """CSV with a header in, sorted part files out, rows read back."""
    source, target = fresh_path(spark, "customers"), fresh_path(spark, "sorted")
    customers = I.table(spark, sf_dir, "customer")
    customers.write.option("header", True).csv(source)
    jobs.sort_csv(spark, source, target, ["c_mktsegment", "c_nationkey"])
    return _in_file_order(spark.read.schema(customers.schema).csv(target))


def row_count(spark, sf_dir):
    return I.sort_events(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"))


def sort_two_keys(spark, sf_dir):
    placed = ordering.sort_position(I.sort_events(spark, sf_dir), ["cca2", "timestamp"], ["event_id"])
    return placed.select("position", "event_id", "cca2", "user_id", "value")


def sort_two_keys_rows(spark, sf_dir):
    rows = _event_rows(ordering.sort_rows(I.sort_events(spark, sf_dir), ["cca2", "timestamp"], ["event_id"]))
    return positions(as_blocks(rows))


def sort_by_first_key(spark, sf_dir):
    keyed = ordering.keyed_lines(I.order_lines(spark, sf_dir), 2)
    return ordering.sort_position(keyed, ["sort_key"])


def sort_common_rows(spark, sf_dir):
    """Whole-row sort of a table that is nearly all exact copies."""
    flags = I.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    return ordering.sort_position(flags, ["l_returnflag"])


def position_long_text(spark, sf_dir):
    """Keys that share a long beginning."""
    texts = I.table(spark, sf_dir, "documents").select("doc_id", F.concat(F.repeat(F.lit("p"), 300), "text").alias("key"))
    return position_of(texts, ["key", "doc_id"]).select("doc_id", "position")


def global_position(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return position_of(orders, ["o_custkey", "o_orderkey"])


QUERIES = {
    f.__name__: f
    for f in (
        scan_csv_header,
        scan_csv_inferred,
        scan_delimited_fields,
        sink_csv_append,
        sink_sorted_parts,
        sort_csv_file,
        row_count,
        sort_two_keys,
        sort_two_keys_rows,
        sort_by_first_key,
        sort_common_rows,
        global_position,
        position_long_text,
    )
}

_EVENTS = """SELECT event_id, event_type AS cca2, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, user_id, value
FROM events"""

ORACLES = {
    "scan_csv_header": _EVENTS,
    "scan_csv_inferred": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "scan_delimited_fields": """SELECT CAST(o_orderkey AS VARCHAR) AS field_0, o_orderpriority AS field_2,
strftime(o_orderdate, '%Y-%m-%d') AS field_14, CAST(15 AS BIGINT) AS n_fields FROM orders""",
    "sink_csv_append": f"""SELECT *, CAST(row_number() OVER (PARTITION BY early ORDER BY cca2 NULLS FIRST, timestamp, event_id) - 1 AS BIGINT) AS position
FROM (SELECT *, CAST(coalesce(cca2 < 'p', true) AS INTEGER) AS early FROM ({_EVENTS}))""",
    "sink_sorted_parts": f"""WITH {I.ORDER_LINES_SQL}
SELECT value, CAST(row_number() OVER (ORDER BY sort_key, value) - 1 AS BIGINT) AS position FROM order_lines""",
    "sort_csv_file": """SELECT *, CAST(row_number() OVER (ORDER BY c_mktsegment, c_nationkey, c_custkey) - 1 AS BIGINT) AS position
FROM customer""",
    "row_count": "SELECT count(*) AS rows FROM events",
    "sort_two_keys": """SELECT row_number() OVER (ORDER BY event_type, ts, event_id) - 1 AS position,
event_id, event_type AS cca2, user_id, value FROM events""",
    "sort_two_keys_rows": f"""SELECT *, CAST(row_number() OVER (ORDER BY cca2 NULLS FIRST, timestamp, event_id) - 1 AS BIGINT) AS position
FROM ({_EVENTS})""",
    "sort_by_first_key": f"""WITH {I.ORDER_LINES_SQL}
SELECT sort_key, value, row_number() OVER (ORDER BY sort_key, value) - 1 AS position FROM order_lines""",
    "sort_common_rows": """SELECT l_returnflag, l_linestatus,
row_number() OVER (ORDER BY l_returnflag, l_linestatus) - 1 AS position FROM lineitem""",
    "position_long_text": """SELECT doc_id,
CAST(row_number() OVER (ORDER BY repeat('p', 300) || text, doc_id) - 1 AS BIGINT) AS position FROM documents""",
    "global_position": """SELECT o_custkey, o_orderkey, o_totalprice,
row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS position FROM orders""",
}
