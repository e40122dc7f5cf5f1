"""Link parsing and ranking queries, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.functions.text import djb2
from varve.operators import graph, partitioning
from varve.operators.links import parse_links
from varve.plans.jobs import rank_links
from varve.plans.pagerank import compact_pagerank, pagerank, resumable_pagerank
from varve.session import fresh_path, written
from varve.sources import sinks
from varve.sources.text import scan_file_lines, scan_lines
from varve.workloads import inputs as I


def _rounded(ranks: DataFrame, column: str = "rank", places: int = 6) -> DataFrame:
    return ranks.withColumn(column, F.round(column, places))


def _links(spark: SparkSession, sf_dir: str, mode: str = "line") -> DataFrame:
    return parse_links(I.link_lines(spark, sf_dir), mode)


def pagerank_sql(ctes: str, edges: str, rounds: int) -> str:
    steps = [
        f"deg AS (SELECT src, count(*) AS n FROM {edges} GROUP BY src)",
        f"share AS (SELECT e.src, e.dst, 1.0::DOUBLE / d.n AS s FROM {edges} e JOIN deg d ON e.src = d.src)",
        "r0 AS (SELECT src AS node, 1.0::DOUBLE AS rank FROM deg)",
    ]
    for k in range(1, rounds + 1):
        steps.append(
            f"r{k} AS (SELECT dst AS node, 0.15::DOUBLE + 0.85::DOUBLE * sum(s * rank) AS rank"
            f" FROM share JOIN r{k - 1} ON src = node GROUP BY dst)"
        )
    return f"WITH {ctes}, {', '.join(steps)} SELECT node, round(rank, 6) AS rank FROM r{rounds}"


def pagerank_1(spark, sf_dir):
    return _rounded(pagerank(I.handoff_edges(spark, sf_dir), rounds=1))


def pagerank_10(spark, sf_dir):
    return _rounded(pagerank(I.handoff_edges(spark, sf_dir)))


def pagerank_10_links(spark, sf_dir):
    return _rounded(pagerank(_links(spark, sf_dir), store="plan"))


def pagerank_10_partitioned(spark, sf_dir):
    return _rounded(pagerank(_links(spark, sf_dir, "field"), store="table", parts="data"))


def pagerank_10_persisted(spark, sf_dir):
    return _rounded(pagerank(_links(spark, sf_dir), store="memory"))


def pagerank_10_checkpointed(spark, sf_dir):
    return _rounded(pagerank(_links(spark, sf_dir), store="table", cut_every=3))


def pagerank_10_hubs(spark, sf_dir):
    return _rounded(pagerank(I.flag_edges(spark, sf_dir), hub_edges=1_000))


def pagerank_acyclic(spark, sf_dir):
    return _rounded(pagerank(I.ladder_edges(spark, sf_dir), rounds=2))


def scan_text_lines(spark, sf_dir):
    path = fresh_path(spark, "links")
    I.link_lines(spark, sf_dir).write.text(path)
    return scan_lines(spark, f"{path}/part-*")


def scan_whole_files(spark, sf_dir):
    """Files of link lines, one folder per line number, with breaks inside and at the end of lines."""
    path = fresh_path(spark, "links")
    I.broken_lines(spark, sf_dir).write.partitionBy("number").text(path)
    lines = scan_file_lines(spark, f"{path}/*")
    folder = F.regexp_extract("file", r"/number=(\d+)/", 1).cast("int")
    return lines.groupBy(folder.alias("number"), "value").agg(F.count(F.lit(1)).alias("copies"))


def parse_links_line(spark, sf_dir):
    return _links(spark, sf_dir)


def parse_links_field(spark, sf_dir):
    return _links(spark, sf_dir, "field")


def pagerank_10_exact(spark, sf_dir):
    """Unrounded ranks of two widths and two stores, which are the same bit for bit, beside their rounded values."""
    edges = written(I.handoff_edges(spark, sf_dir), "edges")
    wide = pagerank(edges, parts=13, landed=True, exact=True)
    narrow = pagerank(edges, parts=3, landed=True, exact=True, store="memory").select("node", F.col("rank").alias("other"))
    return wide.join(narrow, "node", "full").select(
        "node", F.round("rank", 6).alias("rank"), (F.col("rank") == F.col("other")).alias("same")
    )


def pagerank_10_compact(spark, sf_dir):
    return _rounded(compact_pagerank(_links(spark, sf_dir)))


def pagerank_10_resumed(spark, sf_dir):
    """Six rounds, then a second call that goes on from what the first put on record."""
    folder = fresh_path(spark, "job")
    edges = written(I.handoff_edges(spark, sf_dir), "edges")
    resumable_pagerank(edges, folder, rounds=6, cut_every=3)
    return _rounded(resumable_pagerank(edges, folder, rounds=10, cut_every=3))


def hub_sources(spark, sf_dir):
    return graph.heavy_sources(I.flag_edges(spark, sf_dir), 16, at_least=100).select("src", "out_degree")


def djb2_hash(spark, sf_dir):
    nodes = graph.out_degree(_links(spark, sf_dir, "field"))
    return nodes.select(F.col("src").alias("node"), djb2(F.col("src")).alias("hash"))


def djb2_texts(spark, sf_dir):
    return I.table(spark, sf_dir, "documents").select("doc_id", djb2(F.col("text")).alias("hash"))


def partition_by_djb2(spark, sf_dir):
    placed = partitioning.nodes_by_word_hash(_links(spark, sf_dir, "field"))
    return placed.select(
        F.col("src").alias("node"), "out_degree", "part", F.spark_partition_id().alias("placed_on")
    )


def out_degree(spark, sf_dir):
    return graph.out_degree(I.handoff_edges(spark, sf_dir))


def adjacency_list(spark, sf_dir):
    lists = graph.adjacency_list(I.handoff_edges(spark, sf_dir), per_row=20)
    pairs = F.transform("neighbors", lambda n: F.concat_ws("x", n["dst"].cast("string"), n["copies"].cast("string")))
    return lists.select("src", "part", F.array_join(pairs, " ").alias("neighbors"))


def rank_contributions(spark, sf_dir):
    edges = written(_links(spark, sf_dir), "edges")
    return _rounded(graph.rank_contributions(edges, graph.first_ranks(edges)), "contribution")


def edges_by_djb2(spark, sf_dir):
    """Edges of a graph with three hubs, placed by the hash of their source; how many there are, and whether all partitions stay below twice the mean."""
    placed = partitioning.place_rows_by_word_hash(I.flag_edges(spark, sf_dir), "src")
    held = written(placed.select("src", "part", F.spark_partition_id().alias("placed_on")), "placed")
    sizes = held.groupBy("placed_on").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("part").alias("parts"))
    even = sizes.agg(((F.max("rows") < 2 * F.avg("rows")) & (F.max("parts") == 1)).alias("even"))
    return held.groupBy("src", "part").agg(F.count(F.lit(1)).alias("edges")).join(F.broadcast(even))


def adjacency_by_djb2(spark, sf_dir):
    lists = partitioning.adjacency_by_word_hash(_links(spark, sf_dir, "field"), per_row=20)
    neighbors = F.array_join(F.transform("neighbors", lambda n: F.concat_ws("x", n["dst"], n["copies"].cast("string"))), " ")
    return lists.select(
        "src", "list_part", neighbors.alias("neighbors"), "part", F.spark_partition_id().alias("placed_on")
    )


def sink_rank_text(spark, sf_dir):
    """Raw rank lines of large ranks: order prices in hundredths, with halves."""
    path = fresh_path(spark, "ranks")
    orders = I.table(spark, sf_dir, "orders")
    rank = F.round(F.col("o_totalprice") * 100) + F.when(F.col("o_orderkey") % 2 == 0, 0.5).otherwise(0.0)
    sinks.write_rank_tsv(orders.select(F.col("o_orderkey").alias("node"), rank.alias("rank")), path)
    return scan_lines(spark, path)


def source_only_nodes(spark, sf_dir):
    return graph.source_only_nodes(I.order_edges(spark, sf_dir))


def sink_rank_tuple(spark, sf_dir):
    path = fresh_path(spark, "ranks")
    sinks.write_rank_tuples(pagerank(I.handoff_edges(spark, sf_dir)), path)
    line = F.col("value")
    found = F.regexp_extract(line, r"^\('(.*)', ([^ ]+)\)$", 1)
    rank = F.regexp_extract(line, r"^\('(.*)', ([^ ]+)\)$", 2)
    return scan_lines(spark, path).select(found.alias("node"), F.round(rank.cast("double"), 6).alias("rank"))


def sink_rank_tsv(spark, sf_dir):
    path = fresh_path(spark, "ranks")
    sinks.write_rank_tsv(pagerank(I.handoff_edges(spark, sf_dir)), path)
    pair = F.split("value", "\t", 2)
    return scan_lines(spark, path).select(
        F.get(pair, 0).alias("node"), F.round(F.get(pair, 1).cast("double"), 6).alias("rank")
    )


def rank_link_files(spark, sf_dir):
    """Link files in, rank lines out, rank lines read back."""
    links, ranks = fresh_path(spark, "links"), fresh_path(spark, "ranks")
    I.link_lines(spark, sf_dir).write.text(links)
    rank_links(spark, f"{links}/part-*", ranks, "field", "tsv")
    pair = F.split("value", "\t")
    node = F.array_join(F.slice(pair, 1, F.size(pair) - 1), "\t")
    return scan_lines(spark, ranks).select(
        node.alias("node"), F.round(F.element_at(pair, -1).cast("double"), 6).alias("rank")
    )


QUERIES = {
    f.__name__: f
    for f in (
        rank_link_files,
        pagerank_1,
        pagerank_10,
        pagerank_10_links,
        pagerank_10_partitioned,
        pagerank_10_persisted,
        pagerank_10_checkpointed,
        pagerank_10_hubs,
        pagerank_10_exact,
        pagerank_10_compact,
        pagerank_10_resumed,
        pagerank_acyclic,
        hub_sources,
        scan_text_lines,
        scan_whole_files,
        parse_links_line,
        parse_links_field,
        djb2_hash,
        djb2_texts,
        partition_by_djb2,
        out_degree,
        adjacency_list,
        rank_contributions,
        source_only_nodes,
        sink_rank_tuple,
        sink_rank_tsv,
        sink_rank_text,
        adjacency_by_djb2,
        edges_by_djb2,
    )
}

_LINE_RANKS = pagerank_sql(I.LINK_LINES_SQL, "links_line", 10)
_RANKS_TEXT = f"SELECT CAST(node AS VARCHAR) AS node, rank FROM ({pagerank_sql(I.HANDOFF_SQL, 'handoff', 10)})"


def _djb2_sql(column: str) -> str:
    # two arguments per step: hash so far, next code point
    letters = f"list_transform(string_split({column}, ''), lambda c: CAST(unicode(c) AS BIGINT))"
    return f"list_reduce({letters}, lambda h, c: (h * 33 + c) % 4294967296, CAST(5381 AS BIGINT))"


ORACLES = {
    "rank_link_files": pagerank_sql(I.LINK_LINES_SQL, "links_field", 10),
    "pagerank_1": pagerank_sql(I.HANDOFF_SQL, "handoff", 1),
    "pagerank_10": pagerank_sql(I.HANDOFF_SQL, "handoff", 10),
    "pagerank_10_links": _LINE_RANKS,
    "pagerank_10_partitioned": pagerank_sql(I.LINK_LINES_SQL, "links_field", 10),
    "pagerank_10_persisted": _LINE_RANKS,
    "pagerank_10_checkpointed": _LINE_RANKS,
    "pagerank_10_hubs": pagerank_sql(I.FLAG_SQL, "flags", 10),
    "pagerank_10_exact": f"SELECT node, rank, true AS same FROM ({pagerank_sql(I.HANDOFF_SQL, 'handoff', 10)})",
    "pagerank_10_compact": _LINE_RANKS,
    "pagerank_10_resumed": pagerank_sql(I.HANDOFF_SQL, "handoff", 10),
    "hub_sources": f"""WITH {I.FLAG_SQL}
SELECT src, count(*) AS out_degree FROM flags GROUP BY src
HAVING count(*) > greatest((SELECT count(*) FROM flags) / 16.0::DOUBLE, 100)""",
    "pagerank_acyclic": pagerank_sql(I.LADDER_SQL, "ladder", 2),
    "scan_text_lines": f"WITH {I.LINK_LINES_SQL} SELECT value FROM lines",
    "scan_whole_files": f"""WITH {I.LINK_LINES_SQL},
broken AS (
  SELECT n, p AS value FROM names UNION ALL SELECT n, s FROM names UNION ALL SELECT n, '' FROM names WHERE n % 3 = 0)
SELECT n AS number, value, count(*) AS copies FROM broken GROUP BY ALL""",
    "parse_links_line": f"WITH {I.LINK_LINES_SQL} SELECT src, dst FROM links_line",
    "parse_links_field": f"WITH {I.LINK_LINES_SQL} SELECT src, dst FROM links_field",
    "djb2_hash": f"WITH {I.LINK_LINES_SQL}, nodes AS (SELECT DISTINCT src AS node FROM links_field) "
    f"SELECT node, CAST({_djb2_sql('node')} AS BIGINT) AS hash FROM nodes",
    "djb2_texts": f"SELECT doc_id, CAST({_djb2_sql('text')} AS BIGINT) AS hash FROM documents",
    "partition_by_djb2": f"WITH {I.LINK_LINES_SQL}, nodes AS (SELECT src AS node, count(*) AS out_degree FROM links_field GROUP BY src) "
    f"SELECT node, out_degree, CAST({_djb2_sql('node')} % 150 AS INTEGER) AS part, "
    f"CAST({_djb2_sql('node')} % 150 AS INTEGER) AS placed_on FROM nodes",
    "out_degree": f"WITH {I.HANDOFF_SQL} SELECT src, count(*) AS out_degree FROM handoff GROUP BY src",
    "adjacency_list": f"""WITH {I.HANDOFF_SQL},
folded AS (SELECT src, dst, count(*) AS copies FROM handoff GROUP BY src, dst),
ranked AS (SELECT *, CAST((row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // 20 AS BIGINT) AS part FROM folded)
SELECT src, part, string_agg(dst || 'x' || copies, ' ' ORDER BY dst) AS neighbors FROM ranked GROUP BY src, part""",
    "rank_contributions": f"""WITH {I.LINK_LINES_SQL},
deg AS (SELECT src, count(*) AS n FROM links_line GROUP BY src)
SELECT dst AS node, round(sum(1.0::DOUBLE / n), 6) AS contribution
FROM links_line JOIN deg USING (src) GROUP BY dst""",
    "adjacency_by_djb2": f"""WITH {I.LINK_LINES_SQL},
folded AS (SELECT src, dst, count(*) AS copies FROM links_field GROUP BY src, dst),
ranked AS (SELECT *, CAST((row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // 20 AS BIGINT) AS list_part FROM folded),
lists AS (SELECT src, list_part, string_agg(dst || 'x' || copies, ' ' ORDER BY dst) AS neighbors FROM ranked GROUP BY ALL)
SELECT *, CAST({_djb2_sql('src')} % 150 AS INTEGER) AS part, CAST({_djb2_sql('src')} % 150 AS INTEGER) AS placed_on FROM lists""",
    "edges_by_djb2": f"""WITH {I.FLAG_SQL}
SELECT src, CAST({_djb2_sql('src')} % 150 AS INTEGER) AS part, count(*) AS edges, true AS even FROM flags GROUP BY ALL""",
    "sink_rank_text": """SELECT o_orderkey || chr(9) || CAST(round(o_totalprice * 100) + CASE WHEN o_orderkey % 2 = 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS VARCHAR)
AS value FROM orders""",
    "source_only_nodes": f"""WITH {I.ORDER_EDGES_SQL}
SELECT DISTINCT src AS node, 0.0::DOUBLE AS rank FROM order_edges WHERE src NOT IN (SELECT dst FROM order_edges)""",
    "sink_rank_tuple": _RANKS_TEXT,
    "sink_rank_tsv": _RANKS_TEXT,
}
