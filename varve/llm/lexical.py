"""Ranked lexical search over a length-stratified index, exact.

A score sums, over a query's terms, an integer weight times ``(10**9 * tf) div (1000 * tf + 12 * m)``. ``m`` is the document's length
normaliser, a small integer, so documents of equal ``m`` form a stratum, in which a posting counts for nothing but its ``tf``: postings are
grouped by tf, each group's impact is computed once, and the greatest tf of a term bounds what it adds to any document of the stratum.
A search adds these bounds up, visits strata in their descending order and stops at the first that can't reach the k-th score found so far.

The index is cut into segments of whole documents, about ``SEGMENT_BYTES`` of text each, and holds every document: one row per
segment and term, and one per segment that names its documents. So no term's postings ever meet in one row or task, however
frequent it is. A search joins the rows of the queries' terms, counts documents per term over all segments, and
shuffles only those rows, by segment. A task carries its k best from segment to segment; only those leave it.

Queries are taken in blocks of about ``QUERY_TERMS`` terms (and one whole query more at most), whose table is broadcast; a block reads the index once.

Defined results: a null text has no terms; documents without terms are in no result and count nowhere; a query row without terms gets no rows; rows that
repeat an id are documents, or queries, of their own; equal scores stand by ascending id, null last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varve.llm.columns import steps, word_ends
from varve.session import written

SEGMENT_BYTES = 8_000_000
QUERY_TERMS = 200_000
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Fixed values of the score.
UNIT = 1_000_000_000
TF_SCALE, NORM_SCALE = 1000, 12
NORM_BASE, NORM_SLOPE = 75, 25

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_IN_TERM = np.zeros(256, bool)
_IN_TERM[0x30:0x3A] = _IN_TERM[0x61:0x7B] = _IN_TERM[0x80:] = True

INDEX = "segment bigint, term string, m array<bigint>, tf array<int>, ends array<int>, docs array<int>, ids array<bigint>"
_BIG = 2**63 - 1


class Index:
    """``rows`` as written, with the number of documents that have a term, and of all their terms."""

    def __init__(self, rows: DataFrame, documents: int, terms: int):
        self.rows, self.documents, self.terms = rows, documents, terms


def _terms(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes, begin and end of each term, and the number of the first term of each row and behind the last."""
    lowered = _LOWER[buf]
    begins, finishes = word_ends(lowered, offsets, _IN_TERM)
    return lowered, begins, finishes, np.searchsorted(begins, offsets)


def build_index(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> Index:
    """The index of all ``docs``, written to the shared folder."""
    frame = docs.select(docs[text].alias("text"), docs[id_column].cast("bigint").alias("id"))

    def measure(batches):
        for batch in batches:
            some = total = 0
            for _, _, buf, offsets in steps(batch.column(0)):
                sizes = np.diff(_terms(buf, offsets)[3])
                some += np.count_nonzero(sizes)
                total += sizes.sum()
            yield pa.RecordBatch.from_arrays([pa.array([some], pa.int64()), pa.array([total], pa.int64())], ["some", "total"])

    sums = frame.select("text").mapInArrow(measure, "some bigint, total bigint").agg(
        F.coalesce(F.sum("some"), F.lit(0)).alias("some"), F.coalesce(F.sum("total"), F.lit(0)).alias("total")
    )
    documents, terms = sums.first()

    def pack(batches):
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, stop, buf, offsets in steps(batch.column(0), SEGMENT_BYTES):
                packed = _segment(segment, buf, offsets, batch.column(1).slice(first, stop - first), documents, terms)
                if packed is not None:
                    yield packed
                segment += 1

    return Index(written(frame.mapInArrow(pack, INDEX), "index"), documents, terms)


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
    return pa.ListArray.from_arrays(offsets, values if isinstance(values, pa.Array) else pa.array(values, kind))


def _segment(segment: int, buf, offsets, ids: pa.Array, documents: int, terms: int) -> pa.RecordBatch | None:
    """Rows of a segment: first its documents by stratum, then each term's postings by stratum and descending tf."""
    lowered, begins, finishes, edges = _terms(buf, offsets)
    sizes = np.diff(edges)
    some = np.flatnonzero(sizes)
    if not len(some):
        return None
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[begins] += 1
    inside[finishes] -= 1
    where = pa.array(np.concatenate(([0], np.cumsum(finishes - begins))), pa.int64()).buffers()[1]
    data = pa.py_buffer(lowered[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)])
    words = pa.Array.from_buffers(pa.large_string(), len(begins), [None, where, data]).dictionary_encode()
    names = words.dictionary.cast(pa.string())

    # whole numbers of Python's where products may be large
    norm = np.array([NORM_BASE + NORM_SLOPE * n * documents // terms for n in sizes[some].tolist()], np.int64)
    by_norm = np.argsort(norm, kind="stable")
    strata, first = np.unique(norm[by_norm], return_index=True)
    local = np.full(len(sizes), -1, np.int64)
    local[some[by_norm]] = np.arange(len(some))
    stratum = np.repeat(np.arange(len(strata)), np.diff(np.append(first, len(some))))

    number = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key, tf = np.unique(number * len(some) + np.repeat(local[some], sizes[some]), return_counts=True)
    term, doc = key // len(some), key % len(some)
    order = np.lexsort((-tf, stratum[doc], term))
    term, doc, tf = term[order], doc[order], tf[order]
    group = stratum[doc]
    opens = np.ones(len(term), bool)
    opens[1:] = (term[1:] != term[:-1]) | (group[1:] != group[:-1]) | (tf[1:] != tf[:-1])
    opens = np.flatnonzero(opens)
    postings = np.searchsorted(term, np.arange(len(names)), "right")  # end of each term's postings
    groups = np.searchsorted(opens, postings)  # and of its groups
    base = np.concatenate(([0], postings[:-1]))
    ends = np.append(opens[1:], len(term)) - base[term[opens]]

    # the row of documents stands before the rows of terms
    n, m = len(some), strata[group[opens]]
    lead = lambda values, head: np.concatenate((head, values))
    shift = lambda stops, by: lead(stops + by, [by])
    places = pa.array(some[by_norm])
    named = ids.take(places).cast(pa.int64())
    columns = [
        pa.array(np.full(len(names) + 1, segment), pa.int64()),
        pa.concat_arrays([pa.nulls(1, pa.string()), names]),
        _lists(lead(m, strata), shift(groups, len(strata)), pa.int64()),
        _lists(tf[opens], shift(groups, 0), pa.int32()),
        _lists(lead(ends, np.append(first[1:], n)), shift(groups, len(strata)), pa.int32()),
        _lists(doc, shift(postings, 0), pa.int32()),
        _lists(named, np.full(len(names) + 1, n), pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["segment", "term", "m", "tf", "ends", "docs", "ids"])


def query_terms(queries: DataFrame, text: str = "text") -> DataFrame:
    """``queries`` (query, ``text``) as rows (query, term, times)."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _UPPER.lower())
    return (
        queries.select("query", F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
        .groupBy("query", "term")
        .agg(F.count(F.lit(1)).alias("times"))
    )


def search(index: Index, queries: DataFrame, k: int, text: str = "text", id_column: str = "item_id") -> DataFrame:
    """(``id_column``, rank, doc_id, score): the ``k`` best documents of each row of ``queries``."""
    if k < 1:
        raise ValueError("k is 1 or more")
    asked = written(
        queries.select(queries[id_column].alias("id"), queries[text].alias("text")).withColumn("query", F.monotonically_increasing_id()),
        "queries",
    )
    terms = written(query_terms(asked), "terms")
    blocks = -(-terms.count() // QUERY_TERMS) or 1
    placed = terms.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    found = None
    for block in range(blocks):
        best = _searched(index, placed.where(F.col("block") == block).drop("block"), k)
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("query", F.col("id").alias(id_column)), "query").select(id_column, "rank", "doc_id", "score")


def _searched(index: Index, terms: DataFrame, k: int) -> DataFrame:
    """(query, doc_id, score) of one block of queries: the k best of each task."""
    spark = terms.sparkSession
    names = F.broadcast(terms.select("term").distinct())  # QUERY_TERMS
    held = index.rows.where("term is not null").join(names, "term")
    counts = held.groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    share = F.lit(float(2 * index.documents + 2)) / (2 * F.col("df") + 1)
    weighed = terms.join(counts, "term").select(
        "query", "term", (F.col("times") * F.floor(1000 * F.log(share))).cast("bigint").alias("weight")
    )
    table = weighed.orderBy("term", "query").toArrow()  # the block's queries
    distinct = table.column("term").combine_chunks().dictionary_encode()
    asked, query = np.unique(table.column("query").to_numpy(), return_inverse=True)
    shared = spark.sparkContext.broadcast(
        (asked, query, distinct.indices.to_numpy(zero_copy_only=False).astype(np.int64), table.column("weight").to_numpy())
    )
    rows = list(enumerate(distinct.dictionary.to_pylist()))
    numbers = spark.createDataFrame(rows, "number int, term string")
    of_terms = index.rows.where("term is not null").join(F.broadcast(numbers), "term")
    of_docs = index.rows.where("term is null").withColumn("number", F.lit(-1))
    columns = ["segment", "number", "m", "tf", "ends", "docs", "ids"]
    both = of_docs.select(columns).unionByName(of_terms.select(columns))

    def run(batches):
        asked, query, term, weight = shared.value
        best = _Best(query, term, weight, k)
        for parts in _segments(batches):
            best.visit(*_joined(parts))
        yield from best.rows(asked)

    placed = both.repartition("segment").sortWithinPartitions("segment", "number")
    return placed.mapInArrow(run, "query bigint, doc_id bigint, score bigint")


def _segments(batches):
    """Rows of one segment after the other, which come sorted."""
    held, last = [], None
    for batch in batches:
        segment = batch.column("segment").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(segment)) + 1).tolist(), len(segment)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if held and segment[a] != last:
                yield held
                held = []
            last = segment[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield held


def _joined(parts):
    """Ids and strata of a segment, and of its terms' groups: term, stratum, impact, begin and end among the postings."""
    rows = pa.Table.from_batches(parts).combine_chunks()
    flat = {c: rows.column(c).chunk(0) for c in ("number", "m", "tf", "ends", "docs", "ids")}
    number = flat["number"].to_numpy()
    sizes = flat["m"].value_lengths().to_numpy()
    m, ends = (flat[c].flatten().to_numpy() for c in ("m", "ends"))
    ids, docs = flat["ids"].flatten(), flat["docs"].flatten().to_numpy()
    strata, m, ends = m[: sizes[0]], m[sizes[0] :], ends[sizes[0] :].astype(np.int64)
    tf = flat["tf"].flatten().to_numpy().astype(np.int64)
    term = np.repeat(number[1:], sizes[1:]).astype(np.int64)
    held = flat["docs"].value_lengths().to_numpy().astype(np.int64)[1:]
    ends += np.repeat(np.cumsum(held) - held, sizes[1:])
    begins = np.concatenate(([0], ends[:-1]))
    impact = (UNIT * tf) // (TF_SCALE * tf + NORM_SCALE * m)
    return ids, len(strata), np.searchsorted(strata, m), term, impact, begins, ends, docs


class _Best:
    """The k best documents of each query so far."""

    def __init__(self, query, term, weight, k):
        self.k = k
        order = np.lexsort((term, query))
        cuts = np.flatnonzero(np.diff(query[order])) + 1
        self.queries = [(term[x], weight[x]) for x in np.split(order, cuts)] if len(query) else []
        self.top = [(np.zeros(0, np.int64),) * 3 for _ in self.queries]  # scores, ids, 1 where the id is null

    def visit(self, ids, strata, stratum, term, impact, begins, ends, docs):
        count = len(ids)
        empty = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
        ids = ids.fill_null(_BIG).to_numpy()
        # the first group of a term and stratum has the greatest tf
        head = np.ones(len(term), bool)
        head[1:] = (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1])
        head = np.flatnonzero(head)
        head_term, head_stratum, head_impact = term[head], stratum[head], impact[head]
        for number, (own, weight) in enumerate(self.queries):
            a, b = np.searchsorted(head_term, own), np.searchsorted(head_term, own, "right")
            at = _ranges(a, b)
            if not len(at):
                continue
            times = np.repeat(weight, b - a)
            exact = int(weight.sum()) * UNIT // TF_SCALE < 2**53  # then sums of doubles are whole
            bound = _sums(head_stratum[at], times * head_impact[at], strata, exact)
            a, b = np.searchsorted(term, own), np.searchsorted(term, own, "right")
            groups, times = _ranges(a, b), np.repeat(weight, b - a)
            own_stratum = stratum[groups]
            order = np.argsort(-bound, kind="stable")
            order = order[bound[order] > 0]
            first, size = 0, 16
            while first < len(order) and bound[order[first]] >= self._least(number):
                visited = order[first : first + size]
                visited = visited[bound[visited] >= self._least(number)]
                now = np.zeros(strata, bool)
                now[visited] = True
                pick = now[own_stratum]
                g = groups[pick]
                score = _sums(
                    docs[_ranges(begins[g], ends[g])], np.repeat(times[pick] * impact[g], ends[g] - begins[g]), count, exact
                )
                self._take(number, score, ids, empty)
                first += size
                size *= 4

    def _least(self, number: int) -> int:
        """What a document needs to be among the best: the k-th score so far, or 1."""
        scores = self.top[number][0]
        return int(scores[-1]) if len(scores) == self.k else 1

    def _take(self, number, score, ids, empty):
        good = np.flatnonzero(score >= self._least(number))
        if len(good) > self.k:
            least = np.partition(score[good], len(good) - self.k)[len(good) - self.k]
            good = good[score[good] >= least]
        scores, names, nulls = (
            np.concatenate(x) for x in zip(self.top[number], (score[good].astype(np.int64), ids[good], empty[good]))
        )
        order = np.lexsort((names, nulls, -scores))[: self.k]
        self.top[number] = scores[order], names[order], nulls[order]

    def rows(self, asked):
        if not self.queries:
            return
        scores, names, nulls = (np.concatenate(x) for x in zip(*self.top))
        query = np.repeat(asked, [len(x[0]) for x in self.top])
        yield pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int64()), pa.array(names, pa.int64(), mask=nulls.astype(bool)), pa.array(scores, pa.int64())],
            ["query", "doc_id", "score"],
        )


def _ranges(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All numbers from ``a[i]`` to ``b[i] - 1``, one range after the other."""
    sizes = b - a
    total = np.cumsum(sizes)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(a - (total - sizes), sizes)


def _sums(at: np.ndarray, values: np.ndarray, size: int, exact: bool) -> np.ndarray:
    if exact:
        return np.bincount(at, values, size)
    out = np.zeros(size, np.int64)
    np.add.at(out, at, values)
    return out
