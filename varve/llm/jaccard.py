"""Similarity join on word shingles by a grouped prefix join, exact, with components.

Shingles have one global order: frequent ones last, all others by hash. Two sets of Jaccard
similarity t or more share a shingle among the first n - ceil(t n) + 1 of each. Documents with the same prefix
and size form one group, and only groups are joined; group pairs pass a size and a position filter; pairs that
are left are expanded to the groups' members and verified on the whole texts.

A hot shingle or a large cluster of near copies must not become all pairs. So candidates come in
two rounds. In the first, over frequent shingles, each group meets one hub: of those that the prefixes allow, the most central one, of
whose shingles the fewest are rare, as the text that the others were copied from has few of its own. Verified links give components. In the second, over
all shingles, candidates are all pairs that the prefixes allow between different components, for pairs within one
component can't change it. Both rounds together lose no link that matters to reachability.

Rows are told apart by a key of their own, whatever their ids are: texts under one id, or under none, are linked only if they are similar.

Defined results: a null or empty text has an empty set and is linked with nothing; equal sets are linked. A component
is named by its smallest id; if it has none, or another component bears it, by a number of its own, far below zero.
Where one row stays, a null id counts as the smallest, then the texts' hashes decide; rows that repeat both id and text are one document
seen again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.columns import gram_hashes, mixed, steps, texts_of, word_ends, word_hashes
from varve.llm.components import components
from varve.session import shuffle_partitions, written, written_bucketed

SHINGLE_WORDS = 5
PERCENT = 75
#: A shingle is frequent that so many documents have; at most so many of these are told apart. Which are only decides the
#: order of shingles, and so the number of candidates, never the result.
FREQUENT_TIMES = 6
MAX_FREQUENT = 1_000_000
STEP_BYTES = 2_000_000
#: Entries that a task gathers before it packs them by bucket.
PACK_ENTRIES = 500_000
#: Bytes of text, about, whose pairs are verified at a time.
PAIR_BYTES = 8_000_000
#: Pairs that read one copy of their hub's text.
PAIRS_PER_COPY = 2_000
LEAST = -(2**63)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_ENTRY = np.dtype([("token", "<u8"), ("id", "<i8"), ("part", "<i8"), ("size", "<i4"), ("at", "<i4"), ("rare", "<i4")])


def shingle_sets(column: pa.Array, k: int = SHINGLE_WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its ``k``-word shingles); a shorter text is one shingle of its own kind."""
    for first, stop, buf, offsets in steps(column, STEP_BYTES):
        starts, ends = word_ends(buf, offsets)
        hashes = word_hashes(_LOWER[buf], starts, ends)
        at = np.searchsorted(starts, offsets)
        grams = gram_hashes(hashes, k)
        for row in range(stop - first):
            a, b = at[row], at[row + 1]
            if b - a >= k:
                yield first + row, np.unique(grams[a : b - k + 1])
            elif b > a:
                yield first + row, mixed(gram_hashes(hashes[a:b], int(b - a)) + np.uint64(b - a))
            else:
                yield first + row, hashes[:0]


def needed(x, y, percent: int = PERCENT):
    """Smallest intersection of sets of ``x`` and ``y`` elements that are similar enough."""
    return -(-percent * (x + y) // (100 + percent))


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n + (-percent * n) // 100 + 1


def in_order(tokens: np.ndarray, frequent: np.ndarray, times: np.ndarray) -> np.ndarray:
    """``tokens``, sorted by hash, in the global order."""
    return _ordered(tokens, frequent, times)[0]


def _ordered(tokens: np.ndarray, frequent: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, int]:
    """``tokens`` in the global order, and how many of them aren't frequent."""
    if not len(frequent):
        return tokens, len(tokens)
    at = np.searchsorted(frequent, tokens)
    at[at == len(frequent)] = 0
    often = frequent[at] == tokens
    last = tokens[often]
    return np.concatenate((tokens[~often], last[np.argsort(times[at[often]], kind="stable")])), len(tokens) - len(last)


def _by_bucket(tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by bucket and hash, the buckets there are, and where each begins and ends."""
    bucket = (tokens >> np.uint64(20)) % np.uint64(buckets)
    order = np.lexsort((tokens, bucket))
    bucket = bucket[order]
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    return order, bucket[first].astype(np.int32), first, np.append(first[1:], len(bucket))


def _packs(bucket, first, stop, pieces):
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket), pa.array(stop - first, pa.int32()), pa.array(pieces, pa.binary())], ["bucket", "entries", "packed"]
    )


_PACKS = "bucket int, entries int, packed binary"


def _bucketed(packed: DataFrame, width: int) -> DataFrame:
    return packed.repartition(width, "bucket").sortWithinPartitions("bucket")


def _each_bucket(batches, unpack) -> Iterator[list]:
    """What a task holds of one bucket after the other."""
    held, last = [], None
    for batch in batches:
        for bucket, count, packed in zip(*(batch.column(c).to_pylist() for c in ("bucket", "entries", "packed"))):
            if bucket != last and held:
                yield held
                held = []
            last = bucket
            held.append(unpack(count, packed))
    if held:
        yield held


def frequent_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted by hash, and their counts; a bounded list whatever the table's size.

    All shingles of all documents are counted; only packed hashes are shuffled, about three bytes each.
    """
    width = shuffle_partitions(texts.sparkSession)

    def pack(batches):
        held, size = [], 0
        for batch in batches:
            for _, tokens in shingle_sets(batch.column("text")):
                held.append(tokens)
                size += len(tokens)
                if size >= PACK_ENTRIES:
                    yield packed(np.concatenate(held))
                    held, size = [], 0
        if size:
            yield packed(np.concatenate(held))

    def packed(tokens):
        order, bucket, first, stop = _by_bucket(tokens, width)
        tokens = tokens[order]
        steps_ = np.diff(tokens, prepend=np.uint64(0))  # small within a bucket, so they compress
        return _packs(bucket, first, stop, [_packed_steps(tokens[a], steps_[a + 1 : b]) for a, b in zip(first, stop)])

    def count(batches):
        for held in _each_bucket(batches, _unpacked_steps):
            tokens, times = np.unique(np.concatenate(held), return_counts=True)
            often = times >= FREQUENT_TIMES
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(times[often], pa.int64())], ["token", "times"]
            )

    often = _bucketed(texts.select("text").mapInArrow(pack, _PACKS), width).mapInArrow(count, "token bigint, times bigint")
    often = written(often, "frequent")
    # the most frequent ones, down to the power of two from which they fit the bound
    level = F.floor(F.log2("times")).cast("int")
    least, total = 63, 0
    for row in sorted(often.groupBy(level.alias("level")).count().collect(), reverse=True):
        total += row["count"]
        if total > MAX_FREQUENT:
            break
        least = row["level"]
    rows = often.where(level >= least).toArrow()
    tokens = rows.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], rows.column("times").to_numpy()[order].astype(np.int32)


def _packed_steps(start: np.uint64, steps_: np.ndarray) -> bytes:
    """Bytes of equal significance stand together: the high ones are nearly all zero."""
    wide = np.concatenate(([start], steps_)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return zlib.compress(wide.T.tobytes(), 1)


def _unpacked_steps(count: int, packed: bytes) -> np.ndarray:
    wide = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, count)
    return np.cumsum(np.ascontiguousarray(wide.T).view("<u8").ravel(), dtype=np.uint64)


def _described(shared):
    """Per document, with its id and the text's hash: size of the set, two hashes of it, and one of its prefix."""

    def run(batches):
        frequent, times = shared.value
        for batch in batches:
            sizes, first, second, prefix = [], [], [], []
            for _, tokens in shingle_sets(batch.column("text")):
                n = len(tokens)
                sizes.append(n)
                first.append(tokens.sum())
                second.append(mixed(tokens ^ np.uint64(n)).sum())
                prefix.append(mixed(in_order(tokens, frequent, times)[: prefix_size(n)]).sum() if n else 0)
            hashes = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (first, second, prefix)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc", "id", "hash")), pa.array(sizes, pa.int64()), *hashes],
                ["doc", "id", "hash", "n", "set_a", "set_b", "prefix"],
            )

    return run


def _packed(shared, buckets: int, only_frequent: bool):
    """Prefix entries of the entities, packed by bucket of the shingle; those of frequent shingles or of all."""

    def pack(held):
        entries = np.concatenate(held)
        order, bucket, first, stop = _by_bucket(entries["token"], buckets)
        entries = entries[order]
        pieces = []
        for a, b in zip(first, stop):
            part = entries[a:b]
            # byte by byte, so that it compresses
            wide = part.view(np.uint8).reshape(len(part), _ENTRY.itemsize)
            pieces.append(zlib.compress(wide.T.tobytes(), 1))
        return _packs(bucket, first, stop, pieces)

    def run(batches):
        frequent, times = shared.value
        held, size = [], 0
        for batch in batches:
            parts = batch.column("part").to_pylist()
            docs = batch.column("doc").to_pylist()
            for row, tokens in shingle_sets(batch.column("text")):
                n = len(tokens)
                ordered, rare = _ordered(tokens, frequent, times)
                first = rare if only_frequent else 0
                prefix = ordered[first : prefix_size(n)]
                if not len(prefix):
                    continue
                entries = np.empty(len(prefix), _ENTRY)
                entries["token"], entries["id"], entries["part"] = prefix, docs[row], parts[row]
                entries["size"], entries["at"], entries["rare"] = n, np.arange(first, first + len(prefix)), 1000 * rare // n
                held.append(entries)
                size += len(entries)
                if size >= PACK_ENTRIES:
                    yield pack(held)
                    held, size = [], 0
        if size:
            yield pack(held)

    return run


def _unpacked(count: int, packed: bytes) -> np.ndarray:
    wide = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(_ENTRY.itemsize, count)
    return np.ascontiguousarray(wide.T).view(_ENTRY).ravel()


def _candidates(batches):
    """Distinct pairs of each bucket between different parts."""
    for held in _each_bucket(batches, _unpacked):
        entries = np.concatenate(held)
        entries = entries[np.lexsort((entries["size"], entries["token"]))]
        first, count = _runs_of(entries["token"])
        # most shared shingles are of two
        two = first[count == 2]
        x, y = entries[two], entries[two + 1]
        fits = (x["id"] != y["id"]) & (x["part"] != y["part"]) & _allowed(x, y)
        found = [np.sort(np.stack([x["id"][fits], y["id"][fits]], 1), 1)]
        for a, n in zip(first[count > 2], count[count > 2]):
            found.append(cross_pairs(entries[a : a + n]))
            if len(found) > 5_000:
                found = [np.unique(np.concatenate(found), axis=0)]
        pairs = np.unique(np.concatenate(found), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["x", "y"])


def _runs_of(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins, and its length."""
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    return first, np.diff(np.append(first, len(token)))


def _hubs(batches):
    """(rare, x, y): the most central hub ``x`` that each ``y`` meets in a bucket."""
    for held in _each_bucket(batches, _unpacked):
        entries = np.concatenate(held)
        entries = entries[np.lexsort((entries["size"], entries["token"]))]
        first, count = _runs_of(entries["token"])
        found = [np.zeros((0, 3), np.int64)]
        for a, n in zip(first[count > 1], count[count > 1]):
            found.append(hub_pairs(entries[a : a + n]))
        rows = np.concatenate(found)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0], rows[:, 2]))]
        rows = rows[np.concatenate(([True], rows[1:, 2] != rows[:-1, 2]))] if len(rows) else rows
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, i]) for i in range(3)], ["rare", "x", "y"])


def _allowed(x, y) -> np.ndarray:
    """Size and position filter: could the two still share enough, this being their first common shingle?"""
    need = needed(x["size"], y["size"])
    room = np.minimum(x["size"] - x["at"], y["size"] - y["at"])
    return (100 * np.minimum(x["size"], y["size"]) >= PERCENT * np.maximum(x["size"], y["size"])) & (room >= need)


def hub_pairs(entries: np.ndarray) -> np.ndarray:
    """Rows (rare, hub, member): for each entry the most central one that its size and place allow. Entries come sorted by size."""
    sizes = entries["size"].astype(np.int64)
    central = np.lexsort((entries["id"], entries["rare"]))
    rank = np.empty(len(entries), np.int64)
    rank[central] = np.arange(len(entries))
    # the least rank among the sizes that may link: minima of runs of doubled lengths
    begin = np.searchsorted(sizes, -(-PERCENT * sizes // 100), "left")
    end = np.searchsorted(sizes, 100 * sizes // PERCENT, "right")
    level = np.frexp((end - begin).astype(np.float64))[1] - 1  # runs of 2 ** level, of which two cover the range
    best, least, width = np.empty(len(entries), np.int64), rank, 1
    for k in range(int(level.max()) + 1):
        own = level == k
        best[own] = np.minimum(least[begin[own]], least[end[own] - width])
        least = np.minimum(least[: max(len(least) - width, 0)], least[width:])
        width *= 2
    hub = entries[central[best]]
    good = (best < rank) & (hub["id"] != entries["id"]) & _allowed(hub, entries)
    return np.stack([hub["rare"][good].astype(np.int64), hub["id"][good], entries["id"][good]], 1)


def cross_pairs(entries: np.ndarray, block: int = 256) -> np.ndarray:
    """All pairs that the filters allow between different parts. Entries come sorted by size."""
    parts = entries["part"]
    if (parts == parts[0]).all():
        return np.zeros((0, 2), np.int64)
    found = [np.zeros((0, 2), np.int64)]
    ends = np.searchsorted(entries["size"], 100 * entries["size"].astype(np.int64) // PERCENT, "right")
    for first in range(0, len(entries), block):
        x = entries[first : first + block]
        y = entries[first : int(ends[min(first + block, len(entries)) - 1])]
        fits = (x["part"][:, None] != y["part"][None, :]) & _allowed(x[:, None], y[None, :])
        i, j = np.nonzero(fits & (np.arange(len(x))[:, None] < np.arange(len(y))[None, :]))
        pairs = np.stack([x["id"][i], y["id"][j]], 1)
        found.append(np.sort(pairs, 1))
    return np.concatenate(found)


def _placed_entries(texts: DataFrame, entities: DataFrame, shared, only_frequent: bool) -> DataFrame:
    """Packed prefix entries of the ``entities`` (doc, part), those of one bucket of shingles together."""
    width = shuffle_partitions(texts.sparkSession)
    packed = texts.join(entities.hint("shuffle_hash"), "doc").mapInArrow(_packed(shared, width, only_frequent), _PACKS)
    return _bucketed(packed, width)


def hub_candidates(texts: DataFrame, entities: DataFrame, shared) -> DataFrame:
    """(x, y): of each entity ``y`` the most central one that it meets at a frequent shingle; one pair an entity at most."""
    met = _placed_entries(texts, entities, shared, True).mapInArrow(_hubs, "rare bigint, x bigint, y bigint")
    return met.groupBy("y").agg(F.min(F.struct("rare", "x")).alias("hub")).select("hub.x", "y")


def cross_candidates(texts: DataFrame, entities: DataFrame, shared) -> DataFrame:
    """(x, y): all pairs of entities of different parts that meet at some shingle of their prefixes."""
    return _placed_entries(texts, entities, shared, False).mapInArrow(_candidates, "x bigint, y bigint").distinct()


def _squeezed(batches):
    for batch in batches:
        texts = [zlib.compress(t, 1) for t in texts_of(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("salts"), pa.array(texts, pa.binary())], ["x", "salts", "other"]
        )


def _verified(batches):
    """Links among the pairs, decided on both whole texts; so many pairs at a time as their bytes allow."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(2 * sizes + 1)  # a text that may link is about as long
        begin = 0
        while begin < batch.num_rows:
            stop = int(np.searchsorted(total, (total[begin - 1] if begin else 0) + PAIR_BYTES, "right"))
            stop = min(max(stop, begin + 1), begin + 500, batch.num_rows)
            part = batch.slice(begin, stop - begin)
            begin = stop
            others = [zlib.decompress(t) for t in part.column("other").to_pylist()]
            links = []
            for (_, a), (_, b) in zip(shingle_sets(pa.array(others, pa.binary())), shingle_sets(part.column("text"))):
                both = len(np.intersect1d(a, b, assume_unique=True))
                links.append(both >= needed(len(a), len(b)))
            keep = pa.array(links, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column("x").filter(keep), part.column("doc").filter(keep)], ["a", "b"])


def verified_links(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The ``pairs`` (x, y) whose texts are similar enough, as (a, b); texts lie bucketed and stay where they are."""
    # a hub may be in very many pairs: its text is repeated once for every PAIRS_PER_COPY of them
    hubs = pairs.groupBy("x").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_COPY).cast("int").alias("salts"))
    left = texts.join(hubs.withColumnRenamed("x", "doc").hint("shuffle_hash"), "doc")
    left = left.select("doc", "salts", "text").mapInArrow(_squeezed, "x bigint, salts int, other binary")
    left = left.select("x", "other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    salted = pairs.join(hubs, "x").select("x", F.col("y").alias("doc"), F.pmod(F.hash("y"), "salts").alias("salt"))
    other = salted.join(left, ["x", "salt"]).select("x", "doc", "other")
    return (
        texts.join(other.hint("shuffle_hash"), "doc")
        .select("x", "doc", "other", "text")
        .mapInArrow(_verified, "a bigint, b bigint")
    )


def similarity_components(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc, n_shingles, component): one row per row of ``docs``, whose ids stand in ``doc``."""
    found = written(_components_of(_placed(docs.select(F.col(id_column).alias("id"), "text")), "id"), "found")
    named = found.groupBy("component").agg(F.min("id").alias("low"))
    # one id may stand in several components: the first of them bears it
    first = named.where("low is not null").groupBy("low").agg(F.min("component").alias("component"))
    names = first.select("component", F.col("low").alias("name"))
    return found.join(names, "component", "left").select(
        F.col("id").alias("doc"), "n_shingles", F.coalesce("name", F.col("component") + F.lit(LEAST)).alias("component")
    )


def _placed(docs: DataFrame) -> DataFrame:
    """``docs`` written once with ``doc``, a key of the row, bucketed by it: no later step shuffles texts by document again."""
    width = shuffle_partitions(docs.sparkSession)
    keyed = docs.withColumn("doc", F.monotonically_increasing_id())
    return written_bucketed(keyed.repartition(width, "doc"), "texts", width, "doc")


def _components_of(rows: DataFrame, id_column: str) -> DataFrame:
    """(doc, id, hash, n_shingles, component) of each row; components go by row keys."""
    spark = rows.sparkSession
    texts = rows.select("doc", "text")
    shared = spark.sparkContext.broadcast(frequent_shingles(texts))  # at most MAX_FREQUENT
    described = written(
        rows.select("doc", F.col(id_column).cast("bigint").alias("id"), F.xxhash64("text").alias("hash"), "text").mapInArrow(
            _described(shared), "doc bigint, id bigint, hash bigint, n bigint, set_a bigint, set_b bigint, prefix bigint"
        ),
        "sets",
    )
    # distinct sets, each under its smallest document, and the groups of equal prefix and size
    sets = described.where("n > 0").groupBy("n", "prefix", "set_a", "set_b").agg(F.min("doc").alias("member"))
    sets = written(sets, "members")
    heads = sets.groupBy("n", "prefix").agg(F.min("member").alias("head"))
    members = written(sets.join(heads, ["n", "prefix"]).select("head", "member"), "groups")

    # first round: hubs; the hub group's head stands for it
    entities = heads.select(F.col("head").alias("doc"), F.lit(0).alias("part"))
    first = written(hub_candidates(texts, entities, shared), "pairs")
    met = first.join(members.withColumnRenamed("head", "y"), "y").select("x", F.col("member").alias("y"))
    own = members.where("member <> head").select(F.col("head").alias("x"), F.col("member").alias("y"))
    links = written(verified_links(texts, met.unionByName(own)), "links")
    found = written(components(links), "components")

    # second round: pairs between different components, of parts of groups that lie in one component
    placed = members.join(found.withColumnRenamed("node", "member"), "member", "left").select(
        "head", "member", F.coalesce("component", "member").alias("part")
    )
    placed = written(placed, "placed")
    entities = placed.groupBy("head", "part").agg(F.min("member").alias("doc"))
    entities = written(entities, "entities")
    second = written(cross_candidates(texts, entities.select("doc", "part"), shared), "pairs")
    inside = placed.join(entities, ["head", "part"]).select("doc", "member")
    expanded = (
        second.join(inside.select(F.col("doc").alias("x"), F.col("member").alias("a")), "x")
        .join(inside.select(F.col("doc").alias("y"), F.col("member").alias("b")), "y")
        .select(F.col("a").alias("x"), F.col("b").alias("y"))
    )
    more = verified_links(texts, expanded)
    hooks = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = components(more.unionByName(hooks))

    named = (
        described.where("n > 0")
        .join(sets, ["n", "prefix", "set_a", "set_b"], "left")
        .join(final.withColumnRenamed("node", "member"), "member", "left")
        .select("doc", "id", "hash", F.col("n").alias("n_shingles"), F.coalesce("component", "member", "doc").alias("component"))
    )
    # empty texts are linked with nothing: of them only rows that repeat an id are one
    empty = described.where("n = 0")
    seen = empty.where("id is not null").groupBy("id", "hash").agg(F.min("doc").alias("component"))
    alone = empty.join(seen, ["id", "hash"], "left").select(
        "doc", "id", "hash", F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component")
    )
    return named.unionByName(alone)


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` without near duplicates: of each component the row of smallest id stays."""
    own = "_own_doc"  # a column of the input that is called like the key
    rows = _placed(docs.withColumnRenamed("doc", own))
    found = _components_of(rows, own if id_column == "doc" else id_column)
    kept = found.groupBy("component").agg(F.min(F.struct("id", "hash", "doc")).alias("least")).select("least.doc")
    return rows.join(kept.hint("shuffle_hash"), "doc", "left_semi").select(
        *[F.col(own).alias("doc") if c == "doc" else F.col(c) for c in docs.columns]
    )
