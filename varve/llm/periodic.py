"""Periodic runs of words, found by uniting suffix classes of each text by decreasing common prefix.

The suffixes of a text that agree on their first ``l`` words are a class of level ``l``. Neighbours in suffix order are
edges, weighted by their longest common prefix, and edges are taken in descending order, as Kruskal's algorithm does: each
unites two classes, whose positions are kept in order. Two positions that become adjacent in the union have
exactly this prefix in common; if they lie at a distance ``d`` within it, the text has period ``d`` from the first to
the end of the second's prefix. That is a run if the word before the first doesn't go on with the period. Every run
with period ``q`` from ``s`` on is seen, and once: between ``s`` and ``s + q`` no position has ``q`` words in common with them, for
the period is primitive.

All texts of an Arrow batch are sorted together, with the text as the first key. A run of ``min_length`` words and
``min_exponent`` periods needs a common prefix of ``min_length * (1 - 1 / min_exponent)`` words, so only positions whose
words occur again so far are sorted at all, and lower edges are left out. Words are compared by exact numbers, not by hashes; a
hash only tells which positions can't repeat. No row meets another, so nothing is shuffled; a text is one row and is worked on as a whole, at
some 100 bytes a word.

Defined results: a null or empty text has no words and no runs; rows that repeat are marked each; all other columns stay as they
are. Columns named like an added one are replaced by it.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from varve.llm.columns import gram_hashes, mixed, steps, word_ends

MIN_LENGTH = 6
MIN_EXPONENT = 4

RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])
ADDED = (
    T.StructField("n_words", T.LongType(), False),
    T.StructField("runs", T.ArrayType(RUN, False), False),
    T.StructField("collapsed", T.StringType(), False),
)


def mark_runs(
    docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` by start and period, and ``collapsed``.

    A run is a stretch of consecutive words (start counted from 0) with smallest ``period`` q and a length of at least ``min_length``
    and ``min_exponent * q``, which neither neighbouring word extends. ``collapsed`` has the words that
    no run contains after its first q words, joined by one space.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods at least")
    names = {f.name for f in ADDED}
    place = docs.columns.index(text)
    kept = [i for i, c in enumerate(docs.columns) if c.lower() not in names]
    schema = T.StructType([docs.schema.fields[i] for i in kept] + list(ADDED))

    def run(batches):
        for batch in batches:
            marked = _marked(batch.column(place), min_length, min_exponent)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *marked], names=schema.names)

    return docs.mapInArrow(run, schema)


def _marked(texts: pa.Array, min_length: int, min_exponent: int) -> list[pa.Array]:
    counts, sizes, found, data, ends = [], [], [], [], []
    for first, stop, buf, offsets in steps(texts):
        begins, finishes = word_ends(buf, offsets)
        edges = np.searchsorted(begins, offsets)  # of each text's words
        runs = word_runs(_numbers(buf, begins, finishes), edges, min_length, min_exponent)
        rest, rest_offsets = _collapsed(buf, offsets, begins, finishes, edges, runs)
        counts.append(np.diff(edges))
        own = np.searchsorted(edges, runs[:, 0], "right") - 1
        sizes.append(np.bincount(own, minlength=stop - first))
        found.append(np.stack([runs[:, 0] - edges[own], runs[:, 1], runs[:, 2]], 1))
        data.append(rest)
        ends.append(np.diff(rest_offsets))
    if not counts:
        counts = sizes = ends = [np.zeros(0, np.int64)]
        found, data = [np.zeros((0, 3), np.int64)], [np.zeros(0, np.uint8)]
    rows = np.concatenate(found)
    structs = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(_offsets(np.concatenate(sizes)), pa.int32()), structs)
    offsets = pa.array(_offsets(np.concatenate(ends)), pa.int32())
    rest = pa.StringArray.from_buffers(len(offsets) - 1, offsets.buffers()[1], pa.py_buffer(np.concatenate(data)))
    return [pa.array(np.concatenate(counts), pa.int64()), lists, rest]


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def _numbers(buf: np.ndarray, begins: np.ndarray, finishes: np.ndarray) -> np.ndarray:
    """A number from 1 on for each word, equal for equal words only."""
    sizes = finishes - begins
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[begins] += 1
    inside[finishes] -= 1
    solid = buf[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    offsets = pa.array(_offsets(sizes), pa.int64()).buffers()[1]
    words = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, offsets, pa.py_buffer(solid)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1


def word_runs(words: np.ndarray, edges: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """Rows (start, length, period) by start and period; ``words`` are positive numbers, text ``t`` has those from ``edges[t]`` on."""
    least = max(1, -(-min_length * (min_exponent - 1) // min_exponent))  # of a common prefix
    order, prefix = suffix_order(words, edges, least)
    seeds = united(order, prefix, least, min_length, min_exponent)
    at, second, level = seeds.T
    text_begins = np.zeros(len(words) + 1, bool)
    text_begins[edges[:-1]] = True
    maximal = text_begins[at]
    maximal |= words[at - 1] != words[second - 1]  # where the text begins, this isn't looked at
    at, period, level = at[maximal], (second - at)[maximal], level[maximal]
    runs = np.stack([at, period + level, period], 1)
    return runs[np.lexsort((period, at))]


def suffix_order(words: np.ndarray, edges: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in suffix order, text by text, and the words each has in common with the one before.

    All positions are there whose first ``least`` words occur twice or more in their text. Classes of equal beginnings are sorted by doubled lengths, and
    only those of more than one position again.
    """
    n = len(words)
    text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    finish = edges[1:][text] if n else np.zeros(0, np.int64)
    # positions whose first words occur again; equal words have equal hashes, so none is missed
    start = np.flatnonzero(np.arange(n) + least <= finish)
    key = gram_hashes(words.astype(np.uint64), least)[start] + mixed(text[start].astype(np.uint64))
    by_key = np.argsort(key, kind="stable")
    same = key[by_key][1:] == key[by_key][:-1]
    again = np.zeros(len(start), bool)
    again[by_key[1:][same]] = True
    again[by_key[:-1][same]] = True
    survive = start[again]
    if not len(survive):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    # so many words fit one number; beyond its end a text has zeros
    bits = int(words.max()).bit_length()
    packed_words = max(1, 62 // bits)
    width = packed_words * max(1, -(-least // packed_words))  # words of the first classes, at least ``least``

    def packed(positions):
        code = np.zeros(len(positions), np.int64)
        for j in range(packed_words):
            at = positions + j
            inside = at < finish[positions]
            code = (code << bits) | np.where(inside, words[np.minimum(at, n - 1)], 0)
        return code

    later = survive + width
    later = later[later < finish[survive]]
    used = np.union1d(survive, later)  # sorted: what the classes look at
    place = np.full(n + 1, -1, np.int64)
    place[used] = np.arange(len(used))
    keys = [text[used]]
    for j in range(0, width, packed_words):
        at = np.minimum(used + j, n - 1)
        keys.append(np.where(used + j < finish[used], packed(at), 0))
    order = np.lexsort(keys[::-1])
    differs = np.zeros(len(used), bool)
    differs[0] = True
    for k in keys:
        differs[1:] |= k[order][1:] != k[order][:-1]
    del keys
    rank = np.empty(len(used), np.int64)  # place of the class's first position
    rank[order] = np.maximum.accumulate(np.where(differs, np.arange(len(used)), 0))

    ranks, k = [(width, rank.astype(np.int32))], width
    while True:
        sorted_rank = rank[order]
        open_ = np.zeros(len(order), bool)
        same = sorted_rank[1:] == sorted_rank[:-1]
        open_[1:] |= same
        open_[:-1] |= same
        where = np.flatnonzero(open_)
        if not len(where):
            break
        active = order[where]
        after = np.minimum(used[active] + k, n)
        beyond = (after >= finish[used[active]]) | (place[after] < 0)
        next_rank = np.where(beyond, -1, rank[place[after]])
        sub = np.lexsort((next_rank, rank[active]))
        active, next_rank = active[sub], next_rank[sub]
        old = rank[active]
        differs = np.ones(len(active), bool)
        differs[1:] = (old[1:] != old[:-1]) | (next_rank[1:] != next_rank[:-1])
        order[where] = active
        rank = rank.copy()
        rank[active] = where[np.maximum.accumulate(np.where(differs, np.arange(len(active)), 0))]
        k *= 2
        ranks.append((k, rank.astype(np.int32)))

    positions = used[order]
    a, b = positions[:-1].copy(), positions[1:].copy()
    common = np.zeros(len(a), np.int64)
    live = np.flatnonzero(text[a] == text[b])
    for k, rank in reversed(ranks):
        x, y = place[np.minimum(a[live], n)], place[np.minimum(b[live], n)]
        equal = (x >= 0) & (y >= 0) & (rank[x] == rank[y])
        moved = live[equal]
        a[moved] += k
        b[moved] += k
        common[moved] += k
    stop = finish[positions[1:]]
    for _ in range(width):
        inside = live[(a[live] < stop[live]) & (b[live] < stop[live])]
        live = inside[words[a[inside]] == words[b[inside]]]
        a[live] += 1
        b[live] += 1
        common[live] += 1
    return positions, np.concatenate(([0], common))


def united(order: np.ndarray, prefix: np.ndarray, least: int, min_length: int, min_exponent: int) -> np.ndarray:
    """Rows (first, second, prefix) of positions that become adjacent in a union within a period's reach.

    A class is an interval of the suffix order, so it is known at its two ends; the smaller position set moves into the larger one.
    """
    edges = np.flatnonzero(prefix >= least)
    edges = edges[np.argsort(-prefix[edges], kind="stable")]
    touched = np.union1d(edges, edges - 1).tolist()
    at_left = {r: [p] for r, p in zip(touched, order[touched].tolist())}  # class that begins here
    at_right = dict(at_left)  # class that ends here
    low = {r: r for r in touched}  # first place of the class that ends here
    high = {r: r for r in touched}  # last place of the class that begins here
    found = []
    for r, level in zip(edges.tolist(), prefix[edges].tolist()):
        reach = level // (min_exponent - 1)
        begin, end = low[r - 1], high[r]
        small, large = at_right[r - 1], at_left[r]
        if len(small) > len(large):
            small, large = large, small
        size, last = len(large), -1
        few = 16 * len(small) < size or len(small) == 1
        places = []
        for i, x in enumerate(small):
            k = bisect_left(large, x)
            if k and k != last:
                before = large[k - 1]
                if x - before <= reach and x - before + level >= min_length:
                    found.append((before, x, level))
            if k < size:
                after = large[k]
                # unless the next position of the smaller set stands between
                if after - x <= reach and after - x + level >= min_length and (i + 1 == len(small) or small[i + 1] > after):
                    found.append((x, after, level))
            last = k
            if few:
                places.append(k)
        if few:
            for k, x in zip(reversed(places), reversed(small)):
                large.insert(k, x)
        else:
            large += small
            large.sort()
        at_left[begin] = at_right[end] = large
        low[end], high[begin] = begin, end
    return np.array(found, np.int64).reshape(-1, 3)


def _collapsed(buf, offsets, begins, finishes, edges, runs) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts without what runs repeat, kept words joined by one space."""
    count = len(begins)
    covered = np.zeros(count + 1, np.int64)
    np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
    np.add.at(covered, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
    marks = np.zeros(len(buf) + 1, np.int8)
    # the byte behind a kept word becomes the space, where a kept word of the same text follows
    own = np.searchsorted(edges, kept, "right")
    follows = np.zeros(len(kept), bool)
    follows[:-1] = own[1:] == own[:-1]
    marks[begins[kept]] += 1
    marks[finishes[kept] + follows] -= 1
    inside = np.cumsum(marks[:-1], dtype=np.int8).astype(bool)
    out = buf.copy()
    out[finishes[kept][follows]] = 0x20
    return out[inside], np.concatenate(([0], np.cumsum(inside)))[offsets]
