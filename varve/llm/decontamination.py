"""Benchmark decontamination with a generalised suffix automaton of the test items.

The benchmark is cut into blocks of at most ``block_words`` words. One automaton over word
numbers is built per block, in a Spark task, and only that bounded object is broadcast. Each
document is streamed once through each block's automaton; the state after a word stands for the
longest run of words ending there that some item contains, and its length. Documents are
never shuffled and every row stays itself, repeated or not.

Defined results: a null or empty text has no words and is never contaminated; a null or empty
item has no windows; a null item id marks words but is not listed; items with equal words are all
listed; an empty benchmark marks nothing; further columns pass through unless they bear a name
of the result, which then holds the result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.llm.columns import texts_of
from varve.session import written

WINDOW_WORDS = 13
#: Words of benchmark per automaton; it has at most twice as many states.
BLOCK_WORDS = 200_000
#: A document is contaminated when hit words are at least one in so many.
ONE_IN = 20

_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def item_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and anything beyond ASCII."""
    return text.translate(_TO_WORDS).split()


class ItemAutomaton:
    """Generalised suffix automaton of word sequences, with the items that a match completes."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW_WORDS):
        self.window = window
        self.numbers: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        walks = []
        for name, words in items:
            if words:
                numbers = [self.numbers.setdefault(w, len(self.numbers)) for w in words]
                last = 0
                for number in numbers:
                    last = self._extend(last, number)
                walks.append((name, numbers))
        self.hits = self._completed(walks)

    def _new(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A state for the shorter strings of ``q``, those that also end where ``p`` leads."""
        copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        state, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return state

    def walk(self, numbers: Iterator[int | None]) -> Iterator[tuple[int, int]]:
        """(state, matched length) after each word; None is a word that no item has."""
        moves, link, length = self.next, self.link, self.length
        state = matched = 0
        for number in numbers:
            to = moves[state].get(number)
            if to is None:
                if number is None:
                    state = matched = 0
                else:
                    while state >= 0 and number not in moves[state]:
                        state = link[state]
                    matched, state = length[state] + 1, moves[state][number]
            else:
                matched += 1
                state = to
            yield state, matched

    def _home(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _completed(self, walks) -> dict[int, list[tuple[int, frozenset]]]:
        """By state, the windows that end there: (words, items), for every size that a window can have."""
        own: dict[int, dict[int, set]] = {}
        for name, numbers in walks:
            size = min(self.window, len(numbers))
            for state, matched in self.walk(numbers):
                if matched >= size:
                    own.setdefault(self._home(state, size), {}).setdefault(size, set()).add(name)
        frozen = {s: [(n, frozenset(x)) for n, x in sorted(found.items())] for s, found in own.items()}
        hits: dict[int, list] = {}
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            found = hits.get(self.link[state], []) + frozen.get(state, [])
            if found:
                hits[state] = found
        return hits

    def match(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Maximal runs of hit words as [start, end), and the items whose windows occur."""
        hits, spans, items = self.hits, [], set()
        seen: set = set()
        for at, (state, matched) in enumerate(self.walk(map(self.numbers.get, words)), 1):
            found = hits.get(state)
            if found:
                size = 0
                for n, names in found:
                    if n <= matched:
                        size = max(size, n)
                        if (state, n) not in seen:
                            seen.add((state, n))
                            items |= names
                if size:
                    while spans and spans[-1][1] >= at - size:
                        size = max(size, at - spans.pop()[0])
                    spans.append([at - size, at])
        return spans, items


def _blocks(benchmark: DataFrame, block_words: int, window: int) -> DataFrame:
    """(block, automaton): items dealt to blocks by hash, so that none is much over ``block_words``."""
    sized = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text"))
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * block_words)))
    dealt = sized.where("text IS NOT NULL").withColumn("block", F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)))

    def build(key, rows):
        import pandas as pd

        items = [(i, item_words(t.encode())) for i, t in zip(rows["item_id"], rows["text"])]
        items = sorted({(None if i is None or i != i else i, tuple(w)) for i, w in items}, key=lambda x: (x[0] or "", x[1]))
        return pd.DataFrame({"block": [key[0]], "automaton": [pickle.dumps(ItemAutomaton(items, window))]})

    return dealt.groupBy("block").applyInPandas(build, "block bigint, automaton binary")


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (hit words as [start, end)) and ``items`` (ids, sorted as strings).

    A window is ``window`` consecutive words of an item, or the whole of a shorter one.
    """
    spark = docs.sparkSession
    blocks = written(_blocks(benchmark, block_words, window), "automata")
    numbers = sorted(r[0] for r in blocks.select("block").collect())
    names = [c for c in docs.columns if c not in _RESULT.names]
    plain = docs.select(*names)
    schema = T.StructType(plain.schema.fields + _RESULT.fields)
    marked = plain.select(
        "*",
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(_RESULT["spans"].dataType).alias("spans"),
        F.array().cast(_RESULT["items"].dataType).alias("items"),
    )
    for turn, number in enumerate(numbers or [None]):
        payload = pickle.dumps(ItemAutomaton([], window))
        if number is not None:
            payload = blocks.where(F.col("block") == number).first()["automaton"]
        shared = spark.sparkContext.broadcast(payload)
        if turn:
            marked = written(marked, "marked")
        marked = marked.mapInArrow(_marker(shared), schema)
    return marked


def _marker(shared):
    def run(batches):
        automaton = pickle.loads(shared.value)
        for batch in batches:
            n_words, spans, items = [], [], []
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            for text, (spans_before, items_before) in zip(texts_of(batch.column("text")), before):
                words = item_words(text)
                found, names = automaton.match(words)
                n_words.append(len(words))
                spans.append(_union(spans_before, found))
                items.append(sorted(set(items_before).union(n for n in names if n is not None)))
            at = batch.schema.get_field_index
            for name, values, kind in (
                ("n_words", n_words, pa.int64()),
                ("spans", spans, pa.list_(pa.list_(pa.int32()))),
                ("items", items, pa.list_(pa.string())),
            ):
                batch = batch.set_column(at(name), name, pa.array(values, kind))
            yield batch

    return run


def _union(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    if not a or not b:
        return a or b
    out: list[list[int]] = []
    for start, end in sorted(a + b):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def n_hit() -> F.Column:
    return F.aggregate("spans", F.lit(0), lambda n, s: n + s[1] - s[0]).cast("bigint")


def contaminated() -> F.Column:
    return (n_hit() > 0) & (ONE_IN * n_hit() >= F.col("n_words"))


def without_spans(marked: DataFrame) -> DataFrame:
    """Marked documents with the hit words' text cut out of ``text``, where they have any."""
    names = marked.columns

    def run(batches):
        import re

        # runs of the bytes that item_words keeps, before lower-casing
        word = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
        for batch in batches:
            texts = []
            for text, spans, old in zip(
                texts_of(batch.column("text")), batch.column("spans").to_pylist(), batch.column("text")
            ):
                if not spans:
                    texts.append(old.as_py())
                    continue
                places = [m.span() for m in word.finditer(text)]
                kept, last = [], 0
                for start, end in spans:
                    kept.append(text[last : places[start][0]])
                    last = places[end - 1][1]
                texts.append(b"".join([*kept, text[last:]]).decode())
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    return marked.mapInArrow(run, marked.schema).select(*names)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones, in the same columns; all others are left as they are."""
    marked = mark(docs, benchmark)
    return marked.where(~contaminated()).select(*[c for c in docs.columns])
