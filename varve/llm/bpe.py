"""Byte-level BPE encoding and decoding from a rank file, in linear time.

A piece of text that is itself a token is that token. For any other piece the tokens that occur
in it come from an Aho-Corasick automaton over the bytes mapped to Latin-1; the encoder takes the
longest token at each place and backtracks when it can't follow the token before. Two tokens may be
neighbours exactly when merging their joined bytes by rank gives the two back, which is remembered
per pair. A merge that crosses a token border would show up in the pair beside it, so a sequence of
fitting neighbours is the sequence that merging by rank gives.

Defined results: a null or empty text has no tokens and decodes to the empty bytes.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from varve.llm.columns import texts_of

#: Pieces and pairs that a worker remembers before it starts afresh.
MEMORY = 600_000
#: Rows whose ids a worker holds at once.
ROWS = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Pieces(dict):
    """What is remembered of pieces: their ids as packed 32-bit numbers; a piece not seen yet is encoded first."""

    def __init__(self, pack, memory: int):
        self.pack, self.memory = pack, memory

    def __missing__(self, piece: str) -> bytes:
        found = self.pack(piece)
        if len(self) >= self.memory:
            self.clear()
        self[piece] = found
        return found


class BpeCodec:
    """Encoder and decoder for one rank table; ``pattern`` splits text into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = MEMORY):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.memory = memory
        self.known = _Pieces(self._pack, memory)
        self.fits: dict[tuple[int, int], bool] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) == 1 or self._reached(token):
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        # where every token ranks above its parts, merges happen in the order of rank
        self.ordered = all(max(pair) < rank for rank, pair in self.parts.items())

    def merged(self, piece: bytes, until: int = 1) -> list[bytes]:
        """Merging by rank, the lowest and then the leftmost first; quadratic, so for short pieces only."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > until:
            best, at = min((ranks.get(a + b, len(ranks) + 1), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if parts[at] + parts[at + 1] not in ranks:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _reached(self, token: bytes) -> bool:
        """Whether merging gives the token as one; if so, its last two parts are kept."""
        last = self.merged(token, until=2)
        if len(last) == 2:
            self.parts[self.ranks[token]] = (self.ranks[last[0]], self.ranks[last[1]])
        return len(last) == 2

    def may_meet(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes gives the two tokens back."""
        if not self.ordered:
            pair = [self.tokens[left], self.tokens[right]]
            return self.merged(b"".join(pair)) == pair
        tokens, ranks, parts = self.tokens, self.ranks, self.parts
        below = len(ranks) + 1  # merges from this rank on had not happened yet
        while True:
            across = ranks.get(tokens[left] + tokens[right])
            if across is not None and across < below:
                return False
            # take the later of the two tokens apart again
            if left > right and left in parts:
                below, left = left, parts[left][1]
            elif right in parts and (right >= left or left not in parts):
                below, right = right + 1, parts[right][0]  # of equal ranks, the left merge comes first
            else:
                return True

    def split(self, piece: bytes) -> list[int]:
        """The tokens of a piece that is no token."""
        length = len(piece)
        size, fits = self.size, self.fits
        at: list[list[int]] = [[] for _ in range(length)]
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            at[end + 1 - size[token]].append(token)  # of one start, shorter ones come first
        chosen: list[int] = []
        place, left = 0, -1
        while place < length:
            options = at[place]  # what is left to try here; a place with nothing left is dead
            while options:
                token = options.pop()
                end = place + size[token]
                if end == length or at[end]:
                    if left >= 0:
                        good = fits.get((left, token))
                        if good is None:
                            if len(fits) >= self.memory:
                                fits.clear()
                            good = fits[left, token] = self.may_meet(left, token)
                        if not good:
                            continue
                    chosen.append(token)
                    place, left = end, token
                    break
            else:
                if not chosen:
                    raise ValueError("the rank table lacks a byte of the text")
                place -= size[chosen.pop()]
                left = chosen[-1] if chosen else -1
        return chosen

    def _pack(self, piece: str) -> bytes:
        data = piece.encode()
        rank = self.ranks.get(data)
        return array("i", self.split(data) if rank is None else (rank,)).tobytes()

    def packed(self, text: str) -> bytes:
        """The ids of a text as packed 32-bit numbers."""
        return b"".join(map(self.known.__getitem__, self.pieces(text)))

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_codecs: dict[tuple[str, str], BpeCodec] = {}
_tokens: dict[str, pa.BinaryArray] = {}


def codec(path: str, pattern: str) -> BpeCodec:
    """The codec of a rank file, built once per Python process."""
    key = (path, pattern)
    if key not in _codecs:
        _codecs[key] = BpeCodec(read_ranks(path), pattern)
    return _codecs[key]


def tokens_of(path: str) -> pa.BinaryArray:
    """The bytes of each id by its number, null for numbers that are no id; all that decoding needs."""
    if path not in _tokens:
        tokens = {rank: token for token, rank in read_ranks(path).items()}
        _tokens[path] = pa.array([tokens.get(rank) for rank in range(max(tokens, default=-1) + 1)], pa.binary())
    return _tokens[path]


def joined_tokens(ids: pa.ListArray, tokens: pa.BinaryArray) -> pa.BinaryArray:
    """For each row the bytes its ids stand for, end to end; a null row has none."""
    sizes = ids.value_lengths().fill_null(0).to_numpy()
    found = tokens.take(ids.flatten())
    if found.null_count:
        raise KeyError("a number that is no id")
    _, where, data = found.buffers()
    ends = np.frombuffer(where, np.int32)[found.offset : found.offset + len(found) + 1] if len(found) else np.zeros(1, np.int32)
    rows = ends[np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))]  # tokens stand end to end, so rows begin where their first one does
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(rows), data if data is not None else pa.py_buffer(b"")])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids``; a column of such a name is replaced.

    ``path`` is a rank file that every executor can open, like the library it belongs to.
    """
    own = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    plain = docs.select(*[c for c in docs.columns if c not in ("n_tokens", "ids")])

    def run(batches):
        bpe = codec(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                packed = [bpe.packed(t.decode()) for t in texts_of(part.column("text"))]
                sizes = np.array([len(p) for p in packed], np.int64) // 4
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(sizes), ids],
                    [*part.schema.names, "n_tokens", "ids"],
                )

    return plain.mapInArrow(run, T.StructType(plain.schema.fields + own))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes that ``ids`` stand for; null ids are none."""
    plain = encoded.select(*[c for c in encoded.columns if c != "decoded"])

    def run(batches):
        tokens = tokens_of(path)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                data = joined_tokens(part.column("ids"), tokens)
                yield pa.RecordBatch.from_arrays([*part.columns, data], [*part.schema.names, "decoded"])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("decoded", T.BinaryType())]))
