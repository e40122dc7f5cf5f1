import base64
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from varve.llm import bpe
from varve.llm import queries as Q

from .brute import sha
from .data import SF_DIR, frame, pairs, rows_by, table

PATH, PATTERN = public_tokenizers.path(Q.RANKS), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_query_against_the_library(spark, library):
    got = rows_by(Q.op3_byte_bpe(spark, SF_DIR))
    docs = pairs(table("documents"))
    assert len(got) == len(docs)
    for name, text in docs:
        ids = library.encode_ordinary(text)
        assert got[name]["n_tokens"] == len(ids)
        assert got[name]["ids_sha256"] == sha(",".join(map(str, ids)).encode())
        assert got[name]["decoded_sha256"] == sha(text.encode())


ODD = ["", " ", "\n\n\n   x", "a" * 5000, "ab" * 3000, "日本語テキスト" * 50, "🙂🙂🏽‍♀️", "\x00\x01﻿", "<|endoftext|>", "don't we'll", "Ünïcödé" * 40, "0123456789" * 99, " " * 999 + "z"]


def test_odd_texts(library):
    codec = bpe.codec(PATH, PATTERN)
    for text in ODD:
        assert codec.encode(text) == library.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text.encode()


def test_neighbours_as_merging_has_them():
    codec = bpe.codec(PATH, PATTERN)
    assert codec.ordered
    rng = random.Random(5)
    known = sorted(codec.parts)
    short = [r for r in known if codec.size[r] <= 3] + list(range(256))
    for _ in range(20_000):
        left, right = rng.choice(short if rng.random() < 0.5 else known), rng.choice(short if rng.random() < 0.5 else known)
        pair = [codec.tokens[left], codec.tokens[right]]
        assert codec.may_meet(left, right) == (codec.merged(b"".join(pair)) == pair), pair


def test_small_memory_and_unreachable_tokens():
    # "abc" is no merge of two tokens: only a piece that is "abc" itself may be it
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"aa": 257, b"xyz": 258, b"aaa": 259}
    codec = bpe.BpeCodec(ranks, r"\S+|\s+", memory=2)
    library = tiktoken.Encoding("tiny", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    for text in ["xyz", "xyzx", "aaaa", "aaaaa bc abcbc", "aabcaa", "a" * 31]:
        assert codec.encode(text) == library.encode_ordinary(text)


def test_nulls_repeats_and_clashing_names(spark):
    docs = frame(spark, [(1, None, 7), (2, "", 7), (3, "hi there", 7), (3, "hi there", 7)], "doc_id bigint, text string, n_tokens int")
    encoded = bpe.encode(docs, PATH, PATTERN)
    rows = bpe.decode(encoded, PATH).collect()
    assert sorted((r["doc_id"], r["n_tokens"], bytes(r["decoded"])) for r in rows) == [
        (1, 0, b""), (2, 0, b""), (3, 2, b"hi there"), (3, 2, b"hi there")]
    assert bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0


def test_ranks_file_is_read_as_given():
    with open(PATH, "rb") as lines:
        token, rank = next(lines).split()
    assert bpe.read_ranks(PATH)[base64.b64decode(token)] == int(rank)


def test_ids_are_packed_and_decoded_by_columns():
    codec = bpe.BpeCodec(bpe.read_ranks(PATH), PATTERN, memory=50)
    for text in ODD:
        assert np.frombuffer(codec.packed(text), np.int32).tolist() == codec.encode(text)
    tokens = bpe.tokens_of(PATH)
    lists = pa.array([[9], None, *[codec.encode(t) for t in ODD], [], [5, 6]], pa.list_(pa.int32()))
    for part, want in ((lists, [codec.decode([9]), b"", *[t.encode() for t in ODD], b"", codec.decode([5, 6])]), (lists.slice(1, 4), [b"", *[t.encode() for t in ODD[:3]]]), (lists.slice(0, 0), [])):
        assert bpe.joined_tokens(part, tokens).to_pylist() == want
    with pytest.raises(KeyError):
        bpe.joined_tokens(pa.array([[1, None]], pa.list_(pa.int32())), tokens)
