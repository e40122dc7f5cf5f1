import numpy as np
import pytest

from varve.llm import queries as Q
from varve.llm import substrings as S
from varve.llm import suffixes as B

from .brute import repeated_bytes, repeated_words, sha
from .data import SF_DIR, frame, pairs, rows_by, table


def test_words_against_brute_force(spark):
    expected = repeated_words(pairs(table("documents")))
    got = rows_by(Q.op4_substring_dedup(spark, SF_DIR))
    assert len(got) == len(expected)
    assert sum(len(kept) < n for n, kept in expected.values()) > 10
    for name, (n, kept) in expected.items():
        assert (got[name]["n_words"], got[name]["n_removed"]) == (n, n - len(kept)), name
        assert got[name]["kept_sha256"] == sha(" ".join(kept).encode())


def runs(gone):
    return sum(i - 1 not in gone for i in gone)


def test_bytes_against_brute_force(spark):
    expected = repeated_bytes(pairs(table("documents")))
    got = rows_by(Q.op7_suffix_dedup(spark, SF_DIR))
    assert len(got) == len(expected)
    for name, (data, gone) in expected.items():
        row = got[name]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (len(data), len(gone), runs(gone)), name
        assert row["kept_sha256"] == sha(bytes(b for i, b in enumerate(data) if i not in gone))


def made(seed, count, letters, longest):
    """Texts cut and joined from few pieces: nested, shifted, periodic and tied repeats."""
    rng = np.random.default_rng(seed)
    pieces = [" ".join(rng.choice(letters, rng.integers(1, 30))) for _ in range(12)]
    return [(i, "  ".join(rng.choice(pieces, rng.integers(0, longest)))) for i in range(count)]


@pytest.mark.parametrize("seed, letters", [(1, list("ab")), (2, ["one", "two", "three", "é"]), (3, ["x"])])
@pytest.mark.parametrize("crowd", [5_000, 1])
def test_repetitive_texts(spark, seed, letters, crowd):
    docs = made(seed, 40, letters, 12)
    words = rows_by(S.without_duplicates(frame(spark, docs), window=8))
    for name, (n, kept) in repeated_words(docs, 8).items():
        assert (words[name]["n_words"], words[name]["kept"]) == (n, " ".join(kept)), name
        if len(kept) == n:
            assert words[name]["text"] == docs[name][1]
        assert words[name]["text"].split() == kept
    got = rows_by(B.without_repeats(frame(spark, docs), window=25, k=6, group_contexts=crowd))
    for name, (data, gone) in repeated_bytes(docs, 25).items():
        assert bytes(got[name]["kept"]) == bytes(b for i, b in enumerate(data) if i not in gone), name


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(None, "a b c d e"), (1, None), (2, ""), (3, "a b c d e"), (3, "a b c d e"), (4, "z a b c d e y"), (5, long), (6, long)]
    docs = frame(spark, [(*r, "x") for r in rows], "doc_id bigint, text string, n_words string")
    got = S.without_duplicates(docs, window=5)
    assert got.columns == ["doc_id", "text", "n_words", "n_removed", "kept"]
    by = {}
    for r in got.collect():
        by.setdefault(r["doc_id"], []).append((r["text"], r["n_removed"], r["kept"]))
    assert by[None] == [("a b c d e", 0, "a b c d e")]
    assert by[1] == [(None, 0, "")] and by[2] == [("", 0, "")]
    assert by[3] == [("", 5, "")] * 2
    assert by[4] == [("z y", 5, "z y")]
    assert by[5][0][1] == 0 and by[6][0][1] == 60_000
    assert S.without_duplicates(docs.limit(0)).count() == 0
    assert B.without_repeats(docs.limit(0)).count() == 0
    cut = {r["doc_id"]: bytes(r["kept"]) for r in B.without_repeats(docs, window=9, k=4).collect()}
    assert cut[None] == b"a b c d e" and cut[1] == cut[2] == cut[3] == b"" and cut[4] == b"z  y"


def test_buckets_are_exact():
    rng = np.random.default_rng(0)
    buf = rng.integers(97, 99, 3000).astype(np.uint8)
    starts = np.arange(len(buf) - 13)
    for window in (1, 7, 8, 9, 13):
        number = B.buckets(buf, starts, window)
        strings = {}
        for s, n in zip(starts, number):
            assert strings.setdefault(buf[s : s + window].tobytes(), n) == n
        assert len(set(strings.values())) == len(strings)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_passage_of_two_documents_whatever_ansi_is(spark, ansi):
    passage = " ".join(f"p{i}" for i in range(90))
    docs = frame(spark, [(1, f"one {passage}"), (2, f"two {passage}")])
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        words = rows_by(S.without_duplicates(docs))
        texts = rows_by(B.without_repeats(docs))
        assert words[2]["n_removed"] == 90 and words[1]["n_removed"] == 0
        assert texts[2]["n_removed"] >= len(passage) and texts[1]["n_removed"] == 0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
