import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.data import frame, pairs, rows_by, table
from varve.llm import periodic, queries
from varve.llm.columns import steps


def found(df):
    return {k: [tuple(x) for x in r["runs"]] for k, r in rows_by(df).items()}


def random_text(rnd):
    alphabet = rnd.choice([["a"], ["a", "b"], ["é", "b", "c"], [f"w{i}" for i in range(40)]])
    words = [rnd.choice(alphabet) for _ in range(rnd.choice([0, 1, 5, 9, 30, 150]))]
    if len(words) > 20 and rnd.random() < 0.6:
        a = rnd.randrange(len(words))
        p = 1 + rnd.randrange(max(1, (len(words) - a) // 3))
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
    return rnd.choice(["", " ", "\t"]) + rnd.choice([" ", " \n"]).join(words) + rnd.choice(["", "\n"])


@pytest.mark.parametrize("least, exponent", [(6, 4), (2, 2), (9, 3), (4, 2)])
def test_random_texts_equal_brute_force(spark, least, exponent):
    rnd = random.Random(least)
    docs = [(i, random_text(rnd)) for i in range(150)]
    got = rows_by(periodic.mark_runs(frame(spark, docs).repartition(3), min_length=least, min_exponent=exponent))
    for name, text in docs:
        words = brute.solid_words(text)
        runs = brute.runs(words, least, exponent)
        assert [tuple(x) for x in got[name]["runs"]] == runs, text
        assert got[name]["collapsed"] == " ".join(brute.collapsed(words, runs))
        assert got[name]["n_words"] == len(words)


def test_given_documents_equal_brute_force(spark):
    docs = pairs(table("documents"))
    got = rows_by(queries.op11_periodic_runs(spark, "/root/testdata/sf0.001"))
    assert len(got) == len(docs)
    for name, text in docs:
        words = brute.solid_words(text)
        h = zlib.crc32(str(name).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute.runs(words, 6, 4)
        row = got[name]
        assert row["n_runs"] == len(runs)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert row["runs_sha256"] == brute.sha(lines.encode())
        assert row["collapsed_sha256"] == brute.sha(" ".join(brute.collapsed(words, runs)).encode())
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        assert (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
    assert any(r["n_runs"] for r in got.values())


def test_runs_by_hand(spark):
    docs = [
        (1, "x a b a b a b a b y"),  # 4 periods of 2
        (2, "a a a a a"),  # five words are too few
        (3, "a a a a a a"),
        (4, "a b a b a b a"),  # 3.5 periods
        (5, "a a b a a b a a b a a b"),  # of period 3, no run of one word
        (6, "a a a a a a b a a a a a a b"),  # two runs; the period of 7 occurs twice only
    ]
    assert found(periodic.mark_runs(frame(spark, docs))) == {
        1: [(1, 8, 2)], 2: [], 3: [(0, 6, 1)], 4: [], 5: [(0, 12, 3)], 6: [(0, 6, 1), (7, 6, 1)],
    }


def test_best_run_and_ties(spark, monkeypatch):
    docs = [(2, "a a a a a a x b b b b b b"), (3, "a b a b a b a b"), (4, "no runs")]
    monkeypatch.setattr(queries, "_table", lambda *a: frame(spark, docs))
    monkeypatch.setattr(queries, "with_planted_periods", lambda d: d)
    got = rows_by(queries.op11_periodic_runs(spark, ""))
    assert [got[2][c] for c in ("n_runs", "start", "length", "period", "exponent_milli")] == [2, 0, 6, 1, 6000]
    assert [got[3][c] for c in ("start", "length", "period", "exponent_milli")] == [0, 8, 2, 4000]
    assert [got[4][c] for c in ("n_runs", "start", "length", "period", "exponent_milli")] == [0] + [None] * 4
    assert got[4]["runs_sha256"] == hashlib.sha256(b"").hexdigest()


def test_nulls_empty_repeated_rows_and_clashing_names(spark):
    rows = [(None, None, "x"), (1, "", None), (1, "", None), (2, " \n", "y"), (None, "a " * 9, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string")
    marked = periodic.mark_runs(docs.withColumn("_text", F.lit(1)))
    assert marked.columns == ["doc_id", "text", "_text", "n_words", "runs", "collapsed"]
    got = marked.collect()
    assert len(got) == 5
    assert sorted((r["n_words"], len(r["runs"]), r["collapsed"]) for r in got) == [(0, 0, "")] * 4 + [(9, 1, "a")]
    assert periodic.mark_runs(docs.where("false")).count() == 0


def test_very_long_texts(spark):
    # one word throughout, and a long period: time must not grow with the square of the length
    words = [str(i % 1000) for i in range(200_000)]
    docs = frame(spark, [(1, "a " * 200_000), (2, " ".join(words)), (3, "a b")])
    assert found(periodic.mark_runs(docs)) == {1: [(0, 200_000, 1)], 2: [(0, 200_000, 1000)], 3: []}


def test_suffix_order_and_common_prefixes():
    rnd = random.Random(7)
    texts = [random_text(rnd) for _ in range(30)]
    (_, _, buf, offsets), = steps(pa.array(texts))
    begins, finishes = periodic.word_ends(buf, offsets)
    words, edges = periodic._numbers(buf, begins, finishes), np.searchsorted(begins, offsets)
    order, prefix = periodic.suffix_order(words, edges, 2)
    text = np.searchsorted(edges, order, "right") - 1
    suffixes = [(t, *words[p : edges[t + 1]].tolist()) for p, t in zip(order.tolist(), text.tolist())]
    assert suffixes == sorted(suffixes) and len(suffixes) > 50
    for i in range(1, len(suffixes)):
        a, b = suffixes[i - 1], suffixes[i]
        same = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert prefix[i] == (max(same - 1, 0) if a[0] == b[0] else 0)
