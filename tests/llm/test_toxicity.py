import itertools
import pickle
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest

from varve.llm import queries as Q
from varve.llm import toxicity as X

from .data import frame, pairs, rows_by, table


def test_query_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = rows_by(Q.op9_toxicity(spark, sf_dir))
    docs = dict(pairs(table("documents", sf_dir)))
    assert got.keys() == docs.keys()
    for name, row in got.items():
        assert row["held_out"] == (zlib.crc32(str(name).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.5)
        for span in row["spans"]:
            assert docs[name][span["start"] : span["end"]].isalpha()
    labels = [(got[i], t) for i, t in zip(table("labels", sf_dir).doc_id, table("labels", sf_dir).toxic)]
    held = [(r, t) for r, t in labels if r["held_out"]]
    assert sum(r["predicted"] == t for r, t in held) >= 0.93 * len(held)
    clean = [r for r, t in held if not t]
    assert sum(r["predicted"] for r in clean) <= 0.05 * len(clean)
    toxic = [r for r, t in held if t and r["spans"]]
    assert toxic


@pytest.mark.parametrize("tokens", [["plain"], ["idiot"], ["plain", "idiot"], ["a", "idiot", "idiots", "b", "c"]])
def test_marginals_against_enumeration(tokens):
    field = X.Field({"=idiot": 3.0, "idio~": 1.5}, -2.0, np.array([[1.0, 0.4], [0.6, 0.9]]))
    score = [field.score(t) for t in tokens]
    weight, total = np.zeros(len(tokens)), 0.0
    for tags in itertools.product((0, 1), repeat=len(tokens)):
        w = np.exp(sum(s for s, t in zip(score, tags) if t)) * np.prod([field.moves[a, b] for a, b in zip(tags, tags[1:])])
        total += w
        weight += w * np.array(tags)
    assert np.allclose(field.marginals(tokens), weight / total)


def test_pair_expectations_against_enumeration():
    moves, lift = np.array([[1.0, 0.4], [0.6, 0.9]]), np.array([[0.2], [3.0], [1.0], [0.5]])
    pairs_, total = np.zeros(4), 0.0
    for tags in itertools.product((0, 1), repeat=4):
        w = np.prod([u[0] for u, t in zip(lift, tags) if t]) * np.prod([moves[a, b] for a, b in zip(tags, tags[1:])])
        total += w
        for a, b in zip(tags, tags[1:]):
            pairs_[2 * a + b] += w
    assert np.allclose(X._forward_backward(lift, moves, np.ones((4, 1), bool))[1], pairs_ / total)


def made(spark):
    rng = np.random.default_rng(3)
    words = [f"{a}{b}{c}" for a in "mnp" for b in "aeiou" for c in "rstlk"]
    docs, labels = [], []
    for i in range(300):
        text = list(rng.choice(words, 30))
        toxic = i % 4 == 0
        if toxic:
            text[rng.integers(30)] = ["Vileword", "VILEWORDS!", "vileworded"][i % 3]
        docs.append((i, " ".join(text), "x"))
        labels.append((i, int(toxic)))
    return frame(spark, docs, "doc_id bigint, text string, score string"), frame(spark, labels, "doc_id bigint, toxic int")


def test_learns_a_beginning_and_marks_its_place(spark):
    docs, labels = made(spark)
    more = frame(spark, [(1000, "İ fine, a vilewordly thing " + "mar " * 50_000, "x"), (1001, None, "x"), (1002, "", "x"), (1002, "", "x")], "doc_id bigint, text string, score string")
    got = X.tag_documents(docs.unionByName(more), labels.unionByName(labels)).collect()
    assert len(got) == 304
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["predicted"] == (i % 4 == 0) for i in range(300))
    assert [(s["start"], s["end"]) for s in by[1000]["spans"]] == [(10, 20)]
    assert by[1000]["predicted"] == 1
    assert by[1001]["predicted"] == by[1002]["predicted"] == 0
    assert by[1001]["score"] == by[1002]["score"]


def test_without_labels(spark):
    docs, labels = made(spark)
    assert {r["score"] for r in X.tag_documents(docs, labels.limit(0)).collect()} == {0.0}
    assert {r["score"] for r in X.tag_documents(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert X.tag_documents(docs.limit(0), labels).count() == 0


def test_memory_of_the_fit(monkeypatch):
    rng = np.random.default_rng(4)
    words = [f"{a}{b}{c}{d}" for a in "mnp" for b in "aeiou" for c in "rstlk" for d in "aeiou"]
    texts = [" ".join(rng.choice(words, 1_000)) + (" vileword" if i % 4 == 0 else "") for i in range(300)]
    rows = pd.DataFrame({"doc_id": range(300), "text": texts, "toxic": [int(i % 4 == 0) for i in range(300)]})
    monkeypatch.setattr(X, "one_task", lambda sample, learn, schema: learn(sample).to_dict("records"))
    monkeypatch.setattr(X, "STEPS", 3)
    monkeypatch.setattr(rows.__class__, "select", lambda self, *names: self[list(names)], raising=False)
    tracemalloc.start()
    try:
        weights = pickle.loads(X.fit(rows))[0]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert "=vileword" in weights
    assert peak < 170 * 300_000  # bytes a token


def test_documents_that_were_seen_before():
    texts = ["a b c d", "a b c e f g h", "x", None, "a b c d", "b c d a b c", "", "h g f e d c b a"]
    seen, fresh = set(), []
    for text in texts:
        words = (text or "").split()
        grams = set(zip(words, words[1:], words[2:]))
        fresh.append(not grams or len(grams & seen) < 0.3 * len(grams))
        seen |= grams
    assert X._distinct(X.TokenRows(texts)).tolist() == fresh
    assert X._distinct(X.TokenRows(["a"])).tolist() == [True]
