import numpy as np
import pytest

from varve.llm import jaccard as J
from varve.llm import queries as Q
from varve.llm.components import components as connected

from .brute import components
from .data import SF_DIR, frame, pairs, rows_by, table


def test_query_against_brute_force(spark):
    expected = components(pairs(table("documents")))
    got = rows_by(Q.op6_jaccard_join(spark, SF_DIR))
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in got.items()} == expected
    assert sum(c != k for k, (_, c) in expected.items()) > 5


def edited(rng, words, share):
    out = list(words)
    for i in np.flatnonzero(rng.random(len(out)) < share):
        out[i] = f"new{rng.integers(10**6)}"
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_chains_and_hot_shingles(spark, seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = list(rng.choice(vocabulary, 30))
    docs = []
    for _ in range(6):
        base = list(rng.choice(vocabulary, rng.integers(3, 90)))
        for share in (0, 0, 0.01, 0.02, 0.03, 0.05, 0.08):
            docs.append(edited(rng, base, share))
        chain = base
        for _ in range(4):
            chain = edited(rng, chain, 0.03)
            docs.append(chain)
    docs += [list(rng.choice(vocabulary, rng.integers(1, 40))) + passage for _ in range(40)]
    docs += [passage[: rng.integers(1, 30)] for _ in range(25)]
    order = rng.permutation(len(docs))
    rows = [(int(i), " ".join(docs[i]) if rng.random() < 0.9 else " ".join(docs[i]).upper()) for i in order]
    got = rows_by(J.similarity_components(frame(spark, rows)), "doc")
    assert {k: (r["n_shingles"], r["component"]) for k, r in got.items()} == components(rows)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, long), (8, long + " tail"), (8, long + " tail")]
    docs = frame(spark, [(*r, 0, "mine") for r in rows], "doc_id bigint, text string, component int, doc string")
    got = J.similarity_components(docs).collect()
    assert len(got) == len(rows)
    assert {(r["doc"], r["n_shingles"], r["component"]) for r in got} == {
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 59_996, 7), (8, 59_997, 7)}
    kept = J.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["doc"]) for r in kept.collect()) == [(i, "mine") for i in (1, 2, 3, 4, 6, 7)]
    assert J.similarity_components(docs.limit(0)).count() == 0


def test_null_and_repeated_ids_lose_no_text(spark):
    far = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcdefg"]
    near = [far[i] + " more" for i in range(7)]
    rows = [(None, far[0]), (None, far[1]), (None, far[1]), (None, ""), (None, ""), (5, far[2]), (5, far[3]), (6, near[2])]
    rows += [(7, near[3]), (8, far[4]), (8, far[4]), (9, far[5]), (None, near[5]), (10, ""), (10, "")]
    docs = frame(spark, rows)
    kept = [(r["doc_id"], r["text"]) for r in J.one_of_each_group(docs).collect()]
    assert sorted(kept, key=str) == sorted(
        [(None, far[0]), (None, far[1]), (None, ""), (None, ""), (5, far[2]), (5, far[3]), (8, far[4]), (None, near[5]), (10, "")], key=str
    )
    got = J.similarity_components(docs).collect()
    assert sorted(r["doc"] for r in got if r["doc"] is not None) == [5, 5, 6, 7, 8, 8, 9, 10, 10]
    sizes = {}
    for r in got:
        sizes[r["component"]] = sizes.get(r["component"], 0) + 1
    assert sorted(sizes.values()) == [1, 1, 1, 2, 2, 2, 2, 2, 2]
    assert {5, 8, 9, 10} <= set(sizes) and all(c < -(2**62) for c in set(sizes) - {5, 8, 9, 10})


def test_filters():
    for x in range(1, 60):
        for y in range(1, 60):
            need = next(i for i in range(200) if 100 * i >= 75 * (x + y - i))
            assert J.needed(x, y) == need
            if need <= min(x, y):  # two sets with that much in common share a shingle of their prefixes
                assert J.prefix_size(x) + need > x and J.prefix_size(y) + need > y


def test_pairs_of_one_shingle():
    entries = np.zeros(6, J._ENTRY)
    entries["id"], entries["size"] = [5, 3, 9, 4, 8, 7], [10, 10, 12, 13, 20, 100]
    entries["part"] = [1, 1, 2, 3, 4, 5]
    assert sorted(map(tuple, J.hub_pairs(entries).tolist())) == [(0, 3, 4), (0, 3, 5), (0, 3, 9)]
    assert sorted(map(tuple, J.cross_pairs(entries, block=2).tolist())) == [(3, 4), (3, 9), (4, 5), (4, 9), (5, 9)]
    # the one with the fewest rare shingles is the hub, where its size allows
    entries["rare"] = [7, 6, 9, 2, 1, 0]
    assert sorted(map(tuple, J.hub_pairs(entries).tolist())) == [(2, 4, 3), (2, 4, 5), (2, 4, 9)]
    entries["at"] = [0, 0, 0, 5, 0, 0]
    assert J.hub_pairs(entries).tolist() == []


def family(rng, size, vocabulary=20_000, words=120, changed=2):
    """A text and copies of it, each with some words of its own."""
    base = [f"w{i}" for i in rng.integers(0, vocabulary, words)]
    texts = [base]
    for _ in range(size - 1):
        copy = list(base)
        for i in rng.choice(words, changed, replace=False):
            copy[i] = f"new{rng.integers(10**9)}"
        texts.append(copy)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("first", [0, 1])
def test_pairs_of_a_family_grow_with_its_size(spark, monkeypatch, first):
    """With the text that all were copied from, and without it."""
    counted = []
    verify = J.verified_links

    def spy(texts, pairs):
        counted.append(pairs.count())
        return verify(texts, pairs)

    monkeypatch.setattr(J, "verified_links", spy)
    per_member = []
    for size in (100, 200, 400):
        counted.clear()
        rng = np.random.default_rng(size)
        texts = family(rng, size + first)[first:]
        rows = [(int(i), t) for i, t in zip(rng.permutation(size), texts)]
        got = {r["doc"]: r["component"] for r in J.similarity_components(frame(spark, rows)).collect()}
        assert got == {k: c for k, (_, c) in components(rows).items()}
        per_member.append(sum(counted) / size)
    assert max(per_member) < 5, per_member


def test_components_of_path_star_and_cycle(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(70, 71), (71, 72), (72, 70), (71, 70)]
    got = {r["node"]: r["component"] for r in connected(frame(spark, edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 40)}, 70: 70, 71: 70, 72: 70}
