import zlib

from varve.llm import queries as Q
from varve.llm import sharding as S

from .data import SF_DIR, frame, pairs, rows_by, table


def check_law(rows, shards, largest):
    sizes = {s: 0 for s in range(shards)}
    slots = {s: [] for s in range(shards)}
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query(spark):
    got = rows_by(Q.op8_sharding(spark, SF_DIR))
    docs = pairs(table("documents"))
    assert len(got) == len(docs)
    for name, text in docs:
        data = text.encode()
        assert (got[name]["size"], got[name]["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert got[name]["law"] == "bytes" and got[name]["grown_shard"] is None
    check_law(got.values(), 24, max(r["size"] for r in got.values()))


def test_hot_group_nulls_repeats_and_long_text(spark, tmp_path):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i} " * (i % 7), "c") for i in range(3000)]
    rows += [(None, None, "c"), (None, None, "c"), (5, "x" * 20_000, "c"), (7, "", None), (7, "", None)]
    df = frame(spark, rows, "doc_id bigint, text string, size string")
    out = S.write_shards(df, str(tmp_path / "s"), 8, range_bytes=2000)
    assert sorted(out.columns) == ["doc_id", "shard", "size", "slot", "text"]
    got = out.collect()
    assert len(got) == len(rows)
    check_law(got, 8, 20_008)
    same = {r["shard"] for r in got if r["text"] == "same text"}
    assert len(same) < 8  # neighbours, but spread as far as the sizes ask


def test_equal_texts_stay_together_where_they_fit(spark, tmp_path):
    rows = [(i, f"group {i % 100} " * 20) for i in range(1000)]
    got = S.write_shards(frame(spark, rows), str(tmp_path / "s"), 4).collect()
    homes = {}
    for r in got:
        homes.setdefault(r["text"], set()).add(r["shard"])
    assert sum(len(h) > 1 for h in homes.values()) <= 3


def test_empty(spark, tmp_path):
    assert S.write_shards(frame(spark, []), str(tmp_path / "s"), 4).count() == 0
