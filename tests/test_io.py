import glob
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from varve.plans import jobs
from varve.session import fresh_path, scratch_dir
from varve.sources import sinks, text


def _parts(path):
    return [open(p, encoding="utf-8").read().splitlines() for p in sorted(glob.glob(f"{path}/part-*"))]


def test_sorted_parts_follow_each_other(spark):
    lines = spark.range(2000).select(
        F.concat_ws(",", "id", F.lit("x"), F.concat(F.lit("k"), (F.col("id") * 7919 % 50).cast("string"))).alias("value")
    )
    path = fresh_path(spark, "lines")
    sinks.write_sorted_lines(lines, path, 2)
    joined = [line for part in _parts(path) for line in part]
    assert len(joined) == 2000
    keys = [line.split(",")[2] for line in joined]
    assert keys == sorted(keys)


def test_csv_append_adds_without_header(spark):
    path = fresh_path(spark, "csv")
    df = spark.createDataFrame([("FR", 2), ("FR", 1)], "cca2 string, n int")
    sinks.append_sorted_csv(df, path, ["cca2", "n"])
    sinks.append_sorted_csv(df, path, ["cca2", "n"])
    assert sorted(line for part in _parts(path) for line in part) == ["FR,1", "FR,1", "FR,2", "FR,2"]


def test_csv_scan_infers_types_or_takes_a_schema(spark, tmp_path):
    file = tmp_path / "export.csv"
    file.write_text('cca2,timestamp,note\nUS,3,"a,b"\nFR,12,c\n')
    inferred = text.scan_csv(spark, str(file))
    assert dict(inferred.dtypes)["timestamp"] == "int"
    assert [r["note"] for r in inferred.orderBy("cca2", "timestamp").collect()] == ["c", "a,b"]
    given = text.scan_csv(spark, str(file), "cca2 string, timestamp string, note string")
    assert dict(given.dtypes)["timestamp"] == "string"


def test_lines_of_whole_files(spark, tmp_path):
    (tmp_path / "link1").write_text("a\tb\r\nc\x0bd\n", encoding="utf-8", newline="")
    (tmp_path / "link2").write_text("e", encoding="utf-8")
    (tmp_path / "other").write_text("no", encoding="utf-8")
    rows = text.scan_file_lines(spark, f"{tmp_path}/link*").collect()
    assert sorted(r["value"] for r in rows) == ["a\tb", "c", "d", "e"]
    assert len({r["file"] for r in rows}) == 2
    assert text.scan_lines(spark, f"{tmp_path}/link*").count() == 3


def test_file_lines_equal_a_split_of_the_whole_text(spark, tmp_path):
    texts = [
        "", "\n", "a", "a\n", "a\x0b", "a\x0b\n", "a\x0b\r\n", "a\r", "a\r\r\n", "\x0b", "a\x0b\x0c", "a\x0b\x0c\nb\u2028", "\u2029\n\x1c",
        "é\x85\nx\x1e\ny", "a\rb\r\nc\r", "x\n\ny\x0b\n\n",
    ]
    for i, content in enumerate(texts):
        (tmp_path / f"file{i:02}").write_text(content, encoding="utf-8", newline="")
    rows = text.scan_file_lines(spark, f"{tmp_path}/file*").collect()
    got = {}
    for r in rows:
        got.setdefault(int(r["file"][-2:]), []).append(r["value"])
    for i, content in enumerate(texts):
        assert sorted(got.get(i, [])) == sorted(content.splitlines()), repr(content)


def test_the_last_line_of_a_file_in_splits(spark, tmp_path):
    content = "".join(f"line {i}\x0b\n" for i in range(5_000)) + "end\x0b"
    (tmp_path / "big").write_text(content, encoding="utf-8", newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        lines = text.scan_file_lines(spark, str(tmp_path / "big"))
        assert lines.count() == len(content.splitlines()) == 10_001
        assert lines.where("value = ''").count() == 5_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_rank_layouts(spark):
    ranks = spark.createDataFrame([("a", 0.575), ("b c", 1.0)], "node string, rank double")
    first, second = fresh_path(spark, "tuples"), fresh_path(spark, "tsv")
    sinks.write_rank_tuples(ranks, first)
    sinks.write_rank_tsv(ranks, second)
    assert sorted(sum(_parts(first), [])) == ["('a', 0.575)", "('b c', 1.0)"]
    assert sorted(sum(_parts(second), [])) == ["a\t0.575", "b c\t1.0"]


def _session(master, checkpoint_dir=None):
    conf = {} if checkpoint_dir is None else {"spark.checkpoint.dir": checkpoint_dir}
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=SimpleNamespace(get=conf.get), sparkContext=context)


def test_scratch_follows_the_session():
    assert scratch_dir(_session("spark://host:7077", "hdfs://nn/shared/")) == "hdfs://nn/shared"
    assert scratch_dir(_session("local[2]")) == scratch_dir(_session("local[2]"))
    with pytest.raises(ValueError):
        scratch_dir(_session("spark://host:7077"))


def test_jobs_run_from_path_to_path(spark, tmp_path):
    source = tmp_path / "export.csv"
    source.write_text("cca2,timestamp,n\nUS,3,a\nFR,2,b\nUS,1,c\nFR,1,d\nUS,1,c\n")
    jobs.sort_csv(spark, str(source), str(tmp_path / "csv"))
    ordered = [line for part in _parts(tmp_path / "csv") for line in part]
    assert ordered == ["FR,1,d", "FR,2,b", "US,1,c", "US,1,c", "US,3,a"]

    jobs.sort_text(spark, str(source), str(tmp_path / "text"), field=0, header="cca2,timestamp,n")
    ordered = [line for part in _parts(tmp_path / "text") for line in part]
    assert ordered == ["FR,1,d", "FR,2,b", "US,1,c", "US,1,c", "US,3,a"]

    (tmp_path / "link1").write_text("A\tB\nB\tA\n")
    (tmp_path / "link2").write_text("b\tc\nTalk:x\ta\nno tab\n")
    jobs.rank_links(spark, f"{tmp_path}/link*", str(tmp_path / "ranks"), rounds=1)
    assert sorted(sum(_parts(tmp_path / "ranks"), [])) == ["('a', 0.575)", "('b', 1.0)", "('c', 0.575)"]


def test_whole_files_sort_no_lines(spark, tmp_path):
    (tmp_path / "a").write_bytes("x\ny\x0b\nz ".encode())
    lines = text.scan_file_lines(spark, str(tmp_path / "a"))
    assert sorted(r["value"] for r in lines.collect()) == ["", "x", "y", "z"]
    plan = lines._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") >= 2
    # only the splits' own rows, a few per file, are compared by place
    assert plan.count("SortAggregate") == 2 and "max(_at" not in plan
