from datetime import datetime, timedelta

import pytest

from varve.operators import timing

START = datetime(2024, 1, 1)


def log_frame(spark, rows):
    rows = [(run, START + timedelta(seconds=at), i, phase, float(d)) for i, (run, at, phase, d) in enumerate(rows)]
    return spark.createDataFrame(rows, "run int, ts timestamp_ntz, event_id int, phase string, duration double")


@pytest.fixture(scope="module")
def tagged(spark):
    rows = [
        (1, 0, "forward", 9), (1, 2, "tick", 0),          # interval 0: 2 s, warm-up
        (1, 3, "forward", 1), (1, 4, "forward", 3), (1, 5, "backward", 2), (1, 7, "tick", 0),  # interval 1: 5 s
        (1, 9, "forward", 5), (1, 10, "tick", 0),         # interval 2: 3 s
        (1, 11, "optimize", 7),                           # after the last tick
        (2, 0, "forward", 1), (2, 1, "tick", 0),          # nothing after the warm-up
    ]
    return timing.tagged_log(log_frame(spark, rows))


def test_intervals_skip_the_warm_up(tagged):
    rows = sorted(tuple(r) for r in timing.iteration_intervals(tagged).collect())
    assert rows == [(1, 1, 5.0), (1, 2, 3.0)]
    assert timing.iteration_intervals(tagged, skip=0).count() == 4


def test_interval_summary(tagged):
    rows = timing.iteration_summary(tagged).collect()
    assert [tuple(r) for r in rows] == [(1, 2, 8.0, 5.0, 3.0, 4.0)]
    # two intervals are not more than skip = 2 would ask for
    assert [tuple(r)[:2] + (r["average"],) for r in timing.iteration_summary(tagged, skip=2).collect()] == [(1, 1, 0.0)]


def test_report_leaves_out_the_open_interval(tagged):
    rows = sorted(tuple(r) for r in timing.phase_pivot(tagged).collect())
    assert rows == [(1, 1, 5.0, 4.0, 2.0, 0.0, 0.0), (1, 2, 3.0, 5.0, 0.0, 0.0, 0.0)]


def test_phase_summary_has_zeros_for_unused_phases(tagged):
    rows = {(r["run"], r["phase"]): tuple(r)[2:] for r in timing.phase_summary(tagged).collect()}
    assert len(rows) == 8
    assert rows[1, "forward"] == (9.0, 5.0, 1.0, 3.0, 4.5)
    assert rows[1, "optimize"] == (7.0, 7.0, 7.0, 7.0, 7.0)
    assert rows[1, "communication"] == (0.0, 0.0, 0.0, 0.0, 0.0)
    assert all(rows[2, p] == (0.0,) * 5 for p in timing.PHASES)


def lines_of(tagged, skip):
    summary = timing.phase_summary(tagged, skip)
    return {(r["run"], r["phase"]): r["line"] for r in timing.phase_lines(summary, timing.iteration_summary(tagged, skip), skip).collect()}


def test_phase_lines(tagged):
    # run 1 has two intervals after the warm-up, run 2 none
    long = lines_of(tagged, 1)
    assert set(long) == {(1, p) for p in timing.PHASES}
    assert long[1, "forward"] == (
        "forward times total: 9.000000 max: 5.000000  min: 1.000000 avg per stage time: 4.500000 avg round time: 3.000000"
    )
    assert long[1, "communication"].startswith("communication times total: 0.000000 max: 0.000000  min: 0.000000 avg")
    # one interval is not more than two that are skipped
    short = lines_of(tagged, 2)
    assert set(short) == set(long)
    assert short[1, "forward"] == "forward times total: 5.000000 max: 5.000000  min: 5.000000 "
    assert lines_of(tagged, 3) == {}


def test_interval_table(tagged):
    rows = sorted(tuple(r) for r in timing.interval_table(timing.phase_pivot(tagged)).collect())
    assert rows == [
        (1, 0, "iteration|iteration time|forward time|backward time|optimize time|communication time"),
        (1, 1, "1|5.000000|4.000000|2.000000|0.000000|0.000000"),
        (1, 2, "2|3.000000|5.000000|0.000000|0.000000|0.000000"),
    ]


def test_durations_use_the_latest_start(spark):
    marks = spark.createDataFrame(
        [(1, "forward", 10, 1, "start"), (1, "forward", 25, 2, "start"), (1, "forward", 30, 3, "end"),
         (1, "backward", 5, 4, "start"), (1, "backward", 6, 5, "end"), (2, "forward", 1, 6, "end")],
        "run int, phase string, us bigint, event_id int, edge string",
    )
    got = {r["event_id"]: r["duration"] for r in timing.phase_durations(marks).collect()}
    assert got == {3: 5e-6, 5: 1e-6, 6: None}


def test_epoch_durations(spark):
    log = log_frame(spark, [(1, 0, "forward", 0), (1, 4, "tick", 0), (1, 6, "forward", 0), (1, 9.5, "tick", 0)])
    epochs = timing.epoch_durations(log.selectExpr("*", "cast(event_id div 2 as int) AS epoch"))
    assert sorted(tuple(r) for r in epochs.collect()) == [(1, 0, 4.0, 4.0, 9.5), (1, 1, 3.5, 9.5, 9.5)]


def test_micros_do_not_depend_on_the_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30, 0, 123456),)], "ts timestamp_ntz")
    want = 1710037800123456
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(timing.micros("ts")).first()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
