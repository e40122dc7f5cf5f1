"""Phase-timing queries, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from varve.operators import timing
from varve.workloads import inputs as I


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _tagged(spark, sf_dir):
    return timing.tagged_log(I.phase_log(spark, sf_dir))


def phase_durations(spark, sf_dir):
    log = I.phase_log(spark, sf_dir).where(F.col("phase") != timing.TICK)
    at = timing.micros("ts")
    # every tenth phase ends in the microsecond it starts
    length = F.when(F.col("event_id") % 10 == 0, 0).otherwise(F.round(F.col("duration") * 1000000)).cast("bigint")
    marks = log.select(
        "run",
        "phase",
        "event_id",
        F.inline(
            F.array(
                F.struct(at.alias("us"), F.lit("start").alias("edge")),
                F.struct((at + length).alias("us"), F.lit("end").alias("edge")),
            )
        ),
    )
    return _rounded(timing.phase_durations(marks), "duration")


def iteration_intervals(spark, sf_dir):
    return timing.iteration_intervals(_tagged(spark, sf_dir))


def iteration_summary(spark, sf_dir):
    return timing.iteration_summary(_tagged(spark, sf_dir))


def phase_pivot(spark, sf_dir):
    return _rounded(timing.phase_pivot(_tagged(spark, sf_dir)), *timing.PHASES)


def phase_summary(spark, sf_dir):
    summary = timing.phase_summary(_tagged(spark, sf_dir))
    return _rounded(summary, "total", "longest", "shortest", "average_call", "average_interval")


def phase_report(spark, sf_dir):
    tagged = _tagged(spark, sf_dir)
    summary = _rounded(timing.phase_summary(tagged), "total", "average_call", "average_interval")
    return timing.phase_lines(summary, timing.iteration_summary(tagged))


def interval_report(spark, sf_dir):
    return timing.interval_lines(_rounded(timing.iteration_summary(_tagged(spark, sf_dir)), "average"))


def interval_table(spark, sf_dir):
    return timing.interval_table(phase_pivot(spark, sf_dir))


def epoch_duration(spark, sf_dir):
    log = I.phase_log(spark, sf_dir).withColumn("epoch", F.expr("unix_date(to_date(ts)) - 19723"))
    return _rounded(timing.epoch_durations(log), "epoch_seconds", "since_start", "run_seconds")


QUERIES = {
    f.__name__: f
    for f in (
        phase_durations,
        iteration_intervals,
        iteration_summary,
        phase_pivot,
        phase_summary,
        phase_report,
        interval_report,
        interval_table,
        epoch_duration,
    )
}

PHASES = ("forward", "backward", "optimize", "communication")
_SPENT = ", ".join(
    f"round(coalesce(sum(CASE WHEN phase = '{p}' THEN duration END), 0.0::DOUBLE), 6) AS {p}" for p in PHASES
)
_SUMMARY = f"""
kept AS (SELECT * FROM tagged WHERE iteration >= 1 AND phase <> 'tick'),
sums AS (SELECT run, phase, iteration, sum(duration) AS spent FROM kept GROUP BY ALL),
by_call AS (SELECT run, phase, sum(duration) AS total, max(duration) AS longest, min(duration) AS shortest,
  avg(duration) AS average_call FROM kept GROUP BY ALL),
by_interval AS (SELECT run, phase, avg(spent) AS average_interval FROM sums WHERE spent > 0 GROUP BY ALL),
listed AS (SELECT run, phase FROM (SELECT DISTINCT run FROM tagged),
  (VALUES {", ".join(f"('{p}')" for p in PHASES)}) v(phase)),
summary AS (
  SELECT run, phase, round(coalesce(total, 0), 6) AS total, round(coalesce(longest, 0), 6) AS longest,
    round(coalesce(shortest, 0), 6) AS shortest, round(coalesce(average_call, 0), 6) AS average_call,
    round(coalesce(average_interval, 0), 6) AS average_interval
  FROM listed LEFT JOIN by_call USING (run, phase) LEFT JOIN by_interval USING (run, phase))"""

ORACLES = {
    "phase_durations": f"""WITH {I.PHASE_LOG_SQL},
marks AS (
  SELECT run, phase, event_id, us, 'start' AS edge FROM log WHERE phase <> 'tick'
  UNION ALL SELECT run, phase, event_id, us + CASE WHEN event_id % 10 = 0 THEN 0 ELSE CAST(round(duration * 1000000) AS BIGINT) END, 'end' FROM log WHERE phase <> 'tick'),
seen AS (
  SELECT *, max(CASE WHEN edge = 'start' THEN us END) OVER (PARTITION BY run, phase ORDER BY us, event_id, edge DESC
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS started FROM marks)
SELECT run, phase, event_id, us, round((us - started) / 1e6::DOUBLE, 6) AS duration FROM seen WHERE edge = 'end'""",
    "iteration_intervals": f"""WITH {I.TAGGED_SQL}
SELECT run, iteration, took / 1e6::DOUBLE AS seconds FROM tagged WHERE phase = 'tick' AND iteration >= 1""",
    "iteration_summary": f"""WITH {I.TAGGED_SQL}
SELECT run, count(*) AS intervals, CAST(sum(took) AS BIGINT) / 1e6::DOUBLE AS total, max(took) / 1e6::DOUBLE AS longest,
  min(took) / 1e6::DOUBLE AS shortest,
  CASE WHEN count(*) > 1 THEN CAST(sum(took) AS DOUBLE) / count(*) / 1e6::DOUBLE ELSE 0.0::DOUBLE END AS average
FROM tagged WHERE phase = 'tick' AND iteration >= 1 GROUP BY run""",
    "phase_pivot": f"""WITH {I.TAGGED_SQL}
SELECT run, iteration, max(took) / 1e6::DOUBLE AS seconds, {_SPENT} FROM tagged
WHERE iteration >= 1 GROUP BY run, iteration HAVING max(took) IS NOT NULL""",
    "phase_summary": f"WITH {I.TAGGED_SQL}, {_SUMMARY} SELECT * FROM summary",
    "phase_report": f"""WITH {I.TAGGED_SQL}, {_SUMMARY},
intervals AS (SELECT run, count(*) AS n FROM tagged WHERE phase = 'tick' AND iteration >= 1 GROUP BY run)
SELECT run, phase, CASE WHEN n > 1 THEN printf('%s times total: %f max: %f  min: %f avg per stage time: %f avg round time: %f',
  phase, total, longest, shortest, average_interval, average_call)
  ELSE printf('%s times total: %f max: %f  min: %f ', phase, total, longest, shortest) END AS line
FROM summary JOIN intervals USING (run)""",
    "interval_report": f"""WITH {I.TAGGED_SQL},
took AS (SELECT run, count(*) AS n, CAST(sum(took) AS BIGINT) / 1e6::DOUBLE AS total, max(took) / 1e6::DOUBLE AS longest,
  min(took) / 1e6::DOUBLE AS shortest, round(CAST(sum(took) AS DOUBLE) / count(*) / 1e6::DOUBLE, 6) AS mean
  FROM tagged WHERE phase = 'tick' AND iteration >= 1 GROUP BY run)
SELECT run, 0 AS number, printf('iteration times total: %f max: %f  min: %f average:%f',
  total, longest, shortest, CASE WHEN n > 1 THEN mean ELSE 0 END) AS line FROM took
UNION ALL SELECT run, 1, printf('iteration average time: %f', CASE WHEN n > 1 THEN mean ELSE 0 END) FROM took""",
    "interval_table": f"""WITH {I.TAGGED_SQL},
spent AS (SELECT run, iteration, max(took) / 1e6::DOUBLE AS seconds, {_SPENT} FROM tagged
  WHERE iteration >= 1 GROUP BY run, iteration HAVING max(took) IS NOT NULL)
SELECT DISTINCT run, CAST(0 AS BIGINT) AS number,
  'iteration|iteration time|forward time|backward time|optimize time|communication time' AS line FROM spent
UNION ALL SELECT run, iteration, printf('%d|%f|%f|%f|%f|%f', iteration, seconds, forward, backward, optimize, communication) FROM spent""",
    "epoch_duration": f"""WITH {I.PHASE_LOG_SQL},
epochs AS (SELECT run, CAST(ts AS DATE) - DATE '2024-01-01' AS epoch, min(us) AS opened, max(us) AS closed FROM log GROUP BY ALL),
runs AS (SELECT run, min(opened) AS begin_at, max(closed) AS finish FROM epochs GROUP BY run)
SELECT run, CAST(epoch AS INTEGER) AS epoch, round((closed - opened) / 1e6::DOUBLE, 6) AS epoch_seconds,
  round((closed - begin_at) / 1e6::DOUBLE, 6) AS since_start, round((finish - begin_at) / 1e6::DOUBLE, 6) AS run_seconds
FROM epochs JOIN runs USING (run)""",
}
