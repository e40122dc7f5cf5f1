"""Analytics over phase-timing logs.

A log has one row per finished phase, ``(run, ts, event_id, phase, duration)``,
and rows of phase ``tick`` that close an interval. A run's first row is its
start; the first tick closes interval 0. Phases are tagged with the interval in
which they ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varve.operators.blocks import Running, in_blocks, running

# The phases in report order, the tick mark, the warm-up, and the
# layouts of the report lines.
PHASES = ("forward", "backward", "optimize", "communication")
TICK = "tick"
SKIP_INTERVALS = 1
SHORT_LINE = "%s times total: %f max: %f  min: %f "
LONG_LINE = "%s times total: %f max: %f  min: %f avg per stage time: %f avg round time: %f"
INTERVAL_LINE = "iteration times total: %f max: %f  min: %f average:%f"
AVERAGE_LINE = "iteration average time: %f"
TABLE_HEADER = "iteration|iteration time|" + "|".join(f"{p} time" for p in PHASES)
TABLE_LINE = "%d|%f|%f|%f|%f|%f"


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone."""
    return F.expr(
        f"unix_date(to_date({ts})) * 86400000000 + hour({ts}) * 3600000000L + minute({ts}) * 60000000L"
        f" + cast(extract(SECOND FROM {ts}) * 1000000 AS bigint)"
    )


def phase_durations(marks: DataFrame) -> DataFrame:
    """Durations from ``(run, phase, us, event_id, edge)`` with edges 'start' and 'end', ``us`` in microseconds.

    Each end is measured from the latest start of its phase before it; of one event, the start comes first
    even when both fall on the same microsecond.
    """
    started = running(
        in_blocks(marks.withColumn("_ends", F.col("edge") == "end"), ["run", "phase", "us", "event_id", "_ends"]),
        ["run", "phase"],
        [Running("started", "max", F.when(F.col("edge") == "start", F.col("us")), before=True)],
    )
    return started.where("edge = 'end'").select(
        "run", "phase", "event_id", "us", ((F.col("us") - F.col("started")) / 1e6).alias("duration")
    )


def tagged_log(log: DataFrame) -> DataFrame:
    """The log with ``iteration``, and on tick rows the microseconds ``took`` of the interval they close."""
    is_tick = F.col("phase") == TICK
    at = F.col("us")
    tagged = running(
        in_blocks(log.withColumn("us", micros("ts")), ["run", "us", "event_id"]),
        ["run"],
        [
            Running("ticks", "sum", is_tick.cast("bigint")),
            Running("last_tick", "max", F.when(is_tick, at), before=True),
            Running("run_start", "min", at),
        ],
    )
    iteration = F.col("ticks") - is_tick.cast("bigint")
    took = F.when(is_tick, at - F.coalesce("last_tick", "run_start"))
    return tagged.select(
        "run", "ts", "event_id", "phase", "duration", iteration.alias("iteration"), took.alias("took")
    )


def iteration_intervals(tagged: DataFrame, skip: int = SKIP_INTERVALS) -> DataFrame:
    """Closed intervals after the warm-up."""
    return tagged.where((F.col("phase") == TICK) & (F.col("iteration") >= skip)).select(
        "run", "iteration", (F.col("took") / 1e6).alias("seconds")
    )


def iteration_summary(tagged: DataFrame, skip: int = SKIP_INTERVALS) -> DataFrame:
    """Per run: total, longest, shortest and mean interval after the warm-up.

    The mean is 0 unless more than ``skip`` intervals are left; runs with none
    left are not reported.
    """
    kept = tagged.where((F.col("phase") == TICK) & (F.col("iteration") >= skip))
    count = F.count(F.lit(1))
    # whole microseconds add up exactly, whatever the order
    total = F.sum("took")
    return kept.groupBy("run").agg(
        count.alias("intervals"),
        (total / 1e6).alias("total"),
        (F.max("took") / 1e6).alias("longest"),
        (F.min("took") / 1e6).alias("shortest"),
        F.when(count > skip, total / count / 1e6).otherwise(0.0).alias("average"),
    )


def phase_pivot(tagged: DataFrame, skip: int = SKIP_INTERVALS) -> DataFrame:
    """Interval report: its seconds and the summed time of every phase in it."""
    kept = tagged.where(F.col("iteration") >= skip)
    spent = [
        F.coalesce(F.sum(F.when(F.col("phase") == p, F.col("duration"))), F.lit(0.0)).alias(p) for p in PHASES
    ]
    report = kept.groupBy("run", "iteration").agg((F.max("took") / 1e6).alias("seconds"), *spent)
    return report.where(F.col("seconds").isNotNull())


def phase_summary(tagged: DataFrame, skip: int = SKIP_INTERVALS) -> DataFrame:
    """Per run and phase: total, max, min, mean per call, mean of the non-zero interval sums.

    All four phases are listed for every run; unused ones are 0.
    """
    counted = F.when((F.col("iteration") >= skip) & F.col("phase").isin(*PHASES), F.col("duration"))
    per_interval = tagged.groupBy("run", "iteration", "phase").agg(
        F.sum(counted).alias("spent"),
        F.max(counted).alias("longest"),
        F.min(counted).alias("shortest"),
        F.count(counted).alias("calls"),
    )

    def stats(phase: str) -> Column:
        def mine(column: str) -> Column:
            return F.when(F.col("phase") == phase, F.col(column))

        spent = mine("spent")
        calls = F.sum(mine("calls"))
        return F.struct(
            F.lit(phase).alias("phase"),
            F.coalesce(F.sum(spent), F.lit(0.0)).alias("total"),
            F.coalesce(F.max(mine("longest")), F.lit(0.0)).alias("longest"),
            F.coalesce(F.min(mine("shortest")), F.lit(0.0)).alias("shortest"),
            F.coalesce(F.sum(spent) / F.nullif(calls, F.lit(0)), F.lit(0.0)).alias("average_call"),
            F.coalesce(F.avg(F.when(spent > 0, spent)), F.lit(0.0)).alias("average_interval"),
        )

    wide = per_interval.groupBy("run").agg(F.array(*[stats(p) for p in PHASES]).alias("stats"))
    return wide.select("run", F.inline("stats"))


def phase_lines(summary: DataFrame, intervals: DataFrame, skip: int = SKIP_INTERVALS) -> DataFrame:
    """One text line per run and phase, as the run's intervals after the warm-up allow.

    ``intervals`` is :func:`iteration_summary`. A run prints long lines if it has more than ``skip`` of them, short
    lines if it has any, and none otherwise.
    """
    columns = [F.col(c) for c in ("phase", "total", "longest", "shortest", "average_interval", "average_call")]
    line = F.when(F.col("intervals") > skip, F.format_string(LONG_LINE, *columns)).otherwise(
        F.format_string(SHORT_LINE, *columns[:4])
    )
    return summary.join(intervals.select("run", "intervals"), "run").select("run", "phase", line.alias("line"))


def interval_lines(intervals: DataFrame) -> DataFrame:
    """The two lines of each run's interval report; ``intervals`` is :func:`iteration_summary`."""
    figures = F.format_string(INTERVAL_LINE, "total", "longest", "shortest", "average")
    lines = F.array(figures, F.format_string(AVERAGE_LINE, "average"))
    return intervals.select("run", F.posexplode(lines).alias("number", "line"))


def interval_table(pivot: DataFrame, skip: int = SKIP_INTERVALS) -> DataFrame:
    """The interval report as text: (run, number, line) with a header, number 0, and one line per interval of :func:`phase_pivot`."""
    line = F.format_string(TABLE_LINE, "iteration", "seconds", *PHASES)
    lines = pivot.select("run", (F.col("iteration") - skip + 1).cast("bigint").alias("number"), line.alias("line"))
    header = pivot.select("run").distinct().select("run", F.lit(0).cast("bigint").alias("number"), F.lit(TABLE_HEADER).alias("line"))
    return header.unionByName(lines)


def epoch_durations(log: DataFrame) -> DataFrame:
    """Per run and epoch: its own seconds, and the seconds from the run's start to its end."""
    log = log.withColumn("us", micros("ts"))
    # one row per run and epoch; a run's first and last row follow from those
    epochs = log.groupBy("run", "epoch").agg(F.min("us").alias("first"), F.max("us").alias("last"))
    runs = epochs.groupBy("run").agg(F.min("first").alias("begin"), F.max("last").alias("finish"))
    return epochs.join(runs, "run").select(
        "run",
        "epoch",
        ((F.col("last") - F.col("first")) / 1e6).alias("epoch_seconds"),
        ((F.col("last") - F.col("begin")) / 1e6).alias("since_start"),
        ((F.col("finish") - F.col("begin")) / 1e6).alias("run_seconds"),
    )
