"""Ordered blocks: running totals, neighbours and positions without giant groups.

A window over a group that holds a third of the table would sort that third in one task. Here rows first
go through one range exchange on their whole keys, are sorted within it, and are written with their partition's number (the
block) and their place in it. A large group spans several blocks; what the earlier (or later) blocks add to a
block is a carry of at most two rows per block.

Once written, a row's block is data: any task can be run again and gets the same rows. The keys must
identify a row, or rows that tie may swap places.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varve.session import shuffle_partitions, written

BLOCK = "_block"
PLACE = "_place"
# Spark's increasing ids: the partition above, the row's place in it below this bit
_PLACE_BITS = 33


@dataclass(frozen=True)
class Blocked:
    """Written rows with ``_block`` and ``_place``; blocks are contiguous along ``keys``, places along each block."""

    rows: DataFrame
    keys: tuple[str, ...]
    blocks: int

    @cached_property
    def total(self) -> int:
        return self.rows.count()

    def placed(self) -> DataFrame:
        """One block per partition."""
        return self.rows.repartitionById(self.blocks, BLOCK)


@dataclass(frozen=True)
class Running:
    """A running aggregate; ``before`` leaves the current row out."""

    name: str
    how: str  # "sum", "max" or "min"
    column: Column
    before: bool = False

    def over(self, column: Column) -> Column:
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.how](column)

    def merge(self, local: Column, carry: Column) -> Column:
        if self.how == "sum":
            return F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
        return (F.greatest if self.how == "max" else F.least)(local, carry)


def in_blocks(df: DataFrame, keys: Sequence[str], *, blocks: int | None = None) -> Blocked:
    """Rows in ``blocks`` ordered blocks along ``keys`` (ascending, nulls first); the session's shuffle width by default."""
    wanted = blocks or shuffle_partitions(df.sparkSession)
    return as_blocks(df.repartitionByRange(wanted, *keys).sortWithinPartitions(*keys), keys, wanted)


def as_blocks(ordered: DataFrame, keys: Sequence[str] = (), blocks: int | None = None) -> Blocked:
    """An ordered frame's own partitions as blocks, written once."""
    tagged = ordered.withColumn(PLACE, F.monotonically_increasing_id()).select(
        *ordered.columns,
        F.shiftright(PLACE, _PLACE_BITS).cast("int").alias(BLOCK),
        F.col(PLACE).bitwiseAND((1 << _PLACE_BITS) - 1).alias(PLACE),
    )
    return Blocked(written(tagged, "blocks"), tuple(keys), blocks or shuffle_partitions(ordered.sparkSession))


def running(blocked: Blocked, group: Sequence[str], measures: Sequence[Running]) -> DataFrame:
    """Running aggregates per ``group`` along the block keys.

    ``group`` must be a leading part of the keys (or empty for the whole table).
    """
    _check_group(blocked, group)
    within = Window.partitionBy(BLOCK, *group).orderBy(PLACE)
    rows = blocked.placed().select(
        "*",
        *[
            m.over(m.column)
            .over(within.rowsBetween(Window.unboundedPreceding, -1 if m.before else 0))
            .alias(m.name)
            for m in measures
        ],
    )
    kept = [c for c in rows.columns if c not in (BLOCK, PLACE) and c not in {m.name for m in measures}]
    totals = (
        _at_borders(blocked, group).groupBy(BLOCK, *group).agg(*[m.over(m.column).alias(m.name) for m in measures])
    )
    # at most two rows per block, whatever the table's size
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(BLOCK, *group, *[m.over(F.col(m.name)).over(earlier).alias(m.name) for m in measures])
    joined = rows.alias("r").join(F.broadcast(carry.alias("c")), _same(BLOCK, *group), "left")
    return joined.select(
        *[F.col(f"r.{c}") for c in kept],
        *[m.merge(F.col(f"r.{m.name}"), F.col(f"c.{m.name}")).alias(m.name) for m in measures],
    )


def _at_borders(blocked: Blocked, group: Sequence[str]) -> DataFrame:
    """Rows of the first and the last group of each block, the only ones that can go on in another block."""
    if not group:
        return blocked.rows
    key = F.struct(*group)
    ends = blocked.rows.groupBy(BLOCK).agg(
        F.array_distinct(F.array(F.min_by(key, PLACE), F.max_by(key, PLACE))).alias("_ends")
    )
    ends = ends.select(BLOCK, F.inline("_ends"))
    return blocked.rows.alias("r").join(F.broadcast(ends.alias("c")), _same(BLOCK, *group), "left_semi")


def _same(*names: str) -> Column:
    match = F.lit(True)
    for name in names:
        match &= F.col(f"r.{name}").eqNullSafe(F.col(f"c.{name}"))
    return match


def _check_group(blocked: Blocked, group: Sequence[str]) -> None:
    if tuple(group) != blocked.keys[: len(group)]:
        raise ValueError(f"group {list(group)} must lead the block keys {list(blocked.keys)}")


def next_value(blocked: Blocked, group: Sequence[str], column: str, name: str) -> DataFrame:
    """``column`` of the following row of the group; null on its last row."""
    _check_group(blocked, group)
    within = Window.partitionBy(BLOCK, *group).orderBy(PLACE)
    value = F.struct(F.col(column).alias("_value"))
    rows = blocked.placed().withColumn("_ahead", F.lead(value).over(within))
    kept = [c for c in rows.columns if c not in (BLOCK, PLACE, "_ahead")]
    # a group goes on, if at all, in the first row of the next block: one row per block
    heads = blocked.rows.where(F.col(PLACE) == 0).select(BLOCK, F.struct(*group, value.alias("_ahead")).alias("_head"))
    carry = heads.select(
        F.lag(BLOCK).over(Window.orderBy(BLOCK)).alias(BLOCK), *[F.col(f"_head.{c}") for c in (*group, "_ahead")]
    )
    joined = rows.alias("r").join(F.broadcast(carry.alias("c")), _same(BLOCK, *group), "left")
    found = F.coalesce(F.col("r._ahead"), F.col("c._ahead"))
    return joined.select(*[F.col(f"r.{c}") for c in kept], found["_value"].alias(name))


def positions(blocked: Blocked, name: str = "position") -> DataFrame:
    """Every row with its 0-based position: the block's offset and the place in it, so no exchange of rows."""
    sizes = blocked.rows.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(BLOCK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    kept = [c for c in blocked.rows.columns if c not in (BLOCK, PLACE, name)]
    return blocked.rows.join(F.broadcast(offsets), BLOCK).select(
        *kept, (F.col("_offset") + F.col(PLACE)).alias(name)
    )


def global_position(df: DataFrame, keys: Sequence[str], *, name: str = "position") -> DataFrame:
    """0-based position of every row in the order of ``keys``."""
    return positions(in_blocks(df, keys), name)
