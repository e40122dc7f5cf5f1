"""A keyed permutation of positions, so that an epoch's shuffle costs no sort.

Positions 0 to ``n - 1`` are written in two digits of about the root of ``n`` each. Rounds add to one digit a keyed function of the other, which can be undone, so
together they permute all two-digit numbers; a number beyond the last position is permuted again until it lies within
(cycle walking). There are fewer such numbers than the root of ``n``, so their ways are worked out once, in Spark, by following all at the same
time twice as far each round, and joined as a small table.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.session import written

#: Modulus of the keyed function; products of two remainders fit 63 bits.
PRIME = 2**31 - 1
ROUNDS = 6
#: Beyond this the digits wouldn't fit the modulus.
MAX_POSITIONS = 2**61


@dataclass(frozen=True)
class Permutation:
    """The permutation of ``n`` positions under ``key``."""

    n: int
    key: str

    def __post_init__(self):
        if not 0 <= self.n <= MAX_POSITIONS:
            raise ValueError(f"{self.n} positions")

    @property
    def digits(self) -> tuple[int, int]:
        """How many values the high and the low digit have."""
        high = math.isqrt(max(self.n, 1) - 1) + 1 if self.n > 1 else 1
        return high, -(-max(self.n, 1) // high)

    def factors(self, number: int) -> tuple[int, int, int]:
        """The keyed function's three coefficients in round ``number``."""
        drawn = hashlib.sha256(f"{self.key}:{number}".encode()).digest()
        return tuple(int.from_bytes(drawn[8 * i : 8 * i + 8], "big") % (PRIME - 1) + 1 for i in range(3))

    def once(self, position: Column) -> Column:
        """Where the rounds take a number; it may lie beyond the last position."""
        high, low = self.digits
        # a struct of both digits, bound by a lambda in each round, keeps the expression small
        pair = F.array(F.struct(F.floor(position / low).cast("bigint").alias("a"), (position % low).cast("bigint").alias("b")))
        for number in range(ROUNDS):
            pair = F.transform(pair, self._round(number, high, low))
        return F.get(F.transform(pair, lambda p: p["a"] * low + p["b"]), 0)

    def _round(self, number: int, high: int, low: int):
        x, y, z = (F.lit(c).cast("bigint") for c in self.factors(number))

        def mixed(digit: Column) -> Column:
            # a cubic modulo the prime, in Horner's form
            t = digit % PRIME
            return (((t * x + y) % PRIME * t + z) % PRIME * ((t + x) % PRIME)) % PRIME

        def step(p: Column) -> Column:
            if number % 2:
                return F.struct(p["a"].alias("a"), ((p["b"] + mixed(p["a"])) % low).alias("b"))
            return F.struct(((p["a"] + mixed(p["b"])) % high).alias("a"), p["b"].alias("b"))

        return step

    def outside(self, spark: SparkSession) -> DataFrame:
        """(beyond, within): where a number from ``n`` on ends when it is permuted until it is a position."""
        high, low = self.digits if self.n else (0, 0)
        beyond = spark.range(self.n, high * low).select(F.col("id").alias("beyond"))
        ways = written(beyond.withColumn("within", self.once(F.col("beyond"))), "ways")
        while ways.where(F.col("within") >= self.n).limit(1).count():
            ahead = F.broadcast(ways.select(F.col("beyond").alias("_at"), F.col("within").alias("_on")))  # below the root of n
            followed = ways.join(ahead, ways.within == F.col("_at"), "left")
            ways = written(followed.select("beyond", F.coalesce("_on", "within").alias("within")), "ways")
        return ways

    def of(self, rows: DataFrame, position: str, name: str) -> DataFrame:
        """``rows`` with ``name``, the permuted ``position``; no row moves."""
        placed = rows.withColumn(name, self.once(F.col(position)))
        ways = F.broadcast(self.outside(rows.sparkSession).withColumnRenamed("beyond", name))
        return placed.join(ways, name, "left").select(
            *[c for c in rows.columns if c != name], F.coalesce("within", name).alias(name)
        )
