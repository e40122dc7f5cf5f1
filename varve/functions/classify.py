"""Per-row classifier expressions over an array of class scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax(scores: Column) -> Column:
    """0-based class of the largest score, the first one on a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def cross_entropy(scores: Column, label: Column) -> Column:
    """-log softmax(scores)[label], shifted by the largest score."""
    top = F.array_max(scores)
    mass = F.aggregate(scores, F.lit(0.0), lambda total, s: total + F.exp(s - top))
    return top + F.log(mass) - F.get(scores, label)
