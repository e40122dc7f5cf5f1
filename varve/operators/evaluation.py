"""Accuracy and loss of scored test rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.functions.classify import argmax, cross_entropy
from varve.functions.exact import exact_mean

# Fixed layout of the test report.
TEST_REPORT = "Test set: Average loss: %.4f, Accuracy: %d/%d (%.0f%%)\n"


def judged(scored: DataFrame) -> DataFrame:
    """Scored rows with ``predicted``, ``correct`` (0/1) and ``loss``."""
    predicted = argmax(F.col("scores"))
    return scored.select(
        *[c for c in scored.columns if c != "scores"],
        predicted.alias("predicted"),
        (predicted == F.col("label")).cast("bigint").alias("correct"),
        cross_entropy(F.col("scores"), F.col("label")).alias("loss"),
    )


def evaluate(scored: DataFrame, exact: bool = False) -> DataFrame:
    """One row: correct, total, accuracy in percent, mean loss over rows; an ``exact`` mean is the same for any order of rows."""
    mean = exact_mean(F.col("loss")) if exact else F.avg("loss")
    return judged(scored).agg(
        F.sum("correct").alias("correct"),
        F.count(F.lit(1)).alias("total"),
        (F.sum("correct") * 100.0 / F.count(F.lit(1))).alias("accuracy"),
        mean.alias("loss"),
    )


def evaluate_batches(scored: DataFrame, exact: bool = False) -> DataFrame:
    """Like :func:`evaluate`, but the loss is the mean of batch means; needs ``batch``."""
    mean = exact_mean(F.col("loss")) if exact else F.avg("loss")
    per_batch = judged(scored).groupBy("batch").agg(
        F.sum("correct").alias("correct"),
        F.count(F.lit(1)).alias("total"),
        mean.alias("loss"),
    )
    return per_batch.agg(
        F.sum("correct").alias("correct"),
        F.sum("total").alias("total"),
        (F.sum("correct") * 100.0 / F.sum("total")).alias("accuracy"),
        mean.alias("loss"),
    )


def test_report(evaluated: DataFrame) -> DataFrame:
    return evaluated.select(
        F.format_string(TEST_REPORT, F.col("loss"), F.col("correct"), F.col("total"), F.col("accuracy")).alias("line")
    )
