"""Counts, shares and rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire import fixed_values as fixed
from tidewire.operators.series import time_bucket

TOPICS = (fixed.UNEMPLOYMENT, fixed.ANXIETY, fixed.ECONOMY)
SENTIMENTS = (fixed.POSITIVE, fixed.NEGATIVE, fixed.NEUTRAL)


def total_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def topic_counts(df: DataFrame, topics: Sequence[str] = TOPICS, topic: str = "topic") -> DataFrame:
    """One row with a count per topic, in one pass."""
    return df.agg(*[F.count_if(F.col(topic) == name).alias(name.lower()) for name in topics])


def positivity(positive: Column, total: Column) -> Column:
    """Share of positive messages in percent, 0 without messages."""
    return F.when(total > 0, F.lit(100.0) * positive / total).otherwise(F.lit(0.0))


def kpi_summary(df: DataFrame, sentiment: str = "sentiment") -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(sentiment) == name).alias(f"{name}_count") for name in SENTIMENTS],
    )
    index = positivity(F.col("positive_count"), F.col("total"))
    return counts.withColumn("positivity_index", F.round(index, 1))


def rate_per_window(df: DataFrame, ts: str = "ts", width: str = "1 minute") -> DataFrame:
    """Messages per tumbling window that holds any; those without a time in one without a start."""
    return df.groupBy(time_bucket(df, ts, width).alias("window_start")).agg(
        F.count(F.lit(1)).alias("n"))


def peak_rate(df: DataFrame, ts: str = "ts", width: str = "1 minute") -> DataFrame:
    """The highest rate and the first window that reached it."""
    rates = rate_per_window(df.filter(F.col(ts).isNotNull()), ts, width)
    return rates.agg(
        F.max("n").alias("peak_n"),
        F.min_by("window_start", F.struct(-F.col("n"), F.col("window_start"))).alias("peak_start"),
    )


def distribution(df: DataFrame, column: str = "sentiment") -> DataFrame:
    """Count and share per value of a column with a fixed set of labels."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    # the window sees one row per label
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def cross_distribution(df: DataFrame, first: str = "category",
                       second: str = "sentiment") -> DataFrame:
    return df.groupBy(first, second).agg(F.count(F.lit(1)).alias("n"))


def pivot_distribution(df: DataFrame, group: str = "city", column: str = "sentiment",
                       values: Sequence[str] = SENTIMENTS) -> DataFrame:
    """One row per group with a count for each fixed label."""
    return df.groupBy(group).agg(
        *[F.count_if(F.col(column) == value).alias(value) for value in values])
