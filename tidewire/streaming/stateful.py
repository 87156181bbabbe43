"""Stream operators that keep state between batches, bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def topic_windows(df: DataFrame, topic: Column, *, ts: str = "ts", width: str = "1 hour",
                  delay: str = "10 minutes") -> DataFrame:
    """Messages per window and topic; a window comes out once the watermark has passed its end.

    Counts are combined in the map tasks, so a crowded topic is not a hot spot, and the state is one
    row per open window and topic.
    """
    return (
        df.select(F.col(ts), topic.alias("topic"))
        .withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("window"), "topic")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"), "topic", "n")
    )


def dedup_stream(df: DataFrame, id: str = "event_id", *, ts: str = "ts",
                 delay: str = "10 minutes", spread: int = 16) -> DataFrame:
    """One row per id among those that arrive within ``delay`` of event time.

    A stream has no map-side combine for this, so copies are first thinned out in ``spread`` groups
    by the partition that read them: of an id sent over and over, at most that many rows reach the
    task that owns it. ``spread=1`` skips that step. Copies later than the delay pass again;
    ``dedup_new`` against the stored table catches them. Rows without an id are copies of nothing:
    each has a key of its own, kept as long as others, and all pass.
    """
    own = F.when(F.col(id).isNull(), F.uuid())
    marked = df.withWatermark(ts, delay).withColumn("_own_key", own)
    if spread > 1:
        marked = marked.withColumn("_group", F.spark_partition_id() % spread)
        marked = marked.dropDuplicatesWithinWatermark([id, "_own_key", "_group"]).drop("_group")
    return marked.dropDuplicatesWithinWatermark([id, "_own_key"]).drop("_own_key")
