"""Counts kept batch by batch and added up when they are read: late messages add, none is dropped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewire.operators.series import time_bucket
from tidewire.sources.sinks import BatchFolders, read_batches


class PartialCounts:
    """A writer that stores each batch's messages counted per time bucket and key.

    A batch has a folder of its own, named after query and batch and overwritten when it is
    replayed, so a message counts once however often its batch is tried. No state is kept between
    batches and there is no watermark: a message of any age adds to its bucket. Rows without a time
    count in a bucket without a start.
    """

    def __init__(self, folders: BatchFolders, keys: Mapping[str, Column], *, ts: str = "ts",
                 width: str = "1 minute"):
        self.folders, self.keys, self.ts, self.width = folders, dict(keys), ts, width

    def counted(self, batch: DataFrame) -> DataFrame:
        return batch.groupBy(time_bucket(batch, self.ts, self.width).alias("bucket_start"),
                             *[column.alias(name) for name, column in self.keys.items()]).agg(
            F.count(F.lit(1)).alias("n"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.folders(self.counted(batch), batch_id)


def merged_counts(spark: SparkSession, folders: BatchFolders, schema: StructType) -> DataFrame:
    """The counts of all batches so far: bucket_start, the keys, n. ``schema`` is that of a batch's
    messages under ``PartialCounts.counted``. Partial counts combine in the map tasks."""
    stored = read_batches(spark, folders.path, schema, folders.format)
    keys = [name for name in schema.fieldNames() if name != "n"]
    return stored.groupBy(*keys).agg(F.sum("n").alias("n"))


def coarser(counts: DataFrame, width: str, ts: str = "bucket_start") -> DataFrame:
    """Counts per wider bucket, whose width is a multiple of the one they were kept at."""
    keys = [name for name in counts.columns if name not in (ts, "n")]
    return counts.groupBy(time_bucket(counts, ts, width).alias(ts), *keys).agg(
        F.sum("n").alias("n"))


def as_series(counts: DataFrame, series: str) -> DataFrame:
    """Merged counts in the form that histories, alerts and forecasts take."""
    return counts.select(F.col(series).alias("series"), "bucket_start", "n")


def compact(spark: SparkSession, folders: BatchFolders, into: BatchFolders, schema: StructType,
            batches: Sequence[int], batch_id: int) -> None:
    """Write the counts of some batches of a query, added up, as one batch of another store, from
    which they can be read in their place. Repeating it overwrites the same folder."""
    own = StructType([*schema.fields, StructField("batch_id", LongType(), True)])
    stored = read_batches(spark, folders.path, own, folders.format).filter(
        F.col("batch_id").isin(list(batches)))
    keys = [name for name in schema.fieldNames() if name != "n"]
    into(stored.groupBy(*keys).agg(F.sum("n").alias("n")), batch_id)
