"""Starting streaming queries. Errors are never swallowed: a failed batch stops its query."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidewire import fixed_values as fixed
from tidewire.operators.dedup import dedup_new
from tidewire.sources.sinks import (
    BATCH_METRICS,
    BatchFolders,
    BatchWriter,
    query_id,
    read_batches,
)
from tidewire.streaming.seen import SeenIds

log = logging.getLogger("tidewire")


def _writer(df: DataFrame, checkpoint: str, name: str | None, trigger: Mapping | None, mode: str):
    if not checkpoint:
        raise ValueError("every query needs a checkpoint folder of its own")
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger) if trigger else writer


def append_to(df: DataFrame, checkpoint: str, *, format: str = "parquet", path: str | None = None,
              options: Mapping[str, str] | None = None, name: str | None = None,
              trigger: Mapping | None = None) -> StreamingQuery:
    """Append a stream to a store by its format and options.

    Files are the default and are exactly-once; ``console`` shows values in full.
    """
    chosen = dict(options or {})
    if format == "console":
        chosen.setdefault("truncate", "false")
    if path:
        chosen["path"] = path
    return _writer(df, checkpoint, name, trigger, "append").format(format).options(
        **chosen).start()


def for_each_batch(df: DataFrame, write: BatchWriter, checkpoint: str, *, name: str | None = None,
                   trigger: Mapping | None = None, mode: str = "append") -> StreamingQuery:
    """Hand every batch that holds rows to a writer. Executors write; nothing is collected."""
    def save(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write(batch, batch_id)

    return _writer(df, checkpoint, name, trigger, mode).foreachBatch(save).start()


def fan_out(df: DataFrame, writers: Sequence[BatchWriter], checkpoint: str, *,
            name: str | None = None, trigger: Mapping | None = None) -> StreamingQuery:
    """Several sinks from one query: each batch is read and computed once."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for write in writers:
                write(batch, batch_id)
        finally:
            batch.unpersist()

    return for_each_batch(df, save, checkpoint, name=name, trigger=trigger)


class Watched:
    """A writer that also logs the row count and a few rows of each batch.

    The count is observed while the batch is written and the sample is read from what was written,
    so the batch is computed once. A writer without batch folders has its sample taken from the
    batch, of which a few rows are computed again. ``metrics`` keeps one row per batch.
    """

    def __init__(self, write: BatchWriter, metrics: BatchFolders | None = None,
                 sample: int = fixed.SAMPLE_ROWS):
        self.write, self.metrics, self.sample = write, metrics, sample

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = Observation(f"batch_{batch_id}")
        self.write(batch.observe(seen, F.count(F.lit(1)).alias("row_count")), batch_id)
        rows = seen.get["row_count"]
        log.info("batch %s: %s rows", batch_id, rows)
        if self.sample and log.isEnabledFor(logging.INFO):
            written = batch
            if hasattr(self.write, "folder"):
                written = spark.read.format(self.write.format).load(
                    self.write.folder(spark, batch_id))
            for row in written.limit(self.sample).collect():
                log.info("batch %s: %s", batch_id, row)
        if self.metrics:
            self.metrics(spark.createDataFrame([(batch_id, rows)], BATCH_METRICS), batch_id)


class NewOnly:
    """A writer that leaves out messages whose id is already in its folders, and copies.

    A replayed batch does not take its own earlier attempt for stored messages. With an ``index``
    only the ids that it names are read, and the batch's own are added to it. Without, all stored
    ids are read for each batch; ``horizon`` limits that to messages no older than the batch's
    oldest by more than this interval, for stores whose copies come within it.
    """

    def __init__(self, write: BatchFolders, schema: StructType, id: str = "event_id", *,
                 ts: str | None = None, horizon: str | None = None, index: SeenIds | None = None):
        if horizon and not ts:
            raise ValueError("a horizon needs the name of the time column")
        if index is not None and index.id != id:
            raise ValueError("the index is kept by another id")
        self.write, self.schema, self.id, self.ts, self.horizon = write, schema, id, ts, horizon
        self.index = index

    def _stored(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        everything = read_batches(spark, self.write.path, StructType([
            *self.schema.fields,
            StructField("query_id", StringType(), True),
            StructField("batch_id", LongType(), True),
        ]), self.write.format)
        own = ((F.col("query_id") == F.lit(query_id(spark) or "none"))
               & (F.col("batch_id") == batch_id))
        stored = everything.filter(~own)
        if self.horizon:
            oldest = batch.agg(F.min(self.ts) - F.expr(f"interval {self.horizon}")).scalar()
            stored = stored.filter(F.col(self.ts) >= oldest)
        return stored

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.index is None:
            self.write(dedup_new(batch, self._stored(batch, batch_id), self.id), batch_id)
            return
        spark = batch.sparkSession
        segment = f"{query_id(spark) or 'none'}-{batch_id}"
        self.write(dedup_new(batch, self.index.seen(batch, but=segment), self.id), batch_id)
        # from what is written, so that both hold the same ids
        written = spark.read.schema(self.schema).format(self.write.format).load(
            self.write.folder(spark, batch_id))
        self.index.add(written, segment)


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query; raises what stopped it."""
    query.awaitTermination()
    return query
