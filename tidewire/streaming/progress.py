"""A table of how each batch of the streaming queries went."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidewire.session import names_in, write_once

PROGRESS = StructType([
    StructField("query_id", StringType(), True),
    StructField("run_id", StringType(), True),
    StructField("batch_id", LongType(), True),
    StructField("at", StringType(), True),
    StructField("row_count", LongType(), True),
    StructField("rows_per_second", DoubleType(), True),
    StructField("state_rows", LongType(), True),
    StructField("state_bytes", LongType(), True),
    StructField("dropped_late", LongType(), True),
])


class ProgressTable(StreamingQueryListener):
    """Stores one row for each batch of every query while it is registered.

    ``row_count`` is what was read from the sources, ``state_rows`` and ``state_bytes`` what the
    stateful operators hold after the batch, ``dropped_late`` the rows that they left out because of
    the watermark; an aggregate counts these after its partial aggregation. The rows come from
    Spark's own reports, so no batch is read for them. Each has a small file of its own, written
    on the driver. A batch that is tried again after a restart is reported by its last try only.

    Spark does not let a listener stop a query: what goes wrong here is kept and raised by
    ``settle``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.errors: list[Exception] = []
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        told = event.progress
        states = told.stateOperators
        row = {
            "query_id": str(told.id), "run_id": str(told.runId), "batch_id": told.batchId,
            "at": told.timestamp, "row_count": told.numInputRows,
            "rows_per_second": told.processedRowsPerSecond,
            "state_rows": sum(state.numRowsTotal for state in states),
            "state_bytes": sum(state.memoryUsedBytes for state in states),
            "dropped_late": sum(state.numRowsDroppedByWatermark for state in states)}
        try:
            write_once(self.spark, f"{self.path}/rows/{told.runId}-{told.batchId}.json",
                       json.dumps(row))
        except Exception as error:  # the listener's thread would only log it
            self.errors.append(error)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def settle(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until a query that has ended is reported in full; reports come with some delay."""
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no report of the end of {query.runId}")
        if self.errors:
            raise self.errors[0]

    def read(self) -> DataFrame:
        """All batches so far, each by its last try."""
        if not names_in(self.spark, f"{self.path}/rows"):
            return self.spark.createDataFrame([], PROGRESS)
        rows = self.spark.read.schema(PROGRESS).json(f"{self.path}/rows")
        names = PROGRESS.fieldNames()
        last = rows.groupBy("query_id", "batch_id").agg(
            F.max_by(F.struct(*names), F.struct("at", "run_id")).alias("last"))
        return last.select(*[F.col(f"last.{name}").alias(name) for name in names])

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
