"""The newest distinct messages, kept up to date batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidewire import fixed_values as fixed
from tidewire.operators.dedup import retain_latest
from tidewire.session import remove_folder
from tidewire.sources.sinks import BatchFolders, query_id, read_batches


class NewestSet:
    """A writer that keeps the ``n`` newest distinct messages of all batches so far.

    After each batch the set is that of the set before and of the batch: an id that comes again with
    a later time moves up and takes one place only, and what falls out of the newest ``n`` can only
    come back in a later batch. So a batch costs its own rows and ``n`` more, whatever is stored.
    Each batch's set has a folder of its own, overwritten on replay from the set before it; the
    last ``keep`` sets stay. Rows without an id are no distinct message and are left out.
    """

    def __init__(self, path: str, schema: StructType, n: int = fixed.RETAINED_MESSAGES, *,
                 ts: str = "ts", id: str = "event_id", keep: int = 3):
        if keep < 2:
            raise ValueError("a replayed batch needs the set before it")
        self.folders, self.schema, self.n = BatchFolders(path), schema, n
        self.ts, self.id, self.keep = ts, id, keep

    def _stored(self, spark: SparkSession) -> DataFrame:
        return read_batches(spark, self.folders.path, StructType([
            *self.schema.fields, StructField("query_id", StringType(), True),
            StructField("batch_id", LongType(), True)]))

    def _sets(self, stored: DataFrame) -> list[tuple[str, int]]:
        """(query, batch) of the sets that are kept: a few a query."""
        return sorted((query, batch) for query, batch in
                      stored.select("query_id", "batch_id").distinct().collect())

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored, own = self._stored(spark), query_id(spark) or "none"
        earlier = [number for query, number in self._sets(stored)
                   if query == own and number < batch_id]
        before = None
        if earlier:
            before = stored.filter((F.col("query_id") == own) & (F.col("batch_id") == earlier[-1])
                                   ).select(*self.schema.fieldNames())
        newest = retain_latest(batch.select(*self.schema.fieldNames()), before, self.n, ts=self.ts,
                               id=self.id)
        self.folders(newest, batch_id)
        for number in earlier[:-(self.keep - 1)]:
            remove_folder(spark, f"{self.folders.path}/query_id={own}/batch_id={number}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest distinct messages of all queries that write here."""
        stored = self._stored(spark)
        last = dict(self._sets(stored))
        if not last:
            return stored.select(*self.schema.fieldNames())
        chosen = F.lit(False)
        for query, number in last.items():
            chosen = chosen | ((F.col("query_id") == query) & (F.col("batch_id") == number))
        kept = stored.filter(chosen).select(*self.schema.fieldNames())
        return kept if len(last) == 1 else retain_latest(kept, n=self.n, ts=self.ts, id=self.id)
