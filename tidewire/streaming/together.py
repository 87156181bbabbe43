"""Several sinks of one stream whose batches become visible together."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidewire.session import folder_exists, names_in, remove_folder, write_once
from tidewire.sources.sinks import query_id, read_batches

Sinks = Mapping[str, Callable[[DataFrame], DataFrame]]

MANIFEST = StructType([
    StructField("query_id", StringType(), True),
    StructField("batch_id", LongType(), True),
    StructField("attempt", StringType(), True),
])


class Together:
    """A writer that makes a batch of several sinks from one computation and shows all at once.

    Each attempt at a batch writes every sink's rows to folders of its own, which no reader looks
    at. When all are written, one manifest is put in place; readers follow manifests, so they see
    a batch in every sink or in none. A batch that has its manifest is not written again when it is
    replayed, and folders of attempts that failed go once a later one is through. A sink is a
    function of the batch; one without rows for a batch is simply empty there.
    """

    def __init__(self, path: str, sinks: Sinks):
        if not sinks:
            raise ValueError("no sinks")
        self.path, self.sinks = path.rstrip("/"), dict(sinks)

    def _folder(self, sink: str, own: str, batch_id: int) -> str:
        return f"{self.path}/sinks/{sink}/query_id={own}/batch_id={batch_id}"

    def _store(self, sink: str, rows: DataFrame, folder: str) -> None:
        rows.write.mode("overwrite").parquet(folder)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own, attempt = query_id(spark) or "none", uuid.uuid4().hex
        manifest = f"{self.path}/manifests/{own}-{batch_id}.json"
        if folder_exists(spark, manifest):
            return
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink, of in self.sinks.items():
                self._store(sink, of(batch),
                            f"{self._folder(sink, own, batch_id)}/attempt={attempt}")
        finally:
            batch.unpersist()
        write_once(spark, manifest, json.dumps(
            {"query_id": own, "batch_id": batch_id, "attempt": attempt}))
        for sink in self.sinks:
            folder = self._folder(sink, own, batch_id)
            for name in names_in(spark, folder):
                if name != f"attempt={attempt}":
                    remove_folder(spark, f"{folder}/{name}")

    def published(self, spark: SparkSession) -> DataFrame:
        """(query, batch, attempt) of the batches that are there as of now."""
        if not names_in(spark, f"{self.path}/manifests"):
            return spark.createDataFrame([], MANIFEST)
        return spark.read.schema(MANIFEST).json(f"{self.path}/manifests")

    def read(self, spark: SparkSession, schemas: Mapping[str, StructType]) -> dict[str, DataFrame]:
        """Sinks by name, all as of one moment: manifests are listed once, for all of them."""
        published = self.published(spark)
        keys = published.columns
        return {
            sink: read_batches(spark, f"{self.path}/sinks/{sink}",
                               StructType([*schema.fields, *MANIFEST.fields]))
            .join(published, keys, "left_semi").select(*schema.fieldNames())
            for sink, schema in schemas.items()}
