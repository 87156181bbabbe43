"""Writers: payload encoding, replay-safe batch sinks, document stores, console."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

BatchWriter = Callable[[DataFrame, int], None]


def encode_json(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows to JSON payload bytes, the form a broker takes."""
    fields = list(columns) if columns is not None else df.columns
    payload = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(payload.cast("binary").alias("value"))


#: Bytes of a line file. Files are read whole where messages take their ids from their lines.
LINE_FILE_BYTES = 8 << 20


def write_lines(payloads: DataFrame, path: str, least: int = 1,
                file_bytes: int = LINE_FILE_BYTES) -> int:
    """Payloads (``value``) as lines, dealt over files of about ``file_bytes`` each, ``least`` at
    least; returns how many. The number of files follows the input, their size does not."""
    lines = payloads.select(F.col("value").cast("string").alias("value"))
    size = lines.agg(F.sum(F.octet_length("value").cast("long") + 1)).first()[0] or 0
    files = max(least, -(-size // file_bytes))
    lines.repartition(files).write.text(path)
    return files


def send(df: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Write encoded rows to a broker topic."""
    (df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
     .options(**options).save())


def document_store(uri: str, database: str, collection: str, key: str) -> dict[str, str]:
    """Options of the public document store connector for an upsert on ``key``.

    A replayed batch replaces its own documents instead of adding them again.
    """
    return {
        "connection.uri": uri,
        "database": database,
        "collection": collection,
        "operationType": "replace",
        "idFieldList": key,
        "upsertDocument": "true",
    }


def query_id(spark: SparkSession) -> str | None:
    """Id of the streaming query whose batch is being written; it lives as long as its checkpoint.
    """
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


@dataclass(frozen=True)
class BatchFolders:
    """Each batch in a folder of its own, overwritten when the batch is replayed.

    Batch numbers start again with a new checkpoint, so the folder is named after the query too.
    """

    path: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def folder(self, spark: SparkSession, batch_id: int) -> str:
        return f"{self.path}/query_id={query_id(spark) or 'none'}/batch_id={batch_id}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").format(self.format).options(**self.options)
         .save(self.folder(batch.sparkSession, batch_id)))


@contextmanager
def only_own_partitions(spark: SparkSession) -> Iterator[None]:
    """Within this, overwriting a catalog table replaces just the partitions that are written.

    ``insertInto`` takes this from the session only; as a writer option it is ignored.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@dataclass(frozen=True)
class BatchTable:
    """Batches as partitions of a catalog table; the form ``archive_batches`` moves.

    Batch numbers start again with a new checkpoint, so a partition is named after the query too.
    """

    table: str
    batch: str = "batch_id"
    query: str = "query_id"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stamped = batch.withColumns({
            self.query: F.lit(query_id(spark) or "none"),
            self.batch: F.lit(batch_id).cast("bigint")})
        if spark.catalog.tableExists(self.table):
            with only_own_partitions(spark):
                stamped.select(*spark.table(self.table).columns).write.insertInto(
                    self.table, overwrite=True)
        else:
            stamped.write.partitionBy(self.query, self.batch).saveAsTable(self.table)


@dataclass(frozen=True)
class StoreWriter:
    """Batches to a connector, for instance a document store."""

    format: str
    options: Mapping[str, str]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.format(self.format).mode("append").options(**self.options).save()


@dataclass(frozen=True)
class ConsoleWriter:
    """Batches to the console, values in full."""

    rows: int = 20

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(self.rows, truncate=False)


BATCH_METRICS = StructType([
    StructField("batch_id", LongType(), False),
    StructField("row_count", LongType(), False),
])


def read_batches(spark: SparkSession, path: str, schema: StructType,
                 format: str = "parquet") -> DataFrame:
    """All batches of ``BatchFolders`` as one table; empty if no batch held rows."""
    try:
        stored = spark.read.schema(schema).format(format).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return stored.select(*schema.fieldNames())
