"""Message sources: a broker topic, or files with the same contract (a ``value`` column)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class KafkaTopic:
    """One topic. ``options`` are passed on, such as ``maxOffsetsPerTrigger`` or ``minPartitions``
    (the latter splits a partition that holds most of the messages over several tasks)."""

    servers: str
    topic: str
    starting: str = "latest"
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.starting not in ("latest", "earliest"):
            raise ValueError(f"unknown start position {self.starting!r}")

    def reader_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting,
            **self.options,
        }


@dataclass(frozen=True)
class LineFiles:
    """Text files with one JSON message per line."""

    path: str
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class TableFiles:
    """Columnar files whose rows become the messages."""

    path: str
    schema: StructType
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)


#: Where a message came from, as text: the same however often it is read, and different for two
#: messages of equal content. Ids of one partition or file sort in the order of arrival.
MESSAGE_ID = "message_id"


def topic_position() -> Column:
    """Topic, partition and offset of a broker's message as one text."""
    return F.concat_ws("/", "topic", F.lpad(F.col("partition").cast("string"), 10, "0"),
                       F.lpad(F.col("offset").cast("string"), 20, "0")).alias(MESSAGE_ID)


def _file_position(row: Column) -> Column:
    return F.concat(F.col("_metadata.file_path"), F.lit(":"),
                    F.lpad(row.cast("string"), 12, "0")).alias(MESSAGE_ID)


def _lines(stream: DataFrame) -> DataFrame:
    """The lines of whole files with their place; a line end at the end of a file ends no other."""
    text = F.regexp_replace("value", r"(\r\n|\r|\n)\z", "")
    lines = stream.filter("value != ''").select(
        F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("_line", "_text"), "_metadata")
    return lines.select(_file_position(F.col("_line")),
                        F.col("_text").cast("binary").alias("value"))


def read_messages(spark: SparkSession, source: KafkaTopic | LineFiles, *,
                  position: bool = False) -> DataFrame:
    """An unbounded frame with the payload as binary ``value``.

    ``position`` adds ``message_id``, a durable identity of each message from its place in the
    source: topic, partition and offset, or file and line. To number lines alike however files are
    split, a file is then read whole, so files should stay below some 100 MB each.
    """
    if isinstance(source, KafkaTopic):
        stream = spark.readStream.format("kafka").options(**source.reader_options()).load()
        return stream.select(*[topic_position()] * position, "value")
    reader = spark.readStream.options(**source.options)
    if position:
        return _lines(reader.text(source.path, wholetext=True))
    return reader.text(source.path).select(F.col("value").cast("binary").alias("value"))


def read_table_stream(spark: SparkSession, source: TableFiles, *,
                      position: bool = False) -> DataFrame:
    """An unbounded frame with the columns of the files; ``position`` adds ``message_id`` from the
    file and the row in it, which Parquet files know."""
    stream = (spark.readStream.schema(source.schema).format(source.format)
              .options(**source.options).load(source.path))
    if not position:
        return stream
    return stream.select(_file_position(F.col("_metadata.row_index")), "*")


def carried(messages: DataFrame) -> list[str]:
    """The identity of messages, where they have one, for passing it on."""
    return [MESSAGE_ID] if MESSAGE_ID in messages.columns else []


def decode(messages: DataFrame, into: str = "json") -> DataFrame:
    """Payload bytes to text, beside the messages' identity."""
    return messages.select(*carried(messages), F.col("value").cast("string").alias(into))


def read_collection(spark: SparkSession, path: str | None = None, format: str = "parquet",
                    schema: StructType | None = None, **options: str) -> DataFrame:
    """A stored collection: files by default, a document store by its format and options."""
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()
