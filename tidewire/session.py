"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

# A lookup handed over as Python rows is counted before it is broadcast.
MAX_BROADCAST_ROWS = 100_000

# Settings that hold at any size. Shuffle width is left to the cluster: AQE coalesces it down and
# splits skewed join partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  **extra: str) -> SparkSession:
    """A one-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidewire")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach: ``spark.checkpoint.dir``, or a folder beside the
    warehouse where it is not set."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        # the warehouse is shared on a cluster
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return shared.rstrip("/")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name for one run, under the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable where the session did not name a folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_folder(spark, "checkpoints"))


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """A lookup held in the program as a local relation, whose exact size the optimizer knows.

    It is marked for broadcast while its row count allows that, and joined by shuffle beyond.
    """
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrow = pa.table({field.name: pa.array(list(values), to_arrow_type(field.dataType))
                      for field, values in zip(schema.fields, columns)})
    table = spark.createDataFrame(arrow, schema)
    return F.broadcast(table) if len(rows) <= MAX_BROADCAST_ROWS else table


def _file_system(spark: SparkSession, path: str):
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    return held.getFileSystem(spark._jsc.hadoopConfiguration()), held


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store Spark reads it from."""
    files, held = _file_system(spark, path)
    return files.exists(held)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote and no longer needs."""
    files, held = _file_system(spark, path)
    files.delete(held, True)


def folder_path(spark: SparkSession, path: str) -> str:
    """The path of a folder without scheme and host, encoded as in ``_metadata.file_path``."""
    files, held = _file_system(spark, path)
    return files.makeQualified(held).toUri().getRawPath().rstrip("/")


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    files, held = _file_system(spark, path)
    if not files.exists(held):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(held))


def move_file(spark: SparkSession, path: str, into: str) -> None:
    """Move one file into a folder of the same store, which is made where it is missing."""
    files, held = _file_system(spark, path)
    files.mkdirs(_file_system(spark, into)[1])
    target = _file_system(spark, f"{into}/{held.getName()}")[1]
    if not files.rename(held, target):
        raise OSError(f"could not move {path} to {target}")


def publish_folder(spark: SparkSession, draft: str, path: str) -> None:
    """Give a finished folder its name, by which readers see it whole or not at all.

    Where another run was first, its folder stays and the draft is removed.
    """
    files, held = _file_system(spark, draft)
    target = _file_system(spark, path)[1]
    files.mkdirs(target.getParent())
    if files.exists(target):
        files.delete(held, True)
    elif not files.rename(held, target):
        raise OSError(f"could not move {draft} to {path}")


def write_once(spark: SparkSession, path: str, line: str) -> None:
    """A small file that readers see whole or not at all: written beside its place, then renamed."""
    files, held = _file_system(spark, path)
    draft = _file_system(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")[1]
    out = files.create(draft)
    try:
        out.write(bytearray(f"{line}\n", "utf-8"))
    finally:
        out.close()
    if not files.rename(draft, held):
        raise OSError(f"could not write {path}")
