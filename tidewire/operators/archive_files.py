"""Moving messages by id between two folders of Parquet files."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewire.operators.dedup import known_ids
from tidewire.session import (
    folder_exists,
    folder_path,
    move_file,
    names_in,
    remove_folder,
    write_once,
)

# the folder of rows whose files lie in no folder below the root
_ROOT = "."


def _free(name: str, taken: list[str]) -> str:
    lowered = {other.lower() for other in taken}
    while name.lower() in lowered:
        name = f"_{name}"
    return name


def _path_of_file():
    """Path of a row's file, without scheme and host."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^[A-Za-z0-9+.-]+:(//[^/]*)?", "")


def _fix_ids(ids: DataFrame, archived: DataFrame | None, work: str, id: str, fresh: str) -> None:
    chosen = known_ids(ids, id)
    if archived is None:
        marked = chosen.withColumn(fresh, F.lit(True))
    else:
        marked = chosen.join(known_ids(archived, id).withColumn(fresh, F.lit(False)), id, "left")
        marked = marked.withColumn(fresh, F.coalesce(F.col(fresh), F.lit(True)))
    marked.write.mode("overwrite").parquet(f"{work}/ids")


def _find_files(spark: SparkSession, live: str, work: str, schema: StructType, id: str) -> None:
    """Write down the files that hold chosen ids, from the id column within their range alone."""
    chosen = spark.read.parquet(f"{work}/ids").select(id)
    low, high = chosen.agg(F.min(id), F.max(id)).first()
    # folders by any name, whose values need not be columns
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(live)
    within = F.lit(False) if low is None else F.col(id).between(low, high)
    path = _free("path", [id])
    found = rows.filter(within).select(id, _path_of_file().alias(path))
    (found.join(chosen, id, "left_semi").select(path).distinct()
     .write.mode("overwrite").parquet(f"{work}/files"))


def _files(spark: SparkSession, work: str) -> list[str]:
    return sorted(path for path, in spark.read.parquet(f"{work}/files").collect())


def _stage(spark: SparkSession, live: str, work: str, schema: StructType, id: str,
           fresh: str) -> None:
    """Rows of the files found, split into those that move and those that stay, by one join."""
    root, paths = folder_path(spark, live), _files(spark, work)
    if not paths:
        return
    names = schema.fieldNames()
    moves, folder = _free("moves", names), _free("folder", names)
    below = F.regexp_extract(_path_of_file().substr(F.lit(len(root) + 2), F.lit(1 << 30)),
                             "^(.*)/[^/]*$", 1)
    # a list of files is split by the scan as any folder is
    rows = spark.read.schema(schema).parquet(*[_address(live, root, path) for path in paths])
    rows = rows.select(*names, F.when(below == "", _ROOT).otherwise(below).alias(folder))
    marked = rows.join(spark.read.parquet(f"{work}/ids"), id, "left")
    # a row whose id the archive holds already leaves without a second copy
    staged = marked.filter(F.col(fresh).isNull() | F.col(fresh)).select(
        *names, F.col(fresh).isNotNull().alias(moves), folder)
    # files of a good size; AQE splits a folder that is large and joins small ones
    (staged.hint("rebalance", F.col(moves), F.col(folder))
     .write.mode("overwrite").partitionBy(moves, folder).parquet(f"{work}/staged"))


def _address(live: str, root: str, path: str) -> str:
    """A file's path as Spark reads it, in the form in which the folder was given."""
    return f"{live}{unquote(path[len(root):])}"


def _publish(spark: SparkSession, live: str, archive: str, work: str) -> list[str]:
    """Archive rows first, then those that stay, then the old files go: no row is ever missing."""
    for split in names_in(spark, f"{work}/staged"):
        if "=" not in split:
            continue
        target = archive if split.endswith("=true") else live
        for name in names_in(spark, f"{work}/staged/{split}"):
            # encoded once as part of a file's address and once as a partition value
            below = unquote(unquote(name.split("=", 1)[1]))
            into = target if below == _ROOT else f"{target}/{below}"
            for file in names_in(spark, f"{work}/staged/{split}/{name}"):
                move_file(spark, f"{work}/staged/{split}/{name}/{file}", into)
    root = folder_path(spark, live)
    touched = [_address(live, root, path) for path in _files(spark, work)]
    for path in touched:
        remove_folder(spark, path)
    return touched


def archive_by_file(spark: SparkSession, live: str, archive: str, ids: DataFrame,
                    schema: StructType, run: str, *, id: str = "event_id",
                    archived: DataFrame | None = None) -> list[str]:
    """Move the rows of some ids from one folder of files to another; returns the files rewritten.

    ``schema`` holds the columns of the files; folders below (by query and batch, for instance) stay
    as they are, on both sides, so the archive is laid out as the live folder is. Files without a chosen id are neither read beyond their id column
    nor touched. The others are read once more: one join marks their rows, which are written as
    new files. With ``archived``, rows of ids that it holds leave the live folder without
    being stored again. Rows without an id stay. All copies of an id move.

    ``run`` names the move. Its ids and files are written down before anything changes, and a file
    goes only after its rows are in place, so a move that stopped anywhere is finished by calling it
    again, with what was chosen first; a finished one does nothing. Until then readers may see a row
    on both sides, but none is missing. Two moves of one folder must not run at a time, and files
    that a batch may still overwrite are not to be moved. The driver holds the names of the files
    that are rewritten, as it does when Spark lists them.
    """
    live, archive = live.rstrip("/"), archive.rstrip("/")
    work, fresh = f"{live}/_moves/{run}", _free("fresh", schema.fieldNames())
    if folder_exists(spark, f"{work}/done"):
        return []
    for step, write in (
            ("ids", lambda: _fix_ids(ids, archived, work, id, fresh)),
            ("files", lambda: _find_files(spark, live, work, schema, id)),
            ("staged", lambda: _stage(spark, live, work, schema, id, fresh))):
        if not folder_exists(spark, f"{work}/{step}/_SUCCESS"):
            write()
    touched = _publish(spark, live, archive, work)
    write_once(spark, f"{work}/done", str(len(touched)))
    for step in ("ids", "files", "staged"):
        remove_folder(spark, f"{work}/{step}")
    return touched
