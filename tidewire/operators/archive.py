"""Moving live messages to the archive."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators.dedup import known_ids
from tidewire.session import ensure_checkpoint_dir
from tidewire.sources.sinks import only_own_partitions


class ArchiveMove(NamedTuple):
    moved: DataFrame
    remaining: DataFrame


def fix_snapshot(live: DataFrame, id: str = "event_id") -> DataFrame:
    """The ids that are live now, written down so that later arrivals do not join them."""
    ensure_checkpoint_dir(live.sparkSession)
    return known_ids(live, id).checkpoint()


def archive_move(live: DataFrame, archived: DataFrame, snapshot: DataFrame,
                 id: str = "event_id") -> ArchiveMove:
    """Rows to append to the archive and rows that stay live, for a fixed snapshot of ids.

    Only snapshot ids move and only those not archived yet, so messages that arrive meanwhile stay
    and a rerun with the same snapshot moves nothing twice. Which ids move is decided on ids alone
    and written down first; the rows then meet them in a single join, in which AQE can split an id
    that has a great many copies.
    """
    ensure_checkpoint_dir(live.sparkSession)
    chosen = known_ids(snapshot, id).checkpoint()
    moving = chosen.join(known_ids(archived, id), id, "left_anti").checkpoint()
    return ArchiveMove(
        moved=live.join(moving, id, "left_semi").select(*live.columns),
        remaining=live.join(chosen, id, "left_anti").select(*live.columns),
    )


def live_batches(spark: SparkSession, table: str, batch: str = "batch_id",
                 query: str = "query_id") -> list[tuple[str, int]]:
    """(query, batch) of the partitions of a live table, from the catalog alone."""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        values = dict(part.split("=", 1) for part in row["partition"].split("/"))
        found.append((values[query], int(values[batch])))
    return sorted(found)


def archive_batches(spark: SparkSession, live: str, archive: str, snapshot: list | None = None,
                    batch: str = "batch_id", query: str = "query_id") -> list[tuple[str, int]]:
    """Move whole batches between two tables partitioned by query and batch; returns those moved.

    The copy overwrites its own partitions of the archive and the drop names its partitions, so
    neither needs a join or a rewrite of the rest, batches written meanwhile stay live, and a run
    that stopped half-way can be repeated. Batches of one number from two queries are two.
    """
    batches = live_batches(spark, live, batch, query)
    if snapshot is not None:
        batches = sorted({tuple(one) for one in snapshot} & set(batches))
    if not batches:
        return []
    numbers: dict[str, list[int]] = {}
    for name, number in batches:
        numbers.setdefault(name, []).append(number)
    chosen = F.lit(False)
    for name, own in numbers.items():
        chosen = chosen | ((F.col(query) == name) & F.col(batch).isin(own))
    columns = spark.table(archive).columns
    moving = spark.table(live).filter(chosen).select(*columns)
    with only_own_partitions(spark):
        moving.write.insertInto(archive, overwrite=True)
    dropped = ", ".join(f"PARTITION ({query} = '{name}', {batch} = {number})"
                        for name, number in batches)
    spark.sql(f"ALTER TABLE {live} DROP IF EXISTS {dropped}")
    return batches
