"""Skipping messages that are already there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire import fixed_values as fixed
from tidewire.operators.recent import cutoff
from tidewire.session import MAX_BROADCAST_ROWS


def one_per_id(df: DataFrame, id: str, order: str | None = None) -> DataFrame:
    """One row per id: the first by ``order``, or any of identical copies.

    Copies collapse in the map tasks before the shuffle, so a much-repeated id costs no more than
    others. Rows without an id are no copies of one another: each has a key of its own, and all
    are kept.
    """
    own = F.when(F.col(id).isNull(), F.monotonically_increasing_id())
    keyed = df.withColumn("_own_key", own)
    if order is None:
        return keyed.dropDuplicates([id, "_own_key"]).drop("_own_key")
    rest = [F.col(name) for name in df.columns if name != id]
    first = keyed.groupBy(id, "_own_key").agg(
        F.min_by(F.struct(*rest), F.col(order)).alias("_first"))
    return first.select(*[F.col(id) if name == id else F.col(f"_first.{name}").alias(name)
                          for name in df.columns])


def known_ids(target: DataFrame, id: str) -> DataFrame:
    """Distinct ids; the shuffle of the distinct also serves the join that follows."""
    return target.select(id).filter(F.col(id).isNotNull()).distinct()


def dedup_new(incoming: DataFrame, target: DataFrame, id: str = "event_id",
              order: str | None = None) -> DataFrame:
    """Incoming rows whose id is not stored yet, one per id."""
    return one_per_id(incoming, id, order).join(known_ids(target, id), id, "left_anti").select(
        *incoming.columns)


def retain_latest(incoming: DataFrame, target: DataFrame | None = None,
                  n: int = fixed.RETAINED_MESSAGES, *, ts: str = "ts",
                  id: str = "event_id") -> DataFrame:
    """The n newest distinct messages among stored and incoming ones.

    Sketches of the ids per hour, which need no shuffle of ids, give a time by which n distinct
    ones should be reached. An exact count confirms it when this is called; if it falls short, all
    times are searched, and where there are no more than n, all are kept without a ranking. The n
    ids are then found on (id, time) alone, and whole rows fetched last.
    """
    everything = incoming if target is None else target.unionByName(incoming)
    # messages are told apart by id: one without is none of the distinct ones and takes no place
    everything = everything.filter(F.col(id).isNotNull())
    keys = everything.select(id, ts)
    guess = cutoff(keys, 2 * n, ts, "1 hour", F.approx_count_distinct(id))
    if guess is not None:
        near = keys.filter(F.col(ts) >= guess.start)
        if near.agg(F.count_distinct(id)).first()[0] >= n:
            keys, everything = near, everything.filter(F.col(ts) >= guess.start)
    elif keys.agg(F.count_distinct(id)).first()[0] <= n:
        # all of them stay, so none has to be ranked, which would take a single task
        return one_per_id(everything, id)
    stamped = keys.groupBy(id).agg(F.max(ts).alias(ts))
    newest = stamped.orderBy(F.col(ts).desc_nulls_last(), F.col(id).desc_nulls_last()).limit(n)
    chosen = newest.select(id)
    rows = everything.join(F.broadcast(chosen) if n <= MAX_BROADCAST_ROWS else chosen, id,
                           "left_semi")
    return one_per_id(rows, id).select(*everything.columns)
