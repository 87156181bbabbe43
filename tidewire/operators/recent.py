"""Newest-first working sets."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire import fixed_values as fixed

# Rows of a working set that are sorted without cutting it any finer.
REFINE_ABOVE = 1_000_000


# Groups in which a crowded instant is ranked before the groups' winners meet.
RANKING_GROUPS = 4096


class Cutoff(NamedTuple):
    start: Column
    reached: int


def _as_value(column: str, kind: str) -> Column:
    """A time in a form that comes back from the driver unchanged, whatever its time zone."""
    return F.col(column).cast("string") if kind == "timestamp_ntz" else F.unix_micros(column)


def _as_literal(value, kind: str) -> Column:
    if kind == "timestamp_ntz":
        return F.lit(value).cast(kind)
    return F.timestamp_micros(F.lit(value))


def cutoff(df: DataFrame, n: int, ts: str, width: str, size: Column | None = None,
           ) -> Cutoff | None:
    """Start of the time bucket by which ``n`` rows (or units of ``size``) are reached, counted
    from the newest, and how many they are; None if there are not as many with a time.

    Reads the time column only and returns one row to the driver, so that all that is built on it
    carries a plain literal to the scan.
    """
    kind = dict(df.dtypes)[ts]
    counts = df.groupBy(F.window(ts, width)["start"].alias("_start")).agg(
        (F.count(F.lit(1)) if size is None else size).alias("_n"))
    # one row per bucket of the time span, whatever the number of messages
    running = F.sum("_n").over(Window.orderBy(F.col("_start").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    enough = counts.select("_start", running.alias("_newer")).filter(F.col("_newer") >= n)
    found = enough.agg(F.max("_start").alias("_start"), F.min("_newer").alias("_newer"))
    start, reached = found.select(_as_value("_start", kind), "_newer").first()
    return None if start is None else Cutoff(_as_literal(start, kind), reached)


def _from_nth(df: DataFrame, n: int, ts: str, id: str) -> DataFrame:
    """Rows down to the n-th newest, found by ranking (time, id) alone in groups of ids."""
    kind = dict(df.dtypes)[ts]
    order = [F.col(ts).desc(), F.col(id).desc()]
    group = F.pmod(F.xxhash64(id), F.lit(RANKING_GROUPS))
    ranked = df.filter(F.col(ts).isNotNull()).select(ts, id).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    newest = ranked.filter(F.col("_rank") <= n).orderBy(*order).limit(n)
    # the smallest pair, an id that is null before all others, as in the order above
    last = newest.agg(F.min(F.struct(ts, id)).alias("_last")).select("_last.*")
    when, which = last.select(_as_value(ts, kind), id).first()
    at = _as_literal(when, kind)
    # rows without an id come last in their instant: the n-th may be one of them
    same = F.lit(True) if which is None else F.col(id) >= F.lit(which)
    return df.filter((F.col(ts) > at) | ((F.col(ts) == at) & same))


def since_newest(df: DataFrame, n: int, ts: str = "ts", id: str = "event_id",
                 widths: Sequence[str] = ("1 hour", "1 second"),
                 refine_above: int = REFINE_ABOVE) -> DataFrame:
    """Rows that may be among the n newest, cut by time; ids are unique.

    The cutoff goes to the scan as a filter, so the wide columns of older files are never read.
    Where a crowded bucket still leaves more than ``refine_above`` rows, narrower buckets follow,
    and in the end an exact cut.
    """
    for width in widths:
        found = cutoff(df.select(ts), n, ts, width)
        if found is None:
            return df
        df = df.filter(F.col(ts) >= found.start)
        if found.reached <= max(refine_above, n):
            return df
    return _from_nth(df, n, ts, id)


def newest_first(df: DataFrame, n: int, *, ts: str | None = "ts",
                 id: str = "event_id") -> DataFrame:
    """The n newest rows, newest first; ties in time go to the larger id.

    ``ts=None`` orders by the id alone.
    """
    order = ([F.col(ts).desc_nulls_last()] if ts else []) + [F.col(id).desc_nulls_last()]
    return df.orderBy(*order).limit(n)


def latest_n(df: DataFrame, n: int = fixed.NEWEST_MESSAGES, *, ts: str | None = "ts",
             id: str = "event_id") -> DataFrame:
    """The n newest rows of a large table, newest first. Looks up the cutoff when called."""
    return newest_first(since_newest(df, n, ts, id) if ts else df, n, ts=ts, id=id)


def oldest_first(df: DataFrame, *, ts: str | None = "ts", id: str = "event_id") -> DataFrame:
    """A working set in order of arrival."""
    return df.orderBy(*([F.col(ts).asc_nulls_first()] if ts else []), F.col(id).asc_nulls_first())


def live_feed(df: DataFrame, columns: Sequence[str], n: int = fixed.FEED_MESSAGES, *,
              ts: str | None = "ts", id: str = "event_id") -> DataFrame:
    """The last few messages, newest first, with the columns to show."""
    return latest_n(df, n, ts=ts, id=id).select(*columns)
