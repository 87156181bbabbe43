"""Counts over event time: histories, spikes, forecasts, running totals.

All functions first count messages per (series, time bucket). From there on the rows number series
times buckets, whatever the traffic, and a busy series is no larger than a quiet one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidewire import fixed_values as fixed
from tidewire.session import ensure_checkpoint_dir, small_table

# Rows of (id, time) that one task sorts for the ordinals.
ROWS_PER_TASK = 4_000_000

ADVICE_RULE = StructType([
    StructField("rule_topic", StringType(), False),
    StructField("threshold", LongType(), False),
    StructField("addressee", StringType(), False),
    StructField("warning", StringType(), False),
])


# Buckets of a filled history that one row of the grid stands for before they are rows themselves.
GRID_STRETCH = 10_000


def time_bucket(df: DataFrame, ts: str, width: str) -> Column:
    """Start of the tumbling window that a row's time lies in, null for a row without a time.

    ``window`` alone drops such rows.
    """
    some = F.lit("1970-01-01 00:00:00").cast(dict(df.dtypes)[ts])
    return F.when(F.col(ts).isNotNull(), F.window(F.coalesce(F.col(ts), some), width)["start"])


def bucket_counts(df: DataFrame, series: str = "topic", ts: str = "ts", width: str = "1 hour",
                  fill_gaps: bool = False) -> DataFrame:
    """(series, bucket_start, n) per tumbling window; rows without a time count in a bucket without
    a start.

    ``fill_gaps`` adds zeros between the first and the last bucket of each series; by default
    buckets without messages have no row.
    """
    counts = df.groupBy(F.col(series).alias("series"),
                        time_bucket(df, ts, width).alias("bucket_start")).agg(
        F.count(F.lit(1)).alias("n"))
    if not fill_gaps:
        return counts
    spans = counts.groupBy("series").agg(F.min("bucket_start").alias("_from"),
                                         F.max("bucket_start").alias("_to"))
    # in two steps, so that no row holds more than a stretch of a long grid
    stretches = spans.select("series", "_to", F.explode(F.expr(
        f"sequence(_from, _to, interval {width} * {GRID_STRETCH})")).alias("_at"))
    grid = stretches.select("series", F.explode(F.expr(
        f"sequence(_at, least(_to, _at + interval {width} * {GRID_STRETCH - 1}), "
        f"interval {width})")).alias("bucket_start"))
    filled = grid.join(counts.withColumnRenamed("series", "_series"),
                       F.col("series").eqNullSafe(F.col("_series"))
                       & (grid["bucket_start"] == counts["bucket_start"]), "left").select(
        "series", grid["bucket_start"], F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    return filled.unionByName(counts.filter(F.col("bucket_start").isNull()))


def _newest(counts: DataFrame, points: int, pad: int = 0) -> DataFrame:
    """The newest points of each series with their age (1 is the newest) and their position from 0
    in time order, behind ``_zeros`` leading zero points that the history has room for. The bucket
    without a start is no point: it has no position and is older than all."""
    by_series = Window.partitionBy("series")
    newest_first = by_series.orderBy(F.col("bucket_start").desc_nulls_last())
    timed = F.col("bucket_start").isNotNull()
    kept = counts.withColumn("_age", F.row_number().over(newest_first)).filter(
        (F.col("_age") <= points) | ~timed)
    size = F.count("bucket_start").over(by_series).cast("int")
    sized = kept.withColumn("_size", size)
    zeros = F.least(F.lit(pad), F.lit(points) - F.col("_size"))
    return sized.select("series", "bucket_start", "n", "_age", "_size", zeros.alias("_zeros"),
                        F.when(timed, zeros + F.col("_size") - F.col("_age")).alias("position"))


def _timed(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("bucket_start").isNotNull())


def series_history(counts: DataFrame, points: int = fixed.HISTORY_POINTS,
                   pad: int = 0) -> DataFrame:
    """The newest points of each series, numbered from 0 in time order.

    ``pad`` puts that many zero points (bucket_start NULL) before the first, as far as the newest
    ``points`` reach. Messages without a time have a row without bucket_start and position.
    """
    placed = _newest(counts, points, pad)
    if not pad:
        return placed.select("series", "position", "bucket_start", "n")

    def point(position, start, n):
        return F.struct(position.cast("int").alias("position"), start.alias("bucket_start"),
                        n.cast("bigint").alias("n"))

    itself = F.array(point(F.col("position"), F.col("bucket_start"), F.col("n")))
    no_start = F.lit(None).cast(dict(counts.dtypes)["bucket_start"])
    zeros = F.transform(F.sequence(F.lit(0), F.col("_zeros") - 1),
                        lambda position: point(position, no_start, F.lit(0)))
    oldest_with_room = (F.col("_age") == F.col("_size")) & (F.col("_zeros") > 0)
    return placed.select("series", F.inline(
        F.when(oldest_with_room, F.concat(zeros, itself)).otherwise(itself)))


def spike_alerts(counts: DataFrame, factor: float = fixed.SPIKE_FACTOR,
                 floor: int = fixed.SPIKE_FLOOR, points: int = fixed.HISTORY_POINTS, *,
                 pad: int = 0, min_history: int = 1) -> DataFrame:
    """Every bucket with its rolling mean and whether it is a spike.

    A bucket is a spike when it exceeds ``factor`` times the mean of the last ``points`` counts,
    itself included, and ``floor``. ``pad`` counts that many zeros before the first bucket;
    ``min_history`` keeps younger series quiet. Messages without a time have no place in this.
    """
    in_time = Window.partitionBy("series").orderBy("bucket_start")
    rolling = in_time.rowsBetween(1 - points, Window.currentRow)
    seen = F.row_number().over(in_time)
    mean = F.sum("n").over(rolling) / F.least(F.lit(points), seen + F.lit(pad))
    spike = ((F.col("n") > F.lit(factor) * F.col("mean_n")) & (F.col("n") > floor)
             & (F.col("_seen") >= min_history))
    return _timed(counts).select("series", "bucket_start", "n", mean.alias("mean_n"),
                         seen.alias("_seen")).select(
        "series", "bucket_start", "n", "mean_n", spike.alias("is_spike"))


def _fit(m, total, moment, step):
    """Whole messages on the least-squares line, ``step`` points after the last of ``m``.

    Time runs from the middle of the points in half steps, 2x - (m - 1), so that all sums are whole
    numbers: the projection is exact and truncates without rounding noise.
    """
    m = m.cast("bigint")
    spread = F.call_function("div", m * (m * m - 1), F.lit(3))
    line = F.call_function("div", total * spread + m * moment * (m - 1 + 2 * step), m * spread)
    return F.when(m < 2, total).otherwise(F.greatest(F.lit(0).cast("bigint"), line))


def _with_fit(placed: DataFrame, points: int) -> DataFrame:
    """Adds the sums of the fit over the newest points; leading zeros only add to their number."""
    by_series = Window.partitionBy("series")
    fitted = F.col("_age") <= points
    m = F.least(F.lit(points), F.col("_size") + F.col("_zeros"))
    return placed.withColumn("_m", m).withColumns({
        "_total": F.sum(F.when(fitted, F.col("n"))).over(by_series),
        "_moment": F.sum(F.when(fitted, F.col("n") * (F.col("_m") + 1 - 2 * F.col("_age"))))
        .over(by_series),
    })


def _projection(step):
    return _fit(F.col("_m"), F.col("_total"), F.col("_moment"), step)


def linear_forecast(counts: DataFrame, steps: int = fixed.FORECAST_STEPS,
                    points: int = fixed.FIT_POINTS, *, pad: int = 0) -> DataFrame:
    """Least-squares line through the newest points of each series, ``steps`` buckets ahead.

    Projections are truncated to whole messages and never negative. A series of one point repeats
    it. Points are taken as equally spaced, whatever their distance in time.
    """
    last = _with_fit(_newest(_timed(counts), points, pad), points).filter(F.col("_age") == 1)
    ahead = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    return ahead.select("series", "step", _projection(F.col("step")).alias("forecast"))


def forecast_series(counts: DataFrame, steps: int = fixed.FORECAST_STEPS,
                    points: int = fixed.FIT_POINTS, history: int = fixed.HISTORY_POINTS, *,
                    pad: int = 0, drop_last: bool = False) -> DataFrame:
    """History and forecast as one line per series: (series, position, kind, n).

    The forecast starts with an anchor on the last actual point. ``drop_last`` leaves out the last
    step, so that anchor and forecast together have ``steps`` points. Everything comes out of the
    rows of the history, without joining it to itself.
    """
    fitted = _with_fit(_newest(_timed(counts), history, pad), points)

    def point(position, kind, n):
        return F.struct(position.cast("int").alias("position"), F.lit(kind).alias("kind"),
                        n.cast("bigint").alias("n"))

    actual = F.array(point(F.col("position"), "actual", F.col("n")))
    anchor = F.array(point(F.col("position"), "anchor", F.col("n")))
    ahead = F.transform(
        F.sequence(F.lit(1), F.lit(steps - 1 if drop_last else steps)),
        lambda step: point(F.col("position") + step, "forecast", _projection(step)))
    zeros = F.transform(F.sequence(F.lit(0), F.col("_zeros") - 1),
                        lambda position: point(position, "actual", F.lit(0)))
    none = F.array().cast("array<struct<position:int,kind:string,n:bigint>>")
    oldest_with_room = (F.col("_age") == F.col("_size")) & (F.col("_zeros") > 0)
    return fitted.select("series", F.inline(F.concat(
        F.when(oldest_with_room, zeros).otherwise(none),
        actual,
        F.when(F.col("_age") == 1, F.concat(anchor, ahead)).otherwise(none))))


def cumulative_flow(df: DataFrame, ts: str = "ts", width: str = "1 hour",
                    block: str = "1 day") -> DataFrame:
    """Messages so far at the end of each bucket.

    Running sums are taken within blocks of time, in parallel, and raised by the total of the
    earlier blocks; only the block totals pass through one task. Messages without a time come last.
    """
    counts = df.groupBy(time_bucket(df, ts, width).alias("bucket_start")).agg(
        F.count(F.lit(1)).alias("n"))
    blocked = counts.withColumn("_block", time_bucket(counts, "bucket_start", block))
    totals = blocked.groupBy("_block").agg(F.sum("n").alias("_sum"))
    before = totals.select("_block", F.coalesce(F.sum("_sum").over(
        Window.orderBy(F.col("_block").asc_nulls_last()).rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    before = before.withColumnRenamed("_block", "_at")
    within = F.sum("n").over(Window.partitionBy("_block").orderBy("bucket_start").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    return blocked.withColumn("_within", within).join(
        before, F.col("_block").eqNullSafe(F.col("_at"))).select(
        "bucket_start", "n", (F.col("_before") + F.col("_within")).alias("cumulative"))


def message_ordinals(df: DataFrame, ts: str = "ts", id: str = "event_id",
                     partitions: int | None = None) -> DataFrame:
    """Ordinal of each message in order of (time, id), from 0, with its clock time as text.

    A range shuffle on the whole order splits even a single crowded instant. The sorted rows are
    checkpointed, so both passes over them (sizes, numbers) see the same rows in the same places
    when an executor is lost.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    width = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                              math.ceil(df.count() / ROWS_PER_TASK))
    placed = (
        df.select(id, ts).repartitionByRange(width, F.col(ts), F.col(id))
        .sortWithinPartitions(ts, id)
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_start"))
    # one row per task
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").select(
        id, F.date_format(ts, fixed.CLOCK_FORMAT).alias("clock"),
        (F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))).alias("ordinal"))


def threshold_advice(counts: DataFrame, rules: Sequence[tuple] = fixed.ADVICE_RULES, *,
                     topic: str = "topic", n: str = "n",
                     stable: str = fixed.STABLE_ADVICE) -> DataFrame:
    """One line per rule (topic, threshold, addressee, warning); a topic never seen counts 0."""
    table = small_table(counts.sparkSession, rules, ADVICE_RULE)
    # at most one row per rule: the counts of other topics are left behind by the broadcast semi join
    named = counts.select(F.col(topic).alias("_topic"), F.col(n).alias("_n"))
    ruled = named.join(table, F.col("_topic") == F.col("rule_topic"), "left_semi")
    joined = table.join(ruled, F.col("rule_topic") == F.col("_topic"), "left")
    count = F.coalesce("_n", F.lit(0)).cast("bigint")
    over = count > F.col("threshold")
    return joined.select(
        F.col("rule_topic").alias("topic"), count.alias("n"), "threshold", "addressee",
        F.when(over, "alert").otherwise("stable").alias("level"),
        F.when(over, F.col("warning")).otherwise(F.lit(stable)).alias("advice"))
