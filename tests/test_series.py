import datetime

import pytest
from pyspark.sql import functions as F

from tidewire.operators import series

START = datetime.datetime(2024, 1, 1)


def counts(spark, *histories):
    rows = [(f"s{k}", START + datetime.timedelta(hours=i), n)
            for k, history in enumerate(histories) for i, n in enumerate(history)]
    return spark.createDataFrame(rows, "series string, bucket_start timestamp_ntz, n bigint")


FORECASTS = [
    ([40, 45], [50, 55, 60, 65, 70, 75, 80, 85, 90, 95]),
    ([10, 8, 6, 4, 2], [0] * 10),
    ([1, 2, 2], [2, 3, 3, 4, 4, 5, 5, 6, 6, 7]),
    ([7, 7, 7], [7] * 10),
    ([9], [9] * 10),
    ([100, 100, 100, *range(1, 16)], list(range(16, 26))),
]


def test_forecast_goldens(spark):
    found = series.linear_forecast(counts(spark, *[h for h, _ in FORECASTS])).orderBy(
        "series", "step").collect()
    for k, (_, wanted) in enumerate(FORECASTS):
        assert [row.forecast for row in found if row.series == f"s{k}"] == wanted


def test_no_history_no_forecast(spark):
    assert series.linear_forecast(counts(spark)).collect() == []


def test_forecast_of_huge_counts(spark):
    big = 10 ** 12
    rows = series.linear_forecast(counts(spark, [big + i for i in range(15)])).orderBy("step")
    assert [r.forecast for r in rows.collect()] == [big + 15 + i for i in range(10)]


def exact_line(history, steps, points=15):
    from fractions import Fraction

    recent = history[-points:]
    m = len(recent)
    if m < 2:
        return recent * steps
    mean_x, mean_y = Fraction(m - 1, 2), Fraction(sum(recent), m)
    slope = (sum((x - mean_x) * (y - mean_y) for x, y in enumerate(recent))
             / sum((x - mean_x) ** 2 for x in range(m)))
    return [max(0, int(mean_y + slope * (m - 1 + k - mean_x))) for k in range(1, steps + 1)]


def test_forecast_equals_exact_line(spark):
    import random

    pick = random.Random(3)
    histories = [[pick.randrange(60) for _ in range(pick.randrange(1, 40))] for _ in range(60)]
    rows = series.linear_forecast(counts(spark, *histories)).orderBy("series", "step").collect()
    for k, history in enumerate(histories):
        assert [r.forecast for r in rows if r.series == f"s{k}"] == exact_line(history, 10)


@pytest.mark.parametrize("history, wanted", [
    ([1, 1, 1, 1, 20], [4]), ([6, 6], []), ([1, 1, 5], [])])
def test_spike_goldens(spark, history, wanted):
    rows = series.spike_alerts(counts(spark, history)).orderBy("bucket_start").collect()
    assert [i for i, row in enumerate(rows) if row.is_spike] == wanted


def test_spike_padding(spark):
    rows = series.spike_alerts(counts(spark, [6] * 60), pad=20).orderBy("bucket_start").collect()
    assert [i for i, row in enumerate(rows) if row.is_spike] == list(range(33))


def test_spike_min_history(spark):
    rows = series.spike_alerts(counts(spark, [1, 9, 1, 1, 1, 30]), min_history=4).orderBy(
        "bucket_start").collect()
    assert [i for i, row in enumerate(rows) if row.is_spike] == [5]


def padded(history, points=50, pad=20):
    return ([0] * pad + history)[-points:]


@pytest.mark.parametrize("length", [1, 3, 29, 30, 31, 49, 50, 70])
def test_history_padding(spark, length):
    history = list(range(1, length + 1))
    rows = series.series_history(counts(spark, history), pad=20).orderBy("position").collect()
    assert [r.n for r in rows] == padded(history)
    assert [r.position for r in rows] == list(range(len(rows)))
    assert all((r.bucket_start is None) == (r.n == 0) for r in rows)


@pytest.mark.parametrize("length", [1, 4, 20, 60])
@pytest.mark.parametrize("pad", [0, 20])
def test_stitched_line(spark, length, pad):
    history = [(i * 7) % 11 for i in range(length)]
    rows = series.forecast_series(counts(spark, history), pad=pad).collect()
    actual = padded(history, pad=pad) if pad else history[-50:]
    ahead = exact_line(actual, 10)
    kinds = {kind: [(r.position, r.n) for r in sorted(rows) if r.kind == kind]
             for kind in ("actual", "anchor", "forecast")}
    end = len(actual) - 1
    assert kinds["actual"] == list(enumerate(actual))
    assert kinds["anchor"] == [(end, actual[-1])]
    assert kinds["forecast"] == [(end + 1 + i, n) for i, n in enumerate(ahead)]
    short = series.forecast_series(counts(spark, history), pad=pad, drop_last=True)
    assert short.filter("kind = 'forecast'").count() == 9


def events(spark, rows):
    return spark.createDataFrame(
        [(i, START + datetime.timedelta(minutes=m), topic) for i, (m, topic) in enumerate(rows)],
        "event_id bigint, ts timestamp_ntz, topic string")


def test_gaps(spark):
    df = events(spark, [(0, "a"), (5, "a"), (200, "a"), (10, None), (130, None)])
    plain = {(r.series, r.bucket_start.hour): r.n for r in series.bucket_counts(df).collect()}
    assert plain == {("a", 0): 2, ("a", 3): 1, (None, 0): 1, (None, 2): 1}
    filled = {(r.series, r.bucket_start.hour): r.n
              for r in series.bucket_counts(df, fill_gaps=True).collect()}
    assert filled == {("a", 0): 2, ("a", 1): 0, ("a", 2): 0, ("a", 3): 1,
                      (None, 0): 1, (None, 1): 0, (None, 2): 1}


def test_cumulative_flow_over_days(spark):
    df = events(spark, [(m, "a") for m in (0, 1, 70, 60 * 25, 60 * 25 + 1, 60 * 60)])
    rows = series.cumulative_flow(df).orderBy("bucket_start").collect()
    assert [(r.n, r.cumulative) for r in rows] == [(2, 2), (1, 3), (2, 5), (1, 6)]


def test_ordinals_with_a_crowded_instant(spark):
    """A third of the messages share one instant and are still spread over all tasks."""
    base = spark.range(30000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-05 00:00:00")).otherwise(
            F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"),
                     F.lit(" 01:02:03"))).cast("timestamp_ntz").alias("ts"))
    found = series.message_ordinals(base, partitions=8)
    rows = {r.event_id: r.ordinal for r in found.collect()}
    wanted = [r.event_id for r in sorted(base.collect(), key=lambda r: (r.ts, r.event_id))]
    assert [rows[i] for i in wanted] == list(range(30000))


def test_advice(spark):
    df = spark.createDataFrame([("Unemployment", 11), ("General", 99)], "topic string, n bigint")
    rows = {r.topic: (r.n, r.level, r.advice) for r in series.threshold_advice(df).collect()}
    assert rows == {
        "Unemployment": (11, "alert", "High unemployment mentions detected."),
        "Anxiety": (0, "stable", "Stable.")}


def test_busy_series_is_counted_before_it_is_shuffled(spark):
    df = spark.range(100000).select(
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("topic"))
    plan = series.bucket_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_count")
    hot = series.spike_alerts(series.bucket_counts(df)).filter("series = 'hot'").first()
    assert hot.n == 33334


def test_gap_filling_over_several_stretches(spark):
    df = spark.sql("""SELECT 'a' AS topic, timestamp'2024-01-01 00:00:30' AS ts
        UNION ALL SELECT 'a', timestamp'2024-01-01 00:00:30' + interval 25000 minutes
        UNION ALL SELECT NULL, timestamp'2024-01-01 00:00:30'""")
    filled = series.bucket_counts(df, width="1 minute", fill_gaps=True)
    found = filled.groupBy("series").agg(
        F.count(F.lit(1)).alias("buckets"), F.countDistinct("bucket_start").alias("different"),
        F.sum("n").alias("n")).collect()
    assert {tuple(row) for row in found} == {("a", 25001, 25001, 2), (None, 1, 1, 1)}
