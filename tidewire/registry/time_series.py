"""Histories, spikes, forecasts and running totals of event counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.operators import metrics, series
from tidewire.registry import Entry
from tidewire.registry.inputs import table


def _hourly(spark, folder, **options):
    return series.bucket_counts(table(spark, folder, "events"), "event_type", **options)


def rate_per_minute(spark, folder):
    return metrics.rate_per_window(table(spark, folder, "events"))


def peak_rate(spark, folder):
    return metrics.peak_rate(table(spark, folder, "events"), width="1 hour")


def series_history(spark, folder):
    return series.series_history(_hourly(spark, folder))


def series_history_padded(spark, folder):
    daily = _hourly(spark, folder, width="1 day", fill_gaps=True)
    return series.series_history(daily, pad=20)


def spike_alerts(spark, folder):
    return series.spike_alerts(_hourly(spark, folder))


def spike_alerts_padded(spark, folder):
    return series.spike_alerts(_hourly(spark, folder, fill_gaps=True), pad=20).filter("is_spike")


def linear_forecast(spark, folder):
    return series.linear_forecast(_hourly(spark, folder))


def forecast_series(spark, folder):
    return series.forecast_series(_hourly(spark, folder), drop_last=True)


def cumulative_flow(spark, folder):
    return series.cumulative_flow(table(spark, folder, "events"))


def message_ordinals(spark, folder):
    return series.message_ordinals(table(spark, folder, "events"))


def _some_untimed(spark, folder):
    """Events, one in seven without a time."""
    return table(spark, folder, "events").withColumn(
        "ts", F.when(F.col("event_id") % 7 != 0, F.col("ts")))


def rate_per_minute_nulls(spark, folder):
    return metrics.rate_per_window(_some_untimed(spark, folder))


def series_history_nulls(spark, folder):
    counts = series.bucket_counts(_some_untimed(spark, folder), "event_type")
    return series.series_history(counts)


def cumulative_flow_nulls(spark, folder):
    return series.cumulative_flow(_some_untimed(spark, folder))


_RULES = (("error", 2000, "operations", "Errors are rising."),
          ("purchase", 1_000_000_000_000, "sales", "Purchases are rising."),
          ("refund", 0, "sales", "Refunds are rising."))


def threshold_advice(spark, folder):
    by_type = table(spark, folder, "events").groupBy(F.col("event_type").alias("topic")).agg(
        F.count(F.lit(1)).alias("n"))
    return series.threshold_advice(by_type, _RULES)


_HOURLY = """(SELECT event_type AS series, date_trunc('hour', ts) AS bucket_start, count(*) AS n
    FROM events GROUP BY 1, 2)"""
_UNTIMED = """(SELECT event_id, event_type, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts
    FROM events)"""
_FILLED = """(SELECT g.series, g.bucket_start, coalesce(c.n, 0) AS n FROM (
        SELECT event_type AS series, unnest(generate_series(min(date_trunc('{0}', ts)),
            max(date_trunc('{0}', ts)), INTERVAL 1 {0})) AS bucket_start
        FROM events GROUP BY event_type) g
    LEFT JOIN (SELECT event_type AS series, date_trunc('{0}', ts) AS bucket_start, count(*) AS n
        FROM events GROUP BY 1, 2) c USING (series, bucket_start))"""
_AGED = """(SELECT *, row_number() OVER (PARTITION BY series ORDER BY bucket_start DESC) AS age
    FROM {})"""
_FORECAST = f"""(
    SELECT series, step, CASE WHEN m < 2 THEN CAST(last AS BIGINT) ELSE
        CAST(trunc(greatest(0, round(intercept + slope * (m - 1 + step), 9))) AS BIGINT) END
        AS forecast
    FROM (SELECT series, count(*) AS m, max(n) AS last, regr_slope(n, x) AS slope,
            regr_intercept(n, x) AS intercept
        FROM (SELECT series, n, count(*) OVER (PARTITION BY series) - age AS x
            FROM {_AGED.format(_HOURLY)} WHERE age <= 15) GROUP BY series),
        (SELECT CAST(unnest(generate_series(1, 10)) AS INTEGER) AS step))"""

ENTRIES = {
    "rate_per_minute": Entry(rate_per_minute, """
        SELECT date_trunc('minute', ts) AS window_start, count(*) AS n FROM events GROUP BY 1"""),
    "peak_rate": Entry(peak_rate, """
        SELECT n AS peak_n, h AS peak_start FROM (
            SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1)
        ORDER BY n DESC, h LIMIT 1"""),
    "series_history": Entry(series_history, f"""
        SELECT series, CAST(count(*) OVER (PARTITION BY series) - age AS INTEGER) AS position,
            bucket_start, n
        FROM {_AGED.format(_HOURLY)} WHERE age <= 50"""),
    "series_history_padded": Entry(series_history_padded, f"""
        WITH kept AS (SELECT * FROM {_AGED.format(_FILLED.format('day'))} WHERE age <= 50),
        sized AS (SELECT *, count(*) OVER (PARTITION BY series) AS m FROM kept)
        SELECT series, CAST(least(20, 50 - m) + m - age AS INTEGER) AS position, bucket_start, n
        FROM sized
        UNION ALL
        SELECT series, CAST(unnest(range(least(20, 50 - m))) AS INTEGER) AS position,
            NULL AS bucket_start, 0 AS n FROM (SELECT DISTINCT series, m FROM sized)"""),
    "spike_alerts": Entry(spike_alerts, f"""
        SELECT series, bucket_start, n, mean_n, n > 1.5::DOUBLE * mean_n AND n > 5 AS is_spike
        FROM (SELECT *, sum(n) OVER w / count(*) OVER w AS mean_n FROM {_HOURLY}
            WINDOW w AS (PARTITION BY series ORDER BY bucket_start
                ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))"""),
    "spike_alerts_padded": Entry(spike_alerts_padded, f"""
        SELECT series, bucket_start, n, mean_n, TRUE AS is_spike
        FROM (SELECT series, bucket_start, n, sum(n) OVER w / least(50, row_number() OVER
                (PARTITION BY series ORDER BY bucket_start) + 20) AS mean_n
            FROM {_FILLED.format('hour')}
            WINDOW w AS (PARTITION BY series ORDER BY bucket_start
                ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))
        WHERE n > 1.5::DOUBLE * mean_n AND n > 5"""),
    "linear_forecast": Entry(linear_forecast, f"""
        SELECT series, step, forecast FROM {_FORECAST}"""),
    "forecast_series": Entry(forecast_series, f"""
        WITH actual AS (
            SELECT series, count(*) OVER (PARTITION BY series) - age AS position, n, age
            FROM {_AGED.format(_HOURLY)} WHERE age <= 50)
        SELECT series, CAST(position AS INTEGER) AS position, 'actual' AS kind, n FROM actual
        UNION ALL
        SELECT series, CAST(position AS INTEGER), 'anchor', n FROM actual WHERE age = 1
        UNION ALL
        SELECT series, CAST(position + step AS INTEGER), 'forecast', forecast
        FROM actual JOIN {_FORECAST} USING (series) WHERE age = 1 AND step < 10"""),
    "cumulative_flow": Entry(cumulative_flow, """
        SELECT bucket_start, n, CAST(sum(n) OVER (ORDER BY bucket_start) AS BIGINT) AS cumulative
        FROM (SELECT date_trunc('hour', ts) AS bucket_start, count(*) AS n FROM events
            GROUP BY 1)"""),
    "rate_per_minute_nulls": Entry(rate_per_minute_nulls, f"""
        SELECT date_trunc('minute', ts) AS window_start, count(*) AS n FROM {_UNTIMED} GROUP BY 1"""),
    "series_history_nulls": Entry(series_history_nulls, f"""
        SELECT series, CASE WHEN bucket_start IS NOT NULL THEN CAST(count(bucket_start) OVER
            (PARTITION BY series) - age AS INTEGER) END AS position, bucket_start, n
        FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY bucket_start DESC NULLS LAST)
                AS age
            FROM (SELECT event_type AS series, date_trunc('hour', ts) AS bucket_start, count(*) AS n
                FROM {_UNTIMED} GROUP BY 1, 2)) WHERE age <= 50 OR bucket_start IS NULL"""),
    "cumulative_flow_nulls": Entry(cumulative_flow_nulls, f"""
        SELECT bucket_start, n, CAST(sum(n) OVER (ORDER BY bucket_start NULLS LAST) AS BIGINT)
            AS cumulative
        FROM (SELECT date_trunc('hour', ts) AS bucket_start, count(*) AS n FROM {_UNTIMED}
            GROUP BY 1)"""),
    "message_ordinals": Entry(message_ordinals, """
        SELECT event_id, strftime(ts, '%H:%M:%S') AS clock,
            row_number() OVER (ORDER BY ts, event_id) - 1 AS ordinal FROM events"""),
    "threshold_advice": Entry(threshold_advice, """
        SELECT topic, n, threshold, addressee,
            CASE WHEN n > threshold THEN 'alert' ELSE 'stable' END AS level,
            CASE WHEN n > threshold THEN warning ELSE 'Stable.' END AS advice
        FROM (SELECT r.*, (SELECT count(*) FROM events WHERE event_type = r.topic) AS n
            FROM (VALUES ('error', 2000::BIGINT, 'operations', 'Errors are rising.'),
                ('purchase', 1000000000000::BIGINT, 'sales', 'Purchases are rising.'),
                ('refund', 0::BIGINT, 'sales', 'Refunds are rising.'))
            AS r(topic, threshold, addressee, warning))"""),
}
