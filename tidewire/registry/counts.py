"""Counts, shares and density of classified messages."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from tidewire.functions import polarity
from tidewire.operators import metrics, places
from tidewire.plans import boards
from tidewire.registry import Entry
from tidewire.registry import inputs as given
from tidewire.registry.inputs import table
from tidewire.registry.messages import _RULES, tagged


def total_count(spark, folder):
    return metrics.total_count(table(spark, folder, "documents"))


def topic_counts(spark, folder):
    return metrics.topic_counts(tagged(spark, folder), [t.label for t in given.TOPICS])


def kpi_summary(spark, folder):
    return metrics.kpi_summary(tagged(spark, folder))


def dist_sentiment(spark, folder):
    return metrics.distribution(tagged(spark, folder))


def dist_category_sentiment(spark, folder):
    return metrics.cross_distribution(tagged(spark, folder))


def dist_city_sentiment(spark, folder):
    return metrics.pivot_distribution(
        tagged(spark, folder).withColumnRenamed("country", "city"))


def geo_density(spark, folder):
    return places.geo_density(tagged(spark, folder), given.POINTS, step=2.5, default="en")


def geo_density_smooth(spark, folder):
    return places.smooth_density(geo_density(spark, folder), step=2.5)


EVENT_RULES = boards.SituationRules(topics=given.EVENT_TOPICS)


def _situation(spark, folder, rules=EVENT_RULES, **options):
    """Events as stored messages: the type is the text, the user's number makes the rating."""
    stored = table(spark, folder, "events").select(
        "event_id", "ts", F.col("event_type").alias("text"),
        F.concat(F.col("user_id") % 6, F.lit(" stars")).alias("sentiment_label"),
        F.when(F.col("event_type") == "view", "Egypt").when(
            F.col("event_type") == "click", "Kuwait").alias("country"))
    return boards.Situation(stored, rules, id="event_id", **options)


def situation_board(spark, folder):
    """Topic counts of the newest 10,000 messages beside the total of all."""
    board = _situation(spark, folder)
    return board.topics().withColumn("total", board.total().scalar())


def situation_advice(spark, folder):
    return _situation(spark, folder).advice()


def situation_map(spark, folder):
    return _situation(spark, folder).density()


def situation_forecast(spark, folder):
    return _situation(spark, folder).forecast()


def situation_history(spark, folder):
    return _situation(spark, folder).history()


def situation_history_padded(spark, folder):
    """Daily points behind twenty zeros."""
    rules = dataclasses.replace(EVENT_RULES, pad=20)
    return _situation(spark, folder, rules, width="1 day").history()


def situation_alerts(spark, folder):
    return _situation(spark, folder).alerts()


def _board(spark, folder):
    messages = table(spark, folder, "events").select(
        "event_id", "ts", F.concat_ws(" ", "event_type", "props").alias("text"),
        polarity.lexicon_sentiment("event_type", ("purchase", "signup"), ("error",))
        .alias("sentiment"), F.col("event_type").alias("country"))
    return boards.MessageBoard(messages, _RULES, id="event_id")


def message_board(spark, folder):
    return _board(spark, folder).kpis()


def message_board_flow(spark, folder):
    return _board(spark, folder).flow().withColumnRenamed("bucket_start", "second")


def message_board_feed(spark, folder):
    return _board(spark, folder).feed()


def message_board_sentiments(spark, folder):
    return _board(spark, folder).sentiments()


def message_board_categories(spark, folder):
    return _board(spark, folder).categories()


def message_board_cities(spark, folder):
    return _board(spark, folder).cities()


_TAGGED = f"""(SELECT doc_id, lang AS country, {given.SENTIMENT_SQL} AS sentiment,
    {given.TOPIC_SQL} AS topic, {given.CATEGORY_SQL} AS category FROM documents)"""
_KPIS = """count(*) AS total,
    count(*) FILTER (sentiment = 'positive') AS positive_count,
    count(*) FILTER (sentiment = 'negative') AS negative_count,
    count(*) FILTER (sentiment = 'neutral') AS neutral_count,
    round(CASE WHEN count(*) > 0 THEN 100::DOUBLE * count(*) FILTER (sentiment = 'positive')
        / count(*) ELSE 0 END, 1) AS positivity_index"""
_NEWEST = "(SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT {})"
_EVENT_TOPICS = f"""(
    SELECT count(*) FILTER (topic = 'Unemployment') AS unemployment,
        count(*) FILTER (topic = 'Anxiety') AS anxiety, count(*) FILTER (topic = 'Economy') AS economy
    FROM (SELECT {given.EVENT_TOPIC_SQL} AS topic FROM {_NEWEST.format('ALL')}))"""
_EVENT_SENTIMENT = """CASE WHEN event_type IN ('purchase', 'signup') THEN 'positive'
    WHEN event_type = 'error' THEN 'negative' ELSE 'neutral' END"""

_TOPIC_AGED = f"""(
    SELECT *, row_number() OVER (PARTITION BY series ORDER BY bucket_start DESC) AS age
    FROM (SELECT {given.EVENT_TOPIC_SQL} AS series,
            CAST(date_trunc('{{0}}', ts) AS TIMESTAMP) AS bucket_start, count(*) AS n
        FROM events GROUP BY 1, 2) WHERE series <> 'General')"""
_BOARD = f"""(SELECT {_EVENT_SENTIMENT} AS sentiment, event_type AS city, 'other' AS category
    FROM {_NEWEST.format(500)})"""

_DENSITY = f"""
        SELECT CAST(floor(lat / 2.5::DOUBLE) AS BIGINT) AS lat_cell,
            CAST(floor(lon / 2.5::DOUBLE) AS BIGINT) AS lon_cell, count(*) AS n
        FROM (SELECT CASE country WHEN 'de' THEN 52.52::DOUBLE WHEN 'es' THEN 40.42::DOUBLE
                ELSE 51.5::DOUBLE END AS lat,
            CASE country WHEN 'de' THEN 13.4::DOUBLE WHEN 'es' THEN -3.7::DOUBLE
                ELSE -0.25::DOUBLE END AS lon
            FROM {_TAGGED} WHERE sentiment = 'negative')
        GROUP BY 1, 2"""

ENTRIES = {
    "total_count": Entry(total_count, "SELECT count(*) AS total FROM documents"),
    "topic_counts": Entry(topic_counts, f"""
        SELECT count(*) FILTER (topic = 'Work') AS work, count(*) FILTER (topic = 'Worry') AS worry,
            count(*) FILTER (topic = 'Money') AS money FROM {_TAGGED}"""),
    "kpi_summary": Entry(kpi_summary, f"SELECT {_KPIS} FROM {_TAGGED}"),
    "dist_sentiment": Entry(dist_sentiment, f"""
        SELECT sentiment, count(*) AS n,
            count(*)::DOUBLE / (sum(count(*)) OVER ())::DOUBLE AS share
        FROM {_TAGGED} GROUP BY sentiment"""),
    "dist_category_sentiment": Entry(dist_category_sentiment, f"""
        SELECT category, sentiment, count(*) AS n FROM {_TAGGED} GROUP BY category, sentiment"""),
    "dist_city_sentiment": Entry(dist_city_sentiment, f"""
        SELECT country AS city, count(*) FILTER (sentiment = 'positive') AS positive,
            count(*) FILTER (sentiment = 'negative') AS negative,
            count(*) FILTER (sentiment = 'neutral') AS neutral FROM {_TAGGED} GROUP BY country"""),
    "geo_density": Entry(geo_density, _DENSITY),
    "geo_density_smooth": Entry(geo_density_smooth, f"""
        WITH kernel(away, times) AS (VALUES (-2, 1), (-1, 4), (0, 6), (1, 4), (2, 1))
        SELECT lat_cell + a.away AS lat_cell,
            (lon_cell + o.away + 72 + 144) % 144 - 72 AS lon_cell,
            CAST(sum(n * a.times * o.times) AS BIGINT) AS weight
        FROM ({_DENSITY}), kernel AS a, kernel AS o
        WHERE lat_cell + a.away BETWEEN -36 AND 36
        GROUP BY 1, 2"""),
    "situation_board": Entry(situation_board, f"""
        SELECT (SELECT count(*) FROM events) AS total, * FROM {_EVENT_TOPICS}"""),
    "situation_advice": Entry(situation_advice, f"""
        SELECT 'Unemployment' AS topic, unemployment AS n, 10::BIGINT AS threshold,
            'Labor Ministry' AS addressee,
            CASE WHEN unemployment > 10 THEN 'alert' ELSE 'stable' END AS level,
            CASE WHEN unemployment > 10 THEN 'High unemployment mentions detected.'
                ELSE 'Stable.' END AS advice FROM {_EVENT_TOPICS}
        UNION ALL
        SELECT 'Anxiety', anxiety, 10::BIGINT, 'Health Ministry',
            CASE WHEN anxiety > 10 THEN 'alert' ELSE 'stable' END,
            CASE WHEN anxiety > 10 THEN 'Anxiety levels rising.' ELSE 'Stable.' END
        FROM {_EVENT_TOPICS}"""),
    "situation_map": Entry(situation_map, f"""
        SELECT CAST(floor(lat) AS BIGINT) AS lat_cell, CAST(floor(lon) AS BIGINT) AS lon_cell,
            count(*) AS n
        FROM (SELECT CASE event_type WHEN 'view' THEN 26.82 WHEN 'click' THEN 29.37 ELSE 31.95 END
                AS lat, CASE event_type WHEN 'view' THEN 30.8 WHEN 'click' THEN 47.97 ELSE 35.91 END
                AS lon
            FROM {_NEWEST.format('ALL')} WHERE user_id % 6 IN (1, 2))
        GROUP BY 1, 2"""),
    "situation_forecast": Entry(situation_forecast, f"""
        WITH hourly AS (
            SELECT {given.EVENT_TOPIC_SQL} AS series, date_trunc('hour', ts) AS h, count(*) AS n
            FROM events GROUP BY 1, 2),
        aged AS (
            SELECT series, n, row_number() OVER (PARTITION BY series ORDER BY h DESC) AS age
            FROM hourly WHERE series <> 'General'),
        placed AS (
            SELECT *, count(*) OVER (PARTITION BY series) - age AS position FROM aged
            WHERE age <= 50),
        line AS (
            SELECT series, count(*) AS m, any_value(n) AS one, regr_slope(n, position) AS slope,
                regr_intercept(n, position) AS intercept, max(position) AS last
            FROM placed WHERE age <= 15 GROUP BY series)
        SELECT series, CAST(position AS INTEGER) AS position, 'actual' AS kind, n FROM placed
        UNION ALL
        SELECT series, CAST(position AS INTEGER), 'anchor', n FROM placed WHERE age = 1
        UNION ALL
        SELECT series, CAST(last + step AS INTEGER), 'forecast', CASE WHEN m < 2 THEN one ELSE
            CAST(trunc(greatest(0, round(intercept + slope * (last + step), 9))) AS BIGINT) END
        FROM line, (SELECT unnest(generate_series(1, 10)) AS step)"""),
    "situation_history": Entry(situation_history, f"""
        SELECT series, CAST(count(*) OVER (PARTITION BY series) - age AS INTEGER) AS position,
            bucket_start, n FROM {_TOPIC_AGED.format('hour')} WHERE age <= 50"""),
    "situation_history_padded": Entry(situation_history_padded, f"""
        WITH sized AS (
            SELECT *, count(*) OVER (PARTITION BY series) AS m
            FROM {_TOPIC_AGED.format('day')} WHERE age <= 50)
        SELECT series, CAST(least(20, 50 - m) + m - age AS INTEGER) AS position, bucket_start, n
        FROM sized
        UNION ALL
        SELECT series, CAST(unnest(range(least(20, 50 - m))) AS INTEGER) AS position,
            NULL AS bucket_start, 0 AS n FROM (SELECT DISTINCT series, m FROM sized)"""),
    "situation_alerts": Entry(situation_alerts, f"""
        SELECT series, bucket_start, n, mean_n, n > 1.5::DOUBLE * mean_n AND n > 5 AS is_spike
        FROM (SELECT *, sum(n) OVER w / count(*) OVER w AS mean_n
            FROM {_TOPIC_AGED.format('hour')}
            WINDOW w AS (PARTITION BY series ORDER BY bucket_start
                ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))"""),
    "message_board_sentiments": Entry(message_board_sentiments, f"""
        SELECT sentiment, count(*) AS n,
            count(*)::DOUBLE / (sum(count(*)) OVER ())::DOUBLE AS share
        FROM {_BOARD} GROUP BY sentiment"""),
    "message_board_categories": Entry(message_board_categories, f"""
        SELECT category, sentiment, count(*) AS n FROM {_BOARD} GROUP BY category, sentiment"""),
    "message_board_cities": Entry(message_board_cities, f"""
        SELECT city, count(*) FILTER (sentiment = 'positive') AS positive,
            count(*) FILTER (sentiment = 'negative') AS negative,
            count(*) FILTER (sentiment = 'neutral') AS neutral FROM {_BOARD} GROUP BY city"""),
    "message_board": Entry(message_board, f"""
        SELECT {_KPIS} FROM (SELECT {_EVENT_SENTIMENT} AS sentiment FROM {_NEWEST.format(500)})"""),
    "message_board_flow": Entry(message_board_flow, f"""
        SELECT second, n, CAST(sum(n) OVER (ORDER BY second) AS BIGINT) AS cumulative FROM (
            SELECT date_trunc('second', ts) AS second, count(*) AS n FROM {_NEWEST.format(500)}
            GROUP BY 1)"""),
    "message_board_feed": Entry(message_board_feed, f"""
        SELECT event_type || ' ' || props AS text, {_EVENT_SENTIMENT} AS sentiment,
            event_type AS city, 'unknown' AS gender, 0 AS age, 'other' AS category,
            'lexicon' AS analysis_engine FROM {_NEWEST.format(5)}"""),
}
