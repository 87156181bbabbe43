"""Streaming queries run to the end of their input, their stored results read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidewire import schemas
from tidewire.functions import polarity
from tidewire.operators.prepare import json_parse
from tidewire.plans import streams as plans
from tidewire.registry import Entry
from tidewire.registry import inputs as given
from tidewire.registry.inputs import stream_path, table
from tidewire.registry.messages import QUALITY_NAMES, quality_model
from tidewire.session import scratch_folder
from tidewire.sources.messages import TableFiles, decode, read_table_stream
from tidewire.sources.sinks import BATCH_METRICS, BatchFolders, encode_json, read_batches
from tidewire.streaming import queries, stateful
from tidewire.streaming.together import Together

ONCE = {"availableNow": True}


# Stateless queries take a large table in steps. Those with a watermark take it in one, since its
# files may come in any order of time.
STEP = {"maxBytesPerTrigger": str(512 << 30)}


def _stream(spark, folder, name, options=STEP):
    schema = table(spark, folder, name).schema
    return read_table_stream(spark, TableFiles(stream_path(folder, name), schema, options=options))


def _events(spark, folder):
    """All events in one batch, their times as instants, which watermarks need."""
    return _stream(spark, folder, "events", {}).withColumn("ts", F.col("ts").cast("timestamp"))


def _appended(spark, df, purpose):
    """Run an appending query to the end and read its files."""
    base = scratch_folder(spark, purpose)
    queries.run_to_end(queries.append_to(df, f"{base}/checkpoint", path=f"{base}/out",
                                         trigger=ONCE))
    return spark.read.schema(df.schema).parquet(f"{base}/out")


_EVENT = StructType([
    StructField("event_id", LongType(), True),
    StructField("event_type", StringType(), True),
    StructField("value", DoubleType(), True),
    StructField("props", StringType(), True),
])


def stream_ingest(spark, folder):
    """Payload bytes decoded, parsed by schema and flattened."""
    messages = encode_json(_stream(spark, folder, "events"), _EVENT.fieldNames())
    return _appended(spark, json_parse(decode(messages), _EVENT), "ingest")


def _typed(spark, folder):
    return _stream(spark, folder, "events").select(
        "event_id", "event_type",
        polarity.lexicon_sentiment("event_type", ("purchase", "signup"), ("error",))
        .alias("sentiment"))


def stream_append(spark, folder):
    return _appended(spark, _typed(spark, folder), "append")


def stream_foreach_batch(spark, folder):
    base = scratch_folder(spark, "foreach")
    df = _typed(spark, folder)
    queries.run_to_end(queries.for_each_batch(
        df, BatchFolders(f"{base}/out"), f"{base}/checkpoint", trigger=ONCE))
    return read_batches(spark, f"{base}/out", df.schema)


def batch_metrics(spark, folder):
    """Rows of all batches by the log that was kept while they were written."""
    base = scratch_folder(spark, "metrics")
    watched = queries.Watched(BatchFolders(f"{base}/out"), BatchFolders(f"{base}/metrics"))
    queries.run_to_end(queries.for_each_batch(
        _typed(spark, folder), watched, f"{base}/checkpoint", trigger=ONCE))
    return read_batches(spark, f"{base}/metrics", BATCH_METRICS).agg(
        F.sum("row_count").alias("row_count"))


def stream_fan_out(spark, folder):
    base = scratch_folder(spark, "fan")
    df = _typed(spark, folder)
    queries.run_to_end(queries.fan_out(
        df, [BatchFolders(f"{base}/first"), BatchFolders(f"{base}/second")],
        f"{base}/checkpoint", trigger=ONCE))
    sinks = [read_batches(spark, f"{base}/{name}", df.schema).withColumn("sink", F.lit(name))
             for name in ("first", "second")]
    return sinks[0].unionByName(sinks[1]).groupBy("sink", "event_type", "sentiment").agg(
        F.count(F.lit(1)).alias("n"))


def stream_fan_out_together(spark, folder):
    """Two sinks of different columns in several batches, read as of one moment."""
    base = scratch_folder(spark, "together")
    table(spark, folder, "events").repartition(3, "event_id").write.parquet(f"{base}/in")
    df = read_table_stream(spark, TableFiles(
        f"{base}/in", table(spark, folder, "events").schema, options={"maxFilesPerTrigger": "1"}))
    sinks = {"all": lambda batch: batch.select("event_type", "value"),
             "errors": lambda batch: batch.filter(F.col("event_type") == "error").select(
                 "event_type", "user_id")}
    write = Together(f"{base}/out", sinks)
    queries.run_to_end(queries.for_each_batch(df, write, f"{base}/checkpoint", trigger=ONCE))
    found = write.read(spark, {name: of(table(spark, folder, "events")).schema
                               for name, of in sinks.items()})
    parts = [rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "sink", F.lit(name)) for name, rows in found.items()]
    return parts[0].unionByName(parts[1])


def stream_dedup(spark, folder):
    """Every event delivered twice."""
    twice = _events(spark, folder).unionByName(_events(spark, folder))
    return _appended(spark, stateful.dedup_stream(twice), "dedup").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))


def stream_new_only(spark, folder):
    """Two full deliveries, one after the other, into the same folders."""
    base = scratch_folder(spark, "new")
    df = _stream(spark, folder, "events")
    write = queries.NewOnly(BatchFolders(f"{base}/out"), df.schema)
    for delivery in ("first", "second"):
        queries.run_to_end(queries.for_each_batch(df, write, f"{base}/{delivery}", trigger=ONCE))
    return read_batches(spark, f"{base}/out", df.schema)


def stream_topic_window(spark, folder):
    topic = polarity.topic_priority("event_type", given.EVENT_TOPICS)
    windows = stateful.topic_windows(_events(spark, folder), topic)
    return _appended(spark, windows, "windows").withColumns({
        name: F.col(name).cast("timestamp_ntz") for name in ("window_start", "window_end")})


def survey_stream(spark, folder):
    """Documents as survey messages: parsed, tagged by lexicon, stored per batch."""
    base = scratch_folder(spark, "survey")
    messages = encode_json(_stream(spark, folder, "documents").select(
        F.col("lang").alias("country"), F.lit(2024).alias("year"), "text",
        (F.col("n_chars") % 90).cast("int").alias("age"), F.col("source").alias("gender")))
    queries.run_to_end(plans.run_surveys(
        messages, queries.Watched(BatchFolders(f"{base}/out")), f"{base}/checkpoint", given.GLAD,
        given.SAD, trigger=ONCE))
    schema = plans.tagged_surveys(messages).schema
    stored = read_batches(spark, f"{base}/out", schema)
    return stored.filter(F.col("processed_time").isNotNull()).drop("processed_time")


def indicator_stream(spark, folder):
    """Customers as employment indicators with a map by segment, one row per map entry."""
    messages = encode_json(_stream(spark, folder, "customer").select(
        F.col("c_name").alias("country"), F.col("c_nationkey").alias("year"),
        F.col("c_acctbal").alias("unemployment_rate"),
        F.lit(None).cast("double").alias("youth_unemployment"),
        F.create_map("c_mktsegment", "c_acctbal", F.lit("nation"),
                     F.col("c_nationkey").cast("double")).alias("sector_employment")))
    base = scratch_folder(spark, "indicators")
    queries.run_to_end(plans.run_indicators(
        messages, queries.Watched(BatchFolders(f"{base}/out")), f"{base}/checkpoint",
        trigger=ONCE))
    stored = read_batches(spark, f"{base}/out", schemas.EMPLOYMENT_INDICATOR)
    return stored.select("country", "year", "unemployment_rate", "youth_unemployment",
                         F.explode("sector_employment").alias("sector", "employment"))


def scored_stream(spark, folder):
    """Documents as social messages, scored by the model fitted on the labelled ones."""
    messages = encode_json(_stream(spark, folder, "documents").select(
        "text", "source", F.col("lang").alias("country"),
        F.lit("2024-01-01 00:00:00").alias("timestamp")))
    base = scratch_folder(spark, "social")
    queries.run_to_end(plans.run_social(
        messages, quality_model(spark, folder), QUALITY_NAMES, [BatchFolders(f"{base}/out")],
        f"{base}/checkpoint", trigger=ONCE))
    return read_batches(spark, f"{base}/out", schemas.SCORED_MESSAGE)


_SENTIMENT = """CASE WHEN event_type IN ('purchase', 'signup') THEN 'positive'
    WHEN event_type = 'error' THEN 'negative' ELSE 'neutral' END"""

ENTRIES = {
    "stream_ingest": Entry(stream_ingest, """
        SELECT event_id, event_type, value, props FROM events"""),
    "stream_append": Entry(stream_append, f"""
        SELECT event_id, event_type, {_SENTIMENT} AS sentiment FROM events"""),
    "stream_foreach_batch": Entry(stream_foreach_batch, f"""
        SELECT event_id, event_type, {_SENTIMENT} AS sentiment FROM events"""),
    "batch_metrics": Entry(batch_metrics, "SELECT count(*) AS row_count FROM events"),
    "stream_fan_out": Entry(stream_fan_out, f"""
        SELECT sink, event_type, {_SENTIMENT} AS sentiment, count(*) AS n
        FROM events, (VALUES ('first'), ('second')) AS s(sink) GROUP BY ALL"""),
    "stream_fan_out_together": Entry(stream_fan_out_together, """
        SELECT sink, event_type, count(*) AS n
        FROM events, (VALUES ('all'), ('errors')) AS s(sink)
        WHERE sink = 'all' OR event_type = 'error' GROUP BY ALL"""),
    "stream_dedup": Entry(stream_dedup, """
        SELECT event_id, ts, user_id, event_type, value, props FROM events"""),
    "stream_new_only": Entry(stream_new_only, """
        SELECT event_id, ts, user_id, event_type, value, props FROM events"""),
    "stream_topic_window": Entry(stream_topic_window, f"""
        SELECT date_trunc('hour', ts) AS window_start,
            date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
            {given.EVENT_TOPIC_SQL} AS topic, count(*) AS n
        FROM events
        WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <=
            (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
        GROUP BY 1, 2, 3"""),
    "survey_stream": Entry(survey_stream, f"""
        SELECT lang AS country, 2024 AS year, text, CAST(n_chars % 90 AS INTEGER) AS age,
            source AS gender, {given.SENTIMENT_SQL} AS sentiment FROM documents"""),
    "indicator_stream": Entry(indicator_stream, """
        SELECT c_name AS country, c_nationkey AS year, c_acctbal AS unemployment_rate,
            CAST(NULL AS DOUBLE) AS youth_unemployment, sector, employment
        FROM customer, LATERAL (VALUES (c_mktsegment, c_acctbal),
            ('nation', CAST(c_nationkey AS DOUBLE))) AS m(sector, employment)"""),
    "scored_stream": Entry(scored_stream),
}
