"""Streams in several steps whose stored state is read back: seen ids, partial counts, newest sets."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewire import schemas
from tidewire.operators import metrics, recent, series
from tidewire.plans import boards
from tidewire.plans import streams as plans
from tidewire.registry import Entry
from tidewire.registry import inputs as given
from tidewire.registry import messages, time_series
from tidewire.registry.inputs import table
from tidewire.session import scratch_folder
from tidewire.sources.messages import (
    MESSAGE_ID,
    LineFiles,
    TableFiles,
    read_messages,
    read_table_stream,
)
from tidewire.sources.sinks import BatchFolders, encode_json, read_batches, write_lines
from tidewire.streaming import partials, queries, stateful
from tidewire.streaming.newest import NewestSet
from tidewire.streaming.progress import ProgressTable
from tidewire.streaming.seen import SeenIds

ONCE = {"availableNow": True}
STEPS = 3


def _in_steps(spark, events, base, by, steps=STEPS):
    """Events as a stream of some batches, cut by ranges of a column."""
    events.repartitionByRange(steps, by).write.parquet(f"{base}/in")
    return read_table_stream(spark, TableFiles(
        f"{base}/in", events.schema, options={"maxFilesPerTrigger": "1"}))


def _shuffled(spark, folder, base):
    """Events in an order that has nothing to do with their time."""
    return _in_steps(spark, table(spark, folder, "events"), base, F.xxhash64("event_id"))


def stream_seen_index(spark, folder):
    """Three full deliveries, each in steps; only ids that the index names are read."""
    base = scratch_folder(spark, "seen")
    events = table(spark, folder, "events")
    df = _in_steps(spark, events, base, "event_id", 2)
    write = queries.NewOnly(BatchFolders(f"{base}/out"), df.schema,
                            index=SeenIds(f"{base}/index", "event_id"))
    for delivery in ("first", "second", "third"):
        queries.run_to_end(queries.for_each_batch(df, write, f"{base}/{delivery}", trigger=ONCE))
    return read_batches(spark, f"{base}/out", df.schema)


def _merged(spark, folder, width):
    base = scratch_folder(spark, "partials")
    topic = {"event_type": F.col("event_type")}
    write = partials.PartialCounts(BatchFolders(f"{base}/counts"), topic, width=width)
    queries.run_to_end(queries.for_each_batch(
        _shuffled(spark, folder, base), write, f"{base}/checkpoint", trigger=ONCE))
    schema = write.counted(table(spark, folder, "events")).schema
    return partials.merged_counts(spark, write.folders, schema)


def stream_counts_late(spark, folder):
    """Messages per hour and type from a stream without order and without a watermark."""
    return _merged(spark, folder, "1 hour").select("bucket_start", "event_type", "n")


def stream_history_late(spark, folder):
    """Histories per hour from counts that were kept per minute."""
    hourly = partials.coarser(_merged(spark, folder, "1 minute"), "1 hour")
    return series.series_history(partials.as_series(hourly, "event_type"))


def stream_retained(spark, folder):
    """The newest distinct messages after a stream without order."""
    base = scratch_folder(spark, "newest")
    df = _shuffled(spark, folder, base)
    newest = NewestSet(f"{base}/newest", df.schema)
    queries.run_to_end(queries.for_each_batch(df, newest, f"{base}/checkpoint", trigger=ONCE))
    return recent.oldest_first(newest.read(spark))


def stream_dedup_nulls(spark, folder):
    """Every event delivered twice, one in ten without an id: those are no copies of one another."""
    base = scratch_folder(spark, "dedup_nulls")
    events = read_table_stream(spark, TableFiles(
        given.stream_path(folder, "events"), table(spark, folder, "events").schema)).withColumns({
            "ts": F.col("ts").cast("timestamp"),
            "event_id": F.when(F.col("event_id") % 10 != 0, F.col("event_id"))})
    df = stateful.dedup_stream(events.unionByName(events))
    queries.run_to_end(queries.append_to(df, f"{base}/checkpoint", path=f"{base}/out",
                                         trigger=ONCE))
    return spark.read.schema(df.schema).parquet(f"{base}/out").groupBy(
        F.col("event_id").isNull().alias("no_id"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_ids"))


SPLITS = ("2024-01-20 00:00:00", "2024-01-10 00:00:00")


def stream_progress(spark, folder):
    """Rows read and rows too late for the watermark, over three runs that go back in time."""
    base = scratch_folder(spark, "progress")
    events = table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp"))
    new, old = [F.lit(split).cast("timestamp") for split in SPLITS]
    parts = (F.col("ts") >= new, (F.col("ts") < new) & (F.col("ts") >= old), F.col("ts") < old)
    with ProgressTable(spark, f"{base}/progress") as progress:
        for part in parts:
            events.filter(part).write.mode("append").parquet(f"{base}/in")
            df = read_table_stream(spark, TableFiles(f"{base}/in", events.schema))
            kept = df.withWatermark("ts", "10 minutes").dropDuplicates(["event_id", "ts"])
            progress.settle(queries.run_to_end(queries.append_to(
                kept, f"{base}/checkpoint", path=f"{base}/out", trigger=ONCE)))
        return progress.read().agg(F.sum("row_count").alias("row_count"),
                                   F.sum("dropped_late").alias("dropped_late"))


def _sent(spark, payloads, base):
    """Payloads as a stream of some batches of line files, with the id of their place."""
    files = write_lines(payloads, f"{base}/in", STEPS)
    return read_messages(spark, LineFiles(f"{base}/in", {
        "maxFilesPerTrigger": str(-(-files // STEPS))}), position=True)


def _surveys(spark, folder, base):
    """Documents as survey messages in line files, tagged and stored with the id of their place."""
    documents = table(spark, folder, "documents").select(
        F.col("lang").alias("country"), F.lit(2024).alias("year"), "text",
        (F.col("n_chars") % 90).cast("int").alias("age"), F.col("source").alias("gender"))
    sent = _sent(spark, encode_json(documents), base)
    queries.run_to_end(plans.run_surveys(sent, BatchFolders(f"{base}/out"),
                                         f"{base}/checkpoint", given.GLAD, given.SAD, trigger=ONCE))
    return read_batches(spark, f"{base}/out",
                        plans.tagged_surveys(sent, given.GLAD, given.SAD).schema)


def stream_durable_ids(spark, folder):
    """Messages and their ids by country: equal texts stay two messages."""
    stored = _surveys(spark, folder, scratch_folder(spark, "ids"))
    return stored.groupBy("country").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(MESSAGE_ID).alias("n_ids"))


def survey_board(spark, folder):
    """From payloads to the board: the survey job's output, read as messages."""
    stored = _surveys(spark, folder, scratch_folder(spark, "survey_board"))
    return boards.MessageBoard(stored, ts="processed_time", id=MESSAGE_ID,
                               retained=stored.count()).kpis()


def stream_dead_letters(spark, folder):
    """The survey job on payloads of which one in seven is no JSON and one in eleven has text for
    a number: what is stored by country, and the rejected payloads by kind."""
    base = scratch_folder(spark, "dead")
    number = F.when(F.col("doc_id") % 11 == 0, F.lit('"x"')).otherwise("7")
    payload = F.when(F.col("doc_id") % 7 == 0, "not json").otherwise(F.concat(
        F.lit('{"country": "'), "lang", F.lit('", "text": "t", "age": '), number, F.lit("}")))
    sent = _sent(spark, table(spark, folder, "documents").select(payload.alias("value")), base)
    out, dead = BatchFolders(f"{base}/out"), BatchFolders(f"{base}/dead")
    queries.run_to_end(plans.run_surveys(sent, out, f"{base}/checkpoint", given.GLAD, given.SAD,
                                         trigger=ONCE, dead=dead))
    stored = read_batches(spark, out.path, plans.tagged_surveys(sent).schema)
    payloads = read_batches(spark, dead.path, StructType([
        StructField(MESSAGE_ID, StringType()), StructField(plans.PAYLOAD, StringType())]))
    kind = F.when(F.col(plans.PAYLOAD) == "not json", "broken").otherwise("mistyped")
    parts = [stored.select(F.lit("stored").alias("place"), F.col("country").alias("kind"),
                           MESSAGE_ID),
             payloads.select(F.lit("rejected").alias("place"), kind.alias("kind"), MESSAGE_ID)]
    return parts[0].unionByName(parts[1]).groupBy("place", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(MESSAGE_ID).alias("n_ids"))


def social_board(spark, folder):
    """From payloads to the board: the social job's output with star labels, by topic and side."""
    base = scratch_folder(spark, "social_board")
    documents = table(spark, folder, "documents").select(
        "text", "source", F.col("lang").alias("country"),
        F.lit("2024-01-01 00:00:00").alias("timestamp"))
    sent = _sent(spark, encode_json(documents), base)
    queries.run_to_end(plans.run_social(
        sent, messages.quality_model(spark, folder), ("1 star", "5 stars"),
        [BatchFolders(f"{base}/out")], f"{base}/checkpoint", trigger=ONCE))
    stored = read_batches(spark, f"{base}/out", StructType([
        StructField(MESSAGE_ID, StringType()), *schemas.SCORED_MESSAGE.fields]))
    board = boards.Situation(stored, boards.SituationRules(topics=given.TOPICS),
                             ts="processed_at", id=MESSAGE_ID)
    sides = metrics.kpi_summary(board.current)
    return board.topics().withColumns({
        "total": board.total().scalar(),
        "n_sided": sides.select(F.col("positive_count") + F.col("negative_count")).scalar(),
        "both_sides": sides.select(F.least("positive_count", "negative_count") > 0).scalar()})


_TAGGED = f"(SELECT {given.SENTIMENT_SQL} AS sentiment FROM documents)"

ENTRIES = {
    "stream_seen_index": Entry(stream_seen_index, """
        SELECT event_id, ts, user_id, event_type, value, props FROM events"""),
    "stream_counts_late": Entry(stream_counts_late, """
        SELECT date_trunc('hour', ts) AS bucket_start, event_type, count(*) AS n FROM events
        GROUP BY 1, 2"""),
    "stream_history_late": Entry(stream_history_late, time_series.ENTRIES["series_history"].sql),
    "stream_retained": Entry(stream_retained, """
        SELECT event_id, ts, user_id, event_type, value, props FROM events
        ORDER BY ts DESC, event_id DESC LIMIT 500"""),
    "stream_dedup_nulls": Entry(stream_dedup_nulls, """
        SELECT event_id % 10 = 0 AS no_id, event_type,
            CASE WHEN event_id % 10 = 0 THEN 2 * count(*) ELSE count(*) END AS n,
            CASE WHEN event_id % 10 = 0 THEN 0 ELSE count(DISTINCT event_id) END AS n_ids
        FROM events GROUP BY event_id % 10 = 0, event_type"""),
    "stream_durable_ids": Entry(stream_durable_ids, """
        SELECT lang AS country, count(*) AS n, count(*) AS n_ids FROM documents GROUP BY lang"""),
    "stream_progress": Entry(stream_progress, f"""
        SELECT count(*) AS row_count, count(*) FILTER (ts < TIMESTAMP '{SPLITS[0]}'
            AND ts <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)) AS dropped_late
        FROM events"""),
    "stream_dead_letters": Entry(stream_dead_letters, """
        SELECT CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 THEN 'rejected' ELSE 'stored' END
                AS place,
            CASE WHEN doc_id % 7 = 0 THEN 'broken' WHEN doc_id % 11 = 0 THEN 'mistyped'
                ELSE lang END AS kind, count(*) AS n, count(*) AS n_ids
        FROM documents GROUP BY 1, 2"""),
    "social_board": Entry(social_board, f"""
        SELECT count(*) FILTER (topic = 'Work') AS work, count(*) FILTER (topic = 'Worry') AS worry,
            count(*) FILTER (topic = 'Money') AS money, count(*) AS total, count(*) AS n_sided,
            TRUE AS both_sides
        FROM (SELECT {given.TOPIC_SQL} AS topic FROM documents)"""),
    "survey_board": Entry(survey_board, f"""
        SELECT count(*) AS total, count(*) FILTER (sentiment = 'positive') AS positive_count,
            count(*) FILTER (sentiment = 'negative') AS negative_count,
            count(*) FILTER (sentiment = 'neutral') AS neutral_count,
            round(CASE WHEN count(*) > 0 THEN 100::DOUBLE * count(*)
                FILTER (sentiment = 'positive') / count(*) ELSE 0 END, 1) AS positivity_index
        FROM {_TAGGED}"""),
}
