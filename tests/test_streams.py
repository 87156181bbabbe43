import datetime
import logging

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.functions import polarity
from tidewire.operators import prepare
from tidewire.plans import streams as plans
from tidewire.sources import messages, sinks
from tidewire.streaming import queries, stateful

ONCE = {"availableNow": True}
START = datetime.datetime(2024, 1, 1)


def write_events(spark, path, first, last, files=1):
    """Events of one minute apart, id = minute."""
    (spark.range(first, last, 1, files).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(1704067200 + F.col("id") * 60).alias("ts"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("kind"))
     .write.mode("append").parquet(path))


def stream(spark, path, per_batch=1):
    schema = spark.read.parquet(path).schema
    return messages.read_table_stream(spark, messages.TableFiles(
        path, schema, options={"maxFilesPerTrigger": str(per_batch)}))


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def test_kafka_options():
    topic = messages.KafkaTopic("host:9092", "t", "earliest", {"maxOffsetsPerTrigger": "5"})
    assert topic.reader_options() == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "t", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5"}
    assert plans.social_source("h").reader_options()["startingOffsets"] == "latest"
    assert plans.survey_source("h").reader_options()["subscribe"] == "mental_health_live"
    assert plans.employment_source("h").reader_options()["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        messages.KafkaTopic("h", "t", "yesterday")


def test_store_options():
    options = sinks.document_store("mongodb://host", "db", "c", "event_id")
    assert options["operationType"] == "replace" and options["idFieldList"] == "event_id"


def test_a_checkpoint_is_required(spark, folder):
    write_events(spark, f"{folder}/in", 0, 3)
    with pytest.raises(ValueError):
        queries.append_to(stream(spark, f"{folder}/in"), "", path=f"{folder}/out")


def test_line_messages_through_the_survey_job(spark, folder):
    lines = ['{"country":"Egypt","year":2020,"text":"أنا سعيد","age":30,"gender":"f"}',
             "broken", '{"text":"الوضع صعب","age":"old"}']
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(f"{folder}/in")
    tagged = plans.tagged_surveys(messages.read_messages(
        spark, messages.LineFiles(f"{folder}/in")))
    queries.run_to_end(queries.append_to(tagged, f"{folder}/c", path=f"{folder}/out",
                                         trigger=ONCE))
    rows = spark.read.parquet(f"{folder}/out").collect()
    assert {(r.text, r.age, r.sentiment) for r in rows} == {
        ("أنا سعيد", 30, "positive"), (None, None, "neutral"), ("الوضع صعب", None, "negative")}
    assert all(r.processed_time for r in rows)


def test_payload_round_trip(spark):
    rows = [("Egypt", 2020, None, 30, "f"), ("Oman", None, 'say "hi"\n', None, None)]
    df = spark.createDataFrame(rows, schemas.SURVEY_MESSAGE)
    sent = sinks.encode_json(df)
    assert dict(sent.dtypes) == {"value": "binary"}
    text = messages.decode(sent)
    assert '"text":null' in text.first().json
    assert sorted(map(tuple, prepare.json_parse(text, schemas.SURVEY_MESSAGE).collect())) == sorted(
        rows)


def test_resume_without_loss_or_copies(spark, folder):
    write_events(spark, f"{folder}/in", 0, 750, 3)
    writer = sinks.BatchFolders(f"{folder}/out")

    def run():
        df = stream(spark, f"{folder}/in")
        return queries.run_to_end(queries.for_each_batch(df, writer, f"{folder}/c", trigger=ONCE))

    first = run()
    write_events(spark, f"{folder}/in", 750, 1000)
    second = run()
    assert first.id == second.id
    schema = spark.read.parquet(f"{folder}/in").schema
    stored = sinks.read_batches(spark, f"{folder}/out", schema)
    assert stored.count() == 1000 and stored.select("event_id").distinct().count() == 1000


def test_a_failing_writer_stops_the_query_and_nothing_is_lost(spark, folder):
    write_events(spark, f"{folder}/in", 0, 300, 3)
    writer = sinks.BatchFolders(f"{folder}/out")
    broken = [True]

    def flaky(batch, batch_id):
        if batch_id == 1 and broken[0]:
            writer(batch, batch_id)  # fails after the write, before the commit
            raise RuntimeError("no store")
        writer(batch, batch_id)

    def run():
        return queries.run_to_end(queries.for_each_batch(
            stream(spark, f"{folder}/in"), flaky, f"{folder}/c", trigger=ONCE))

    with pytest.raises(StreamingQueryException):
        run()
    broken[0] = False
    run()
    stored = sinks.read_batches(spark, f"{folder}/out",
                                spark.read.parquet(f"{folder}/in").schema)
    assert stored.count() == 300 and stored.distinct().count() == 300


def test_a_new_checkpoint_does_not_overwrite_an_older_run(spark, folder):
    write_events(spark, f"{folder}/in", 0, 10)
    writer = sinks.BatchFolders(f"{folder}/out")
    for checkpoint in ("one", "two"):
        queries.run_to_end(queries.for_each_batch(
            stream(spark, f"{folder}/in"), writer, f"{folder}/{checkpoint}", trigger=ONCE))
    schema = spark.read.parquet(f"{folder}/in").schema
    assert sinks.read_batches(spark, f"{folder}/out", schema).count() == 20


def test_empty_batches_write_nothing(spark, folder):
    write_events(spark, f"{folder}/in", 0, 10)
    df = stream(spark, f"{folder}/in").filter("event_id < 0")
    calls = []
    queries.run_to_end(queries.for_each_batch(
        df, lambda batch, batch_id: calls.append(batch_id), f"{folder}/c", trigger=ONCE))
    assert calls == []
    schema = spark.read.parquet(f"{folder}/in").schema
    assert sinks.read_batches(spark, f"{folder}/nothing", schema).count() == 0


def test_watched_batches(spark, folder, caplog):
    write_events(spark, f"{folder}/in", 0, 90, 3)
    watched = queries.Watched(sinks.BatchFolders(f"{folder}/out"),
                              sinks.BatchFolders(f"{folder}/metrics"))
    with caplog.at_level(logging.INFO, logger="tidewire"):
        queries.run_to_end(queries.for_each_batch(
            stream(spark, f"{folder}/in"), watched, f"{folder}/c", trigger=ONCE))
    logged = sinks.read_batches(spark, f"{folder}/metrics", sinks.BATCH_METRICS).orderBy("batch_id")
    assert [(r.batch_id, r.row_count) for r in logged.collect()] == [(0, 30), (1, 30), (2, 30)]
    assert sum("Row(" in record.getMessage() for record in caplog.records) == 9


def test_watched_writer_without_folders(spark, folder, caplog):
    write_events(spark, f"{folder}/in", 0, 20, 1)
    counts = []
    watched = queries.Watched(lambda batch, batch_id: counts.append(batch.count()), sample=2)
    with caplog.at_level(logging.INFO, logger="tidewire"):
        queries.run_to_end(queries.for_each_batch(
            stream(spark, f"{folder}/in"), watched, f"{folder}/c", trigger=ONCE))
    assert counts == [20]
    assert sum("Row(" in record.getMessage() for record in caplog.records) == 2


def test_fan_out_computes_each_batch_once(spark, folder, capsys):
    write_events(spark, f"{folder}/in", 0, 60, 2)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(value):
        seen.add(1)
        return value

    df = stream(spark, f"{folder}/in").withColumn("twin", counted("event_id"))
    outs = [sinks.BatchFolders(f"{folder}/{name}") for name in "ab"]
    queries.run_to_end(queries.fan_out(df, [*outs, sinks.ConsoleWriter()], f"{folder}/c",
                                       trigger=ONCE))
    schema = df.schema
    assert [sinks.read_batches(spark, f"{folder}/{name}", schema).count() for name in "ab"] == [
        60, 60]
    # the check for an empty batch looks at one partition before the batch is kept
    assert seen.value <= 2 * 60
    assert "batch 0" in capsys.readouterr().out


def test_console(spark, folder):
    write_events(spark, f"{folder}/in", 0, 3)
    queries.run_to_end(queries.append_to(stream(spark, f"{folder}/in"), f"{folder}/c",
                                         format="console", trigger=ONCE))


def test_stream_equals_batch(spark, folder):
    write_events(spark, f"{folder}/in", 0, 200, 4)

    def shape(df):
        return df.select("event_id", polarity.lexicon_sentiment("kind", ("hot",), ("cold",))
                         .alias("sentiment"))

    queries.run_to_end(queries.append_to(shape(stream(spark, f"{folder}/in")), f"{folder}/c",
                                         path=f"{folder}/out", trigger=ONCE))
    wanted = shape(spark.read.parquet(f"{folder}/in"))
    got = spark.read.parquet(f"{folder}/out")
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_topic_windows_close_with_the_watermark(spark, folder):
    for first in range(0, 200, 50):  # files come in the order of their writing
        write_events(spark, f"{folder}/in", first, first + 50)
    windows = stateful.topic_windows(stream(spark, f"{folder}/in"), F.col("kind"))
    queries.run_to_end(queries.append_to(windows, f"{folder}/c", path=f"{folder}/out",
                                         trigger=ONCE))
    rows = {(r.window_start.hour, r.topic): r.n
            for r in spark.read.schema(windows.schema).parquet(f"{folder}/out").collect()}
    # the newest event is at 3:19, so the watermark is at 3:09 and the window from 3:00 stays open
    assert rows == {(h, t): n for h in range(3) for t, n in (("hot", 20), ("cold", 40))}


@pytest.mark.parametrize("spread", [1, 16])
def test_copies_within_the_delay_pass_once(spark, folder, spread):
    for _ in range(3):
        write_events(spark, f"{folder}/in", 0, 9, 2)
    (spark.range(200).select(F.lit(3).cast("bigint").alias("event_id"),
                             F.timestamp_seconds(F.lit(1704067200 + 180)).alias("ts"),
                             F.lit("hot").alias("kind"))
     .repartition(4).write.mode("append").parquet(f"{folder}/in"))
    df = stateful.dedup_stream(stream(spark, f"{folder}/in", 3), spread=spread)
    queries.run_to_end(queries.append_to(df, f"{folder}/c", path=f"{folder}/out", trigger=ONCE))
    rows = spark.read.parquet(f"{folder}/out").orderBy("event_id").collect()
    assert [r.event_id for r in rows] == list(range(9))


def test_dead_letters_beside_the_good_rows(spark, folder):
    lines = ['{"text":"a"}', "broken", '{"text":"b"}']
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(f"{folder}/in")
    parsed = prepare.json_parse(messages.decode(messages.read_messages(
        spark, messages.LineFiles(f"{folder}/in"))), schemas.SOCIAL_MESSAGE, rejects="payload")
    good, bad = sinks.BatchFolders(f"{folder}/good"), sinks.BatchFolders(f"{folder}/bad")
    queries.run_to_end(queries.fan_out(parsed, [
        lambda batch, i: good(prepare.accepted(batch, "payload"), i),
        lambda batch, i: bad(prepare.rejected(batch, "payload"), i)], f"{folder}/c", trigger=ONCE))
    assert spark.read.parquet(f"{folder}/good").count() == 2
    assert [r.payload for r in spark.read.parquet(f"{folder}/bad").collect()] == ["broken"]


@pytest.mark.parametrize("limits", [{}, {"ts": "ts", "horizon": "1 day"}])
def test_only_new_messages_are_stored_even_on_replay(spark, folder, limits):
    write_events(spark, f"{folder}/in", 0, 40)
    schema = spark.read.parquet(f"{folder}/in").schema
    new = queries.NewOnly(sinks.BatchFolders(f"{folder}/out"), schema, **limits)
    broken = [True]

    def flaky(batch, batch_id):
        new(batch, batch_id)
        if batch_id == 1 and broken[0]:
            broken[0] = False
            raise RuntimeError("lost after the write")

    def run():
        queries.run_to_end(queries.for_each_batch(
            stream(spark, f"{folder}/in"), flaky, f"{folder}/c", trigger=ONCE))

    run()
    write_events(spark, f"{folder}/in", 20, 60)  # half of them again
    with pytest.raises(StreamingQueryException):
        run()
    run()
    rows = sinks.read_batches(spark, f"{folder}/out", schema).orderBy("event_id").collect()
    assert [r.event_id for r in rows] == list(range(60))


def test_a_horizon_needs_a_time(spark):
    with pytest.raises(ValueError):
        queries.NewOnly(sinks.BatchFolders("x"), schemas.SURVEY_MESSAGE, horizon="1 day")
