"""State kept between batches: seen ids, partial counts, the newest set, message ids, null rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidewire.operators import dedup, metrics, series
from tidewire.operators.dedup import retain_latest
from tidewire.plans import boards
from tidewire.plans import streams as plans
from tidewire.sources import messages
from tidewire.sources.sinks import BatchFolders, read_batches, write_lines
from tidewire.streaming import partials, queries
from tidewire.streaming.newest import NewestSet
from tidewire.streaming.seen import SeenIds

ONCE = {"availableNow": True}
START = datetime.datetime(2024, 1, 1)
EVENT = "event_id long, ts timestamp, kind string"


def events(spark, ids, kind="k"):
    return spark.createDataFrame(
        [(n, START + datetime.timedelta(minutes=n or 0), kind) for n in ids], EVENT)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def test_seen_ids_are_found_and_few_files_read(spark, folder):
    """Twelve segments, then copies of one of them, then new ids: under a tenth is read."""
    index = SeenIds(f"{folder}/index", buckets=4)
    assert index.seen(events(spark, [1])).count() == 0 and index.files(spark) == []
    for step in range(12):
        index.add(events(spark, range(step * 100, step * 100 + 100)), f"first-{step}")
    stored = index.files(spark)
    assert len(stored) == 48
    found = index.seen(events(spark, [*range(300, 400), *range(5000, 5050), None, 300]))
    assert sorted(r[0] for r in found.collect()) == list(range(300, 400))
    assert {path.split("segment=")[1].split("/")[0] for path in index.read} == {"first-3"}
    assert 0 < len(index.read) < len(stored) / 10 and set(index.read) <= set(stored)
    assert index.seen(events(spark, range(9000, 9100))).count() == 0 and index.read == []
    # a replayed batch does not see its own earlier attempt
    assert index.seen(events(spark, range(300, 400)), but="first-3").count() == 0
    assert len(index.files(spark)) == 48


def test_filters_of_all_sizes_miss_nothing(spark, folder):
    index = SeenIds(f"{folder}/index", bits_each=24)
    ids = spark.range(7000).select(F.col("id").alias("event_id"))
    index.add(ids.filter("event_id < 5000"), "large")
    index.add(ids.filter("event_id >= 5000 AND event_id < 5010"), "small")
    index.add(ids.filter("event_id < 0"), "none")
    found = index.seen(ids)
    assert found.count() == 5010 == found.distinct().count()
    false = spark.range(10_000, 30_000).select(F.col("id").alias("event_id"))
    assert index.seen(false).count() == 0


def test_filter_words_hold_the_bits_of_their_ids(spark, folder):
    """Every block has all its words in order, and bits are looked up without a loop over arrays."""
    index = SeenIds(f"{folder}/index", probes=3)
    ids = spark.range(3000).select((F.col("id") * 7).alias("event_id"))
    index.add(ids, "one")
    rows = index._filters(spark, None).collect()
    assert sorted(r.block for r in rows) == [0, 1, 2, 3] and {r.blocks for r in rows} == {4}
    places = F.array(*index._places())
    want = {}
    for block, some in index._hashed(ids).select(F.pmod("_h", F.lit(4)), places).collect():
        want.setdefault(block, set()).update(some)
    for row in rows:
        assert len(row.words) == 512
        assert {64 * at + bit for at, word in enumerate(row.words) for bit in range(64)
                if word >> bit & 1} == want[row.block]
    assert "lambda" not in str(places) and "lambda" not in str(index._held())


def test_new_only_with_an_index(spark, folder):
    write_to = BatchFolders(f"{folder}/out")
    index = SeenIds(f"{folder}/index", buckets=2)
    write = queries.NewOnly(write_to, events(spark, []).schema, index=index)
    write(events(spark, [1, 2, 3, 3, None, None]), 0)
    write(events(spark, [3, 4]), 1)
    write(events(spark, [3, 4]), 1)  # replayed
    write(events(spark, [1, 2, 3, 4]), 2)
    stored = read_batches(spark, f"{folder}/out", events(spark, []).schema)
    assert sorted(str(r.event_id) for r in stored.collect()) == ["1", "2", "3", "4", "None", "None"]


def test_partial_counts_add_up_in_any_order_and_after_a_replay(spark, folder):
    write = partials.PartialCounts(BatchFolders(f"{folder}/counts"), {"kind": F.col("kind")},
                                   width="1 minute")
    late = [events(spark, [100, 101, 101], "b"), events(spark, [0, 1, 100]),
            spark.createDataFrame([(7, None, "k")], EVENT), events(spark, [1], "b")]
    for number, batch in enumerate([*late, late[0]]):
        write(batch, number % 4)  # the last repeats batch 0
    schema = write.counted(late[0]).schema
    merged = partials.merged_counts(spark, write.folders, schema)
    everything = late[0].union(late[1]).union(late[2]).union(late[3])
    assert sorted(map(str, merged.collect())) == sorted(map(str, write.counted(everything).collect()))
    hourly = {(r.kind, r.bucket_start): r.n for r in partials.coarser(merged, "1 hour").collect()}
    assert hourly == {("k", START): 2, ("k", START + datetime.timedelta(hours=1)): 1, ("k", None): 1,
                      ("b", START): 1, ("b", START + datetime.timedelta(hours=1)): 3}
    into = BatchFolders(f"{folder}/compact")
    for _ in range(2):
        partials.compact(spark, write.folders, into, schema, [0, 1], 0)
    partials.compact(spark, write.folders, into, schema, [2, 3], 1)
    again = partials.merged_counts(spark, into, schema)
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_the_newest_set_equals_retain_latest_after_every_batch(spark, folder):
    batches = [[5, 1, 9, 9, 2, 3], [9, 30, None], [4, 31, 1, 32], [33]]
    newest = NewestSet(f"{folder}/newest", events(spark, []).schema, n=5)
    assert newest.read(spark).count() == 0
    so_far = None
    for number, ids in enumerate(batches):
        batch = events(spark, ids)
        newest(batch, number)
        so_far = batch if so_far is None else so_far.union(batch)
        if number == 1:
            newest(batch, number)  # replayed
        want = sorted(map(str, retain_latest(so_far, n=5).collect()))
        assert sorted(map(str, newest.read(spark).collect())) == want
    assert len(newest._sets(newest._stored(spark))) == newest.keep


def test_a_repeated_id_moves_up(spark, folder):
    newest = NewestSet(f"{folder}/newest", events(spark, []).schema, n=2)
    newest(events(spark, [1, 2, 3]), 0)
    newest(spark.createDataFrame([(1, START + datetime.timedelta(days=1), "again")], EVENT), 1)
    assert {(r.event_id, r.kind) for r in newest.read(spark).collect()} == {(1, "again"), (3, "k")}


def test_places_in_line_files_are_ids(spark, folder):
    import os

    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.json", "wb") as file:
        file.write(b'{"text": "same"}\n{"text": "same"}\r\n\n{"text": "other"}')
    with open(f"{folder}/in/b.json", "wb") as file:
        file.write(b'{"text": "same"}\n')
    open(f"{folder}/in/c.json", "wb").close()
    read = messages.read_messages(spark, messages.LineFiles(f"{folder}/in"), position=True)
    parsed = plans.tagged_surveys(read)
    assert parsed.columns[0] == messages.MESSAGE_ID
    queries.run_to_end(queries.for_each_batch(
        parsed, BatchFolders(f"{folder}/out"), f"{folder}/checkpoint", trigger=ONCE))
    stored = read_batches(spark, f"{folder}/out", parsed.schema)
    ids = sorted((r.message_id.rsplit("/")[-1], r.text) for r in stored.collect())
    assert ids == [("a.json:000000000000", "same"), ("a.json:000000000001", "same"),
                   ("a.json:000000000002", None), ("a.json:000000000003", "other"),
                   ("b.json:000000000000", "same")]
    board = boards.MessageBoard(stored, ts="processed_time", id=messages.MESSAGE_ID)
    assert board.kpis().first().total == 5


def test_line_files_stay_small_and_keep_every_message(spark, folder):
    import os

    payloads = spark.range(3000).select(
        F.concat(F.lit('{"text": "same", "age": '), F.col("id") % 50, F.lit("}"))
        .cast("binary").alias("value"))
    files = write_lines(payloads, f"{folder}/in", 3, file_bytes=4096)
    sizes = [os.path.getsize(f"{folder}/in/{name}") for name in os.listdir(f"{folder}/in")
             if name.endswith(".txt")]
    assert files == len(sizes) == -(-sum(sizes) // 4096) and max(sizes) < 2 * 4096
    read = messages.read_messages(spark, messages.LineFiles(f"{folder}/in"), position=True)
    queries.run_to_end(queries.for_each_batch(
        read, BatchFolders(f"{folder}/out"), f"{folder}/checkpoint", trigger=ONCE))
    stored = read_batches(spark, f"{folder}/out", read.schema)
    assert stored.count() == stored.select(messages.MESSAGE_ID).distinct().count() == 3000
    assert stored.groupBy("value").count().agg(F.min("count"), F.max("count")).first() == (60, 60)
    assert write_lines(payloads.limit(0), f"{folder}/none", 3) == 3


def test_places_in_a_topic_sort_as_they_arrived(spark):
    rows = spark.createDataFrame([(b"x", "t", 2, 10), (b"x", "t", 2, 9), (b"x", "t", 11, 1)],
                                 "value binary, topic string, partition int, offset long")
    ids = [r[0] for r in rows.select(messages.topic_position()).collect()]
    assert len(set(ids)) == 3 and ids[1] < ids[0] < ids[2]


def untimed(spark):
    return spark.createDataFrame(
        [(1, START, "k"), (2, START, "k"), (3, None, "k"), (4, None, "k"),
         (5, START + datetime.timedelta(hours=30), "k"), (6, None, "only")], EVENT)


def test_rows_without_a_time_are_counted(spark):
    df = untimed(spark)
    rates = {r.window_start: r.n for r in metrics.rate_per_window(df).collect()}
    assert rates == {START: 2, None: 3, START + datetime.timedelta(hours=30): 1}
    assert metrics.peak_rate(df).first() == (2, START)
    counts = series.bucket_counts(df, "kind")
    assert sum(r.n for r in counts.collect()) == 6
    filled = series.bucket_counts(df, "kind", fill_gaps=True)
    assert sum(r.n for r in filled.collect()) == 6 and filled.count() == 31 + 2
    history = {(r.series, r.position): r.n for r in series.series_history(counts).collect()}
    assert history == {("k", 0): 2, ("k", 1): 1, ("k", None): 2, ("only", None): 1}
    padded = {(r.series, r.position): r.n for r in series.series_history(counts, pad=1).collect()}
    assert padded == {("k", 0): 0, ("k", 1): 2, ("k", 2): 1, ("k", None): 2, ("only", None): 1}
    assert series.spike_alerts(counts).count() == 2
    assert {r.series for r in series.linear_forecast(counts).collect()} == {"k"}
    flow = [(r.bucket_start, r.n, r.cumulative) for r in
            series.cumulative_flow(df).orderBy("cumulative").collect()]
    assert flow == [(START, 2, 2), (START + datetime.timedelta(hours=30), 1, 3), (None, 3, 6)]


def test_rows_without_an_id_are_kept_in_one_pass(spark):
    df = events(spark, [1, 1, 2, None, None])
    once = dedup.one_per_id(df, "event_id")
    assert sorted(str(r.event_id) for r in once.collect()) == ["1", "2", "None", "None"]
    assert once.columns == df.columns
    ordered = dedup.one_per_id(df, "event_id", "ts")
    assert sorted(str(r.event_id) for r in ordered.collect()) == ["1", "2", "None", "None"]
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
