import datetime

import pytest
from pyspark.sql import functions as F

from tidewire.operators import archive, dedup, recent
from tidewire.sources.sinks import BatchTable

START = datetime.datetime(2024, 1, 1)


def events(spark, pairs):
    """(minutes or None, id) rows."""
    rows = [(None if m is None else START + datetime.timedelta(minutes=m), i, f"text {i}")
            for m, i in pairs]
    return spark.createDataFrame(rows, "ts timestamp_ntz, event_id bigint, text string")


def ids(df):
    return [row.event_id for row in df.collect()]


def test_newest_with_ties(spark):
    df = events(spark, [(5, 1), (5, 2), (4, 3), (6, 0)])
    assert ids(recent.latest_n(df, 3)) == [0, 2, 1]
    assert ids(recent.oldest_first(recent.latest_n(df, 3))) == [1, 2, 0]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9])
def test_newest_with_missing_times(spark, n):
    df = events(spark, [(None, 7), (500, 1), (None, 8), (2, 2), (501, 3)])
    assert ids(recent.latest_n(df, n)) == [3, 1, 2, 8, 7][:n]


def test_newest_by_id(spark):
    assert ids(recent.latest_n(events(spark, [(5, 1), (1, 9), (3, 4)]), 2, ts=None)) == [9, 4]


def test_newest_of_nothing(spark):
    assert ids(recent.latest_n(events(spark, []), 5)) == []


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_newest_equals_plain_sort_with_a_crowded_hour(spark, kind):
    df = spark.range(5000).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(1704067200 + F.when(F.col("id") % 3 == 0, 360000 + F.col("id") % 7)
                            .otherwise(F.col("id") * 97 % 720000)).cast(kind).alias("ts"))
    for n in (10, 700, 1900, 6000):
        wanted = df.orderBy(F.desc("ts"), F.desc("event_id")).limit(n)
        assert ids(recent.latest_n(df, n)) == ids(wanted)
        finer = recent.since_newest(df, n, refine_above=1)
        assert finer.count() == min(n, 5000)
        assert ids(recent.newest_first(finer, n)) == ids(wanted)


def test_cutoff_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    events(spark, [(60 * i, i) for i in range(300)]).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = recent.latest_n(stored, 10)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-13T" in plan
    assert "TakeOrderedAndProject" in plan


def test_dedup_goldens(spark):
    target = events(spark, [(0, 1), (1, 2)])
    incoming = events(spark, [(1, 2), (2, 3), (2, 3), (3, 4)])
    new = dedup.dedup_new(incoming, target)
    assert sorted(ids(new)) == [3, 4]
    stored = target.unionByName(new)
    assert ids(dedup.dedup_new(incoming, stored)) == []


def test_first_copy_wins_by_order(spark):
    df = spark.createDataFrame([(1, 5, "late"), (1, 2, "early"), (2, 1, "only")],
                               "event_id int, at int, text string")
    rows = dedup.one_per_id(df, "event_id", order="at").orderBy("event_id").collect()
    assert [tuple(r) for r in rows] == [(1, 2, "early"), (2, 1, "only")]


def test_retained_set_with_a_flood_of_copies(spark):
    """A third of all rows are copies of one id; the result must still hold n distinct ids."""
    singles = spark.range(6000).select(
        F.timestamp_seconds(1704067200 + F.col("id") * 60).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("event_id"))
    flood = spark.range(3000).select(
        F.lit("2024-01-05 03:58:00").cast("timestamp_ntz").alias("ts"),
        F.lit(5998).cast("bigint").alias("event_id"))
    everything = singles.filter("event_id <> 5998").unionByName(flood)
    for n in (1, 2, 3, 500):
        kept = sorted(ids(dedup.retain_latest(everything, n=n)), reverse=True)
        assert kept == list(range(5999, 5999 - n, -1))
    assert len(ids(dedup.retain_latest(everything, everything, n=10_000))) == 6000


def test_retained_set_when_copies_move_in_time(spark):
    """The sketch counts an id once per hour, so it promises too much; the exact count decides."""
    df = events(spark, [(60 * h, 1) for h in range(50)] + [(0, 2), (1, 3)])
    assert sorted(ids(dedup.retain_latest(df, n=3))) == [1, 2, 3]


def test_archive_goldens(spark):
    live = events(spark, [(0, 1), (1, 2), (2, 3)])
    snapshot = archive.fix_snapshot(live)
    later = live.unionByName(events(spark, [(3, 4)]))
    stored = events(spark, [(0, 1)])
    move = archive.archive_move(later, stored, snapshot)
    assert sorted(ids(move.moved)) == [2, 3] and ids(move.remaining) == [4]
    after = stored.unionByName(move.moved)
    again = archive.archive_move(move.remaining, after, snapshot)
    assert ids(again.moved) == [] and ids(again.remaining) == [4]
    assert after.count() + move.remaining.count() == 4


def test_archive_keeps_rows_without_id_live(spark):
    live = events(spark, [(0, 1), (1, None)])
    move = archive.archive_move(live, events(spark, []), live)
    assert ids(move.moved) == [1] and ids(move.remaining) == [None]


def test_archiving_whole_batches(spark):
    live, stored = BatchTable("live_messages"), BatchTable("archived_messages")
    for batch in range(3):
        live(events(spark, [(batch, 10 * batch + k) for k in range(4)]), batch)
    live(events(spark, [(0, k) for k in range(4)]), 0)  # a replay
    assert spark.table("live_messages").count() == 12
    stored(events(spark, [(0, 99)]), 900)
    snapshot = archive.live_batches(spark, "live_messages")
    assert snapshot == [("none", 0), ("none", 1), ("none", 2)]
    live(events(spark, [(9, 777)]), 3)  # arrives after the snapshot
    assert archive.archive_batches(
        spark, "live_messages", "archived_messages", snapshot) == snapshot
    assert ids(spark.table("live_messages")) == [777]
    assert spark.table("archived_messages").count() == 13
    assert archive.archive_batches(spark, "live_messages", "archived_messages", snapshot) == []
    assert spark.table("archived_messages").count() == 13


def test_batches_of_two_queries_stay_apart(spark):
    live = BatchTable("live_two")
    key = "sql.streaming.queryId"
    before = spark.sparkContext.getLocalProperty(key)
    try:
        for query, rows in (("q1", 30), ("q2", 10)):
            spark.sparkContext.setLocalProperty(key, query)
            live(events(spark, [(0, k) for k in range(rows)]), 0)
    finally:
        spark.sparkContext.setLocalProperty(key, before)
    assert spark.table("live_two").count() == 40
    BatchTable("archived_two")(events(spark, [(0, 99)]), 900)
    assert archive.archive_batches(spark, "live_two", "archived_two") == [("q1", 0), ("q2", 0)]
    assert spark.table("archived_two").count() == 41 and spark.table("live_two").isEmpty()


def test_exact_cut_keeps_rows_without_id(spark):
    rows = events(spark, [(5, 1), (5, None), (5, None), (4, 2)])
    for n in (1, 2, 3):
        left = recent.since_newest(rows, n, "ts", "event_id", refine_above=0)
        assert recent.newest_first(left, n).count() == n


def test_rows_without_id_are_not_copies(spark):
    incoming = events(spark, [(1, None), (2, None), (3, 7), (3, 7)])
    assert dedup.dedup_new(incoming, events(spark, [])).count() == 3
    assert ids(dedup.retain_latest(incoming.unionByName(events(spark, [(1, 1), (0, 2)])), n=3)) == [
        1, 2, 7]


def test_a_set_that_holds_all_is_not_ranked_in_one_task(spark):
    """Copies collapse, rows without a time stay, and no limit sorts the ids in one place."""
    df = events(spark, [(0, 1), (0, 1), (1, 2), (None, 3), (2, None)])
    for n, left in ((2, [1, 2]), (3, [1, 2, 3]), (9, [1, 2, 3])):
        kept = dedup.retain_latest(df, n=n)
        assert sorted(ids(kept)) == left and kept.columns == df.columns
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert ("Limit" in plan) == (n < 3)
