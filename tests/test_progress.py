"""The table of batches that a listener keeps."""

import datetime

import pytest

from tidewire.session import write_once
from tidewire.sources.messages import TableFiles, read_table_stream
from tidewire.streaming import progress, queries

ONCE = {"availableNow": True}
START = datetime.datetime(2024, 1, 1)


def events(spark, minutes):
    return spark.createDataFrame([(n, START + datetime.timedelta(minutes=n)) for n in minutes],
                                 "id long, ts timestamp")


def run(spark, folder, kept, table):
    query = queries.run_to_end(queries.append_to(kept, f"{folder}/c", path=f"{folder}/out",
                                                 trigger=ONCE))
    table.settle(query)
    return query


def test_rows_state_and_late_rows_of_each_batch(spark, tmp_path):
    folder = str(tmp_path)
    with progress.ProgressTable(spark, f"{folder}/p") as table:
        assert table.read().isEmpty()
        ids = []
        for minutes in (range(100, 120), range(110, 130), range(0, 7)):
            events(spark, minutes).write.mode("append").parquet(f"{folder}/in")
            df = read_table_stream(spark, TableFiles(f"{folder}/in", events(spark, []).schema))
            kept = df.withWatermark("ts", "10 minutes").dropDuplicates(["id", "ts"])
            ids.append(str(run(spark, folder, kept, table).id))
        rows = sorted(table.read().collect(), key=lambda r: r.batch_id)
    assert {r.query_id for r in rows} == set(ids) and len(set(ids)) == 1
    assert [r.row_count for r in rows if r.row_count] == [20, 20, 7]
    assert len({r.batch_id for r in rows}) == len(rows)
    assert [r.dropped_late for r in rows if r.dropped_late] == [7]
    # 120 to 129 minutes are beyond the last watermark, 119
    assert rows[-1].state_rows == 10 and rows[-1].state_bytes > 0
    assert spark.read.parquet(f"{folder}/out").count() == 30
    # no longer registered
    before = table.read().count()
    events(spark, [500]).write.mode("append").parquet(f"{folder}/in")
    df = read_table_stream(spark, TableFiles(f"{folder}/in", events(spark, []).schema))
    queries.run_to_end(queries.append_to(
        df.withWatermark("ts", "10 minutes").dropDuplicates(["id", "ts"]), f"{folder}/c",
        path=f"{folder}/out", trigger=ONCE))
    assert table.read().count() == before


def test_a_batch_tried_again_is_reported_once(spark, tmp_path):
    table = progress.ProgressTable(spark, str(tmp_path))
    line = ('{{"query_id": "q", "run_id": "{}", "batch_id": {}, "at": "2024-01-01T00:0{}:00Z", '
            '"row_count": {}}}')
    for run_id, batch, at, n in (("a", 0, 1, 5), ("a", 1, 2, 3), ("b", 1, 3, 8)):
        write_once(spark, f"{tmp_path}/rows/{run_id}-{batch}.json",
                   line.format(run_id, batch, at, n))
    assert sorted((r.batch_id, r.row_count) for r in table.read().collect()) == [(0, 5), (1, 8)]


def test_what_goes_wrong_in_the_listener_is_raised(spark, tmp_path, monkeypatch):
    def lost(*_):
        raise OSError("no space")

    monkeypatch.setattr(progress, "write_once", lost)
    events(spark, [1, 2]).write.parquet(f"{tmp_path}/in")
    df = read_table_stream(spark, TableFiles(f"{tmp_path}/in", events(spark, []).schema))
    with progress.ProgressTable(spark, f"{tmp_path}/p") as table:
        with pytest.raises(OSError, match="no space"):
            run(spark, str(tmp_path), df, table)
