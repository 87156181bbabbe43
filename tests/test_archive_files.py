"""Archiving by id: only files with moved rows change, and a stopped move is finished later."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewire.operators import archive_files
from tidewire.operators.archive_files import archive_by_file

# helper names of the operator are taken by columns here
SCHEMA = "event_id long, moves string, folder string, fresh int, path string"
PARTS = ("q a/batch_id=0", "ä+%/batch_id=007", "q=[1]/batch_id=1")


def rows(ids, mark="x"):
    return [(n, mark, None, n, "p") for n in ids]


@pytest.fixture
def store(spark, tmp_path):
    """Three folders below with odd names and two files at the root; copies and rows without an id."""
    live = str(tmp_path / "live")
    frame = spark.createDataFrame(rows(range(40)), SCHEMA).coalesce(1)
    frame.write.parquet(live)
    spark.createDataFrame(rows([*range(40, 80), None, None]), SCHEMA).coalesce(1).write.mode(
        "append").parquet(live)
    for at, name in enumerate(PARTS):
        ids = [100 * (at + 1) + n % 30 for n in range(60)]
        spark.createDataFrame(rows([*ids, None], name), SCHEMA).write.parquet(
            f"{live}/query_id={archived_name(spark, name)}")
    return live, str(tmp_path / "archive")


def archived_name(spark, name):
    """A folder's name as Spark writes partition values."""
    query, rest = name.split("/")
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{escape(query)}/{rest}"


def files(folder):
    return {os.path.relpath(f"{at}/{name}", folder): os.stat(f"{at}/{name}").st_mtime_ns
            for at, _, names in os.walk(folder) for name in names
            if name.endswith(".parquet") and "/_moves" not in at}


def stored(spark, folder):
    """All files below a folder, with and without partition folders."""
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(folder)


def content(spark, folder):
    return Counter(map(tuple, stored(spark, folder).collect())) if files(folder) else Counter()


def frame(spark, ids):
    return spark.createDataFrame([(n,) for n in ids], "event_id long")


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_only_files_with_moved_ids_change(spark, store):
    live, archive = store
    before, all_rows = files(live), content(spark, live)
    ids = frame(spark, [3, 4, 4, None, 205, 229, 9999])
    touched = archive_by_file(spark, live, archive, ids, schema(spark), "one")
    after = files(live)
    gone = set(before) - set(after)
    assert gone == {os.path.relpath(path, live) for path in touched}
    assert all(after[name] == before[name] for name in set(before) & set(after))
    assert 0 < len(gone) < len(before) / 2
    assert {os.path.dirname(name) for name in gone} == {
        "", f"query_id={archived_name(spark, PARTS[1])}"}
    assert {os.path.dirname(name) for name in set(after) - set(before)} == {
        os.path.dirname(name) for name in gone}
    moved, kept = content(spark, archive), content(spark, live)
    assert sorted(r[0] for r in moved.elements()) == [3, 4, 205, 205, 229, 229]
    assert moved + kept == all_rows
    assert archive_by_file(spark, live, archive, ids, schema(spark), "one") == []
    assert files(live) == after


def test_ids_in_the_archive_leave_without_a_second_copy(spark, store):
    live, archive = store
    spark.createDataFrame(rows([5, 110]), SCHEMA).write.parquet(archive)
    archive_by_file(spark, live, archive, frame(spark, [5, 6, 110]), schema(spark), "two",
                    archived=frame(spark, [5, 110, None]))
    assert sorted(r[0] for r in stored(spark, archive).collect()) == [5, 6, 110]
    assert stored(spark, live).filter(F.col("event_id").isin(5, 6, 110)).count() == 0
    assert stored(spark, live).count() == 40 + 42 + 3 * 61 - 2 - 2


@pytest.mark.parametrize("ids", [[], [None], [9999, -1]])
def test_nothing_to_move(spark, store, ids):
    live, archive = store
    before = files(live)
    assert archive_by_file(spark, live, archive, frame(spark, ids), schema(spark), "none") == []
    assert files(live) == before and not os.path.exists(archive)


def test_a_file_that_moves_whole_leaves_nothing(spark, store):
    live, archive = store
    archive_by_file(spark, live, archive, frame(spark, range(40)), schema(spark), "whole")
    assert len([name for name in files(live) if "/" not in name]) == 1
    assert sorted(r[0] for r in stored(spark, archive).collect()) == list(range(40))


@pytest.mark.parametrize("step, after", [("_find_files", 0), ("_stage", 0), ("move_file", 0),
                                         ("move_file", 1), ("move_file", 3), ("remove_folder", 0),
                                         ("remove_folder", 1), ("write_once", 0)])
def test_a_stopped_move_is_finished(spark, store, monkeypatch, step, after):
    """Wherever it stops no row is missing; later ids do not join a move that has begun."""
    live, archive = store
    all_rows, right, calls = content(spark, live), getattr(archive_files, step), [0]

    def failing(*args):
        calls[0] += 1
        if calls[0] > after:
            raise OSError("lost")
        return right(*args)

    monkeypatch.setattr(archive_files, step, failing)
    ids = frame(spark, [3, 45, 205, 301])
    with pytest.raises(OSError, match="lost"):
        archive_by_file(spark, live, archive, ids, schema(spark), "stopped")
    spark.catalog.clearCache()
    seen = content(spark, live) + content(spark, archive)
    assert set(seen) == set(all_rows) and all(seen[row] >= n for row, n in all_rows.items())
    monkeypatch.setattr(archive_files, step, right)
    archive_by_file(spark, live, archive, frame(spark, [7]), schema(spark), "stopped")
    moved = content(spark, archive)
    assert sorted(row[0] for row in moved.elements()) == [3, 45, 205, 205, 301, 301]
    assert moved + content(spark, live) == all_rows
    left = [name for name in os.listdir(f"{live}/_moves/stopped") if not name.startswith(".")]
    assert left == ["done"]
