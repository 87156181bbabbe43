"""Sinks of one stream that show a batch together."""

import os

import pytest
from pyspark.sql import functions as F

from tidewire.sources.messages import TableFiles, read_table_stream
from tidewire.streaming import queries
from tidewire.streaming.together import Together

ONCE = {"availableNow": True}
SINKS = {"all": lambda batch: batch.select("id"),
         "even": lambda batch: batch.filter("id % 2 = 0").select(F.col("id").alias("half"))}


def schemas(spark):
    ids = spark.range(0)
    return {name: of(ids).schema for name, of in SINKS.items()}


def seen(spark, write):
    found = write.read(spark, schemas(spark))
    return {name: sorted(r[0] for r in rows.collect()) for name, rows in found.items()}


def test_no_reader_sees_a_batch_in_one_sink_only(spark, tmp_path):
    folder = str(tmp_path)
    for start in (0, 10, 20):
        spark.range(start, start + 10).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    df = read_table_stream(spark, TableFiles(
        f"{folder}/in", spark.range(0).schema, options={"maxFilesPerTrigger": "1"}))
    broken, store = [True], Together._store

    class Failing(Together):
        def _store(self, sink, rows, at):
            if broken[0] and sink == "even" and "batch_id=1/" in at:
                store(self, sink, rows.limit(1), at)  # a part is there when it fails
                raise OSError("sink lost")
            store(self, sink, rows, at)

    write = Failing(f"{folder}/out", SINKS)
    assert seen(spark, write) == {"all": [], "even": []}

    def run():
        queries.run_to_end(queries.for_each_batch(df, write, f"{folder}/c", trigger=ONCE))

    with pytest.raises(Exception, match="sink lost"):
        run()
    first = seen(spark, write)
    assert len(first["all"]) == 10 and first["even"] == [n for n in first["all"] if n % 2 == 0]
    broken[0] = False
    run()
    assert seen(spark, write) == {"all": list(range(30)), "even": list(range(0, 30, 2))}
    assert write.published(spark).count() == 3
    for sink in SINKS:  # what the failed attempt left is gone
        for at, names, _ in os.walk(f"{folder}/out/sinks/{sink}"):
            assert sum(name.startswith("attempt=") for name in names) <= 1


def test_a_replayed_batch_is_written_once(spark, tmp_path):
    write = Together(str(tmp_path), SINKS)
    write(spark.range(5), 0)
    write(spark.range(100, 200), 0)  # its manifest is there
    write(spark.range(1, 2), 1)  # nothing for one of the sinks
    assert seen(spark, write) == {"all": [0, 1, 1, 2, 3, 4], "even": [0, 2, 4]}


def test_sinks_are_read_as_of_one_moment(spark, tmp_path):
    write = Together(str(tmp_path), SINKS)
    write(spark.range(4), 0)
    held = write.read(spark, schemas(spark))
    write(spark.range(4, 8), 1)
    assert held["all"].count() == 4 and held["even"].count() == 2
    assert {name: len(rows) for name, rows in seen(spark, write).items()} == {"all": 8, "even": 4}


def test_a_batch_is_computed_once(spark, tmp_path):
    ran = spark.sparkContext.accumulator(0)

    def count(part):
        for row in part:
            ran.add(1)
            yield row

    batch = spark.createDataFrame(spark.range(6).rdd.mapPartitions(count), "id long")
    Together(str(tmp_path), SINKS)(batch, 0)
    assert ran.value == 6


def test_some_sink_is_needed(tmp_path):
    with pytest.raises(ValueError):
        Together(str(tmp_path), {})
