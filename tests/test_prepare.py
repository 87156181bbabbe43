import datetime
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from tidewire import schemas
from tidewire.functions.lexicon import Lexicon
from tidewire.operators import metrics, places, prepare

SCHEMA = StructType([
    StructField("text", StringType()),
    StructField("country", StringType()),
    StructField("year", IntegerType()),
    StructField("m", MapType(StringType(), DoubleType())),
])
PAYLOADS = [
    '{"text":"a","country":"Egypt","year":2020,"m":{"x":1.5,"y":2}}',
    "not json", "[]", "", None,
    '{"text":"b","year":"abc"}',
    '{"text":"c","extra":1}',
    '{"text":null,"country":null}',
    '{"text":7,"year":2020.0}',
    '{"text":"d","m":{"x":"bad","y":1.0}}',
    '{"text":{"n":1}}',
]


def payloads(spark):
    return spark.createDataFrame(list(enumerate(PAYLOADS)), "i int, json string")


def test_json_goldens(spark):
    parsed = prepare.null_fill(prepare.json_parse(payloads(spark), SCHEMA, keep=["i"]))
    rows = [tuple(row)[1:] for row in parsed.orderBy("i").collect()]
    blank = ("", "Jordan", None, None)
    assert rows == [
        ("a", "Egypt", 2020, {"x": 1.5, "y": 2.0}), blank, blank, blank, blank,
        ("b", "Jordan", None, None), ("c", "Jordan", None, None), blank,
        ("7", "Jordan", None, None), ("d", "Jordan", None, None), ('{"n":1}', "Jordan", None, None),
    ]


def test_rejects_are_kept_and_nothing_is_lost(spark):
    parsed = prepare.json_parse(payloads(spark), SCHEMA, keep=["i"], rejects="payload")
    bad = {row.i: row.payload for row in prepare.rejected(parsed, "payload", ["i"]).collect()}
    good = {row.i: row.text for row in prepare.accepted(parsed, "payload").collect()}
    assert set(bad) | set(good) == set(range(len(PAYLOADS))) and not set(bad) & set(good)
    assert {1, 2, 3, 4, 5, 9} <= set(bad)
    assert bad[1] == "not json" and bad[4] == "" and bad[5] == PAYLOADS[5]
    assert good[0] == "a" and good[6] == "c"


def test_wire_schemas(spark):
    rows = spark.createDataFrame([(
        '{"country":"Egypt","year":2023,"unemployment_rate":7.5,"youth_unemployment":null,'
        '"sector_employment":{"farming":20.5,"services":50}}',)], "json string")
    row = prepare.json_parse(rows, schemas.EMPLOYMENT_INDICATOR).first()
    assert row.sector_employment == {"farming": 20.5, "services": 50.0}
    assert row.youth_unemployment is None


def test_ensure_columns(spark):
    there = spark.createDataFrame([(None, 1), ("x", None)], "country string, n int")
    assert sorted(map(tuple, prepare.ensure_columns(there).collect()), key=str) == sorted(
        [("", 1), ("x", None)], key=str)
    absent = spark.createDataFrame([("t",), (None,)], "text string")
    assert {tuple(r) for r in prepare.ensure_columns(absent).collect()} == {
        ("t", "Jordan"), ("", "Jordan")}


def test_first_label_of_empty_array_is_null(spark):
    df = spark.createDataFrame(
        [("t", "s", "c", ([],), "x"), ("t", "s", "c", (["4 stars", "1 star"],), "x")],
        "text string, source string, country string, class struct<result:array<string>>, "
        "timestamp string")
    rows = prepare.project_scored(df).collect()
    assert [row.sentiment_label for row in rows] == [None, "4 stars"]
    assert rows[0].asDict().keys() == set(schemas.SCORED_MESSAGE.fieldNames())


def test_stamp_is_one_instant(spark):
    rows = prepare.stamp(spark.range(1000).repartition(8)).select("processed_time").distinct()
    assert [row.processed_time is not None for row in rows.collect()] == [True]


def test_event_time(spark):
    df = spark.createDataFrame([("2024-02-03 04:05:06",), ("soon",), (None,)], "timestamp string")
    times = prepare.parse_event_time(df).select(F.col("event_ts").cast("string")).collect()
    assert [row[0] for row in times] == ["2024-02-03 04:05:06", None, None]


def test_enrich_defaults(spark):
    rules = prepare.MessageRules(categories=(Lexicon("cat", ("cat",)),), default_category="none",
                                 stopwords=("the",), unspecified="?", engine="e")
    df = spark.createDataFrame([(1, "the cat sat", "positive"), (2, None, "negative"),
                                (3, "dogs bark", None)], "id int, text string, sentiment string")
    rows = {row.id: row for row in prepare.enrich_message(df, rules).collect()}
    assert len(rows["1"].asDict()) == 14
    assert (rows["1"].category, rows["1"].positive_words, rows["1"].negative_words) == ("cat", 2, 0)
    assert (rows["2"].text, rows["2"].category, rows["2"].keywords) == ("", "none", [])
    assert (rows["3"].sentiment, rows["3"].city, rows["3"].age, rows["3"].gender) == (
        "neutral", "?", 0, "?")
    assert rows["1"].auto_categories == ["cat"] and rows["1"].analysis_engine == "e"
    assert isinstance(rows["1"].timestamp, datetime.datetime)


def test_geo_lookup_defaults_and_jitter(spark):
    df = spark.createDataFrame([("Egypt",), ("Oman",), ("",), (None,)], "country string")
    found = [(row.lat, row.lon) for row in places.geo_lookup(df).collect()]
    assert found == [(26.82, 30.80), *[(31.95, 35.91)] * 3]
    many = spark.range(20000).select(F.lit("Kuwait").alias("country"))
    jittered = places.geo_lookup(many, jitter=1.0, seed=3)
    stats = jittered.agg(F.avg("lat"), F.stddev("lat"), F.avg("lon"), F.stddev("lon"),
                         F.corr("lat", "lon")).first()
    assert abs(stats[0] - 29.37) < 0.05 and abs(stats[2] - 47.97) < 0.05
    assert abs(stats[1] - 1) < 0.05 and abs(stats[3] - 1) < 0.05 and abs(stats[4]) < 0.05
    assert jittered.collect() == places.geo_lookup(many, jitter=1.0, seed=3).collect()


def test_geo_density_with_and_without_jitter(spark):
    df = spark.createDataFrame([("Egypt", "negative")] * 5 + [("Oman", "negative")] * 2
                               + [("Egypt", "positive")], "country string, sentiment string")
    cells = {(r.lat_cell, r.lon_cell): r.n for r in places.geo_density(df).collect()}
    assert cells == {(26, 30): 5, (31, 35): 2}
    jittered = places.geo_density(df, jitter=2.0, seed=1).agg(F.sum("n")).first()[0]
    assert jittered == 7


def test_kpis_of_nothing(spark):
    row = metrics.kpi_summary(spark.createDataFrame([], "sentiment string")).first()
    assert (row.total, row.positive_count, row.positivity_index) == (0, 0, 0.0)


def test_kpis(spark):
    df = spark.createDataFrame([("positive",)] * 2 + [("negative",), (None,)], "sentiment string")
    row = metrics.kpi_summary(df).first()
    assert tuple(row) == (4, 2, 1, 0, 50.0)
    shares = {r.sentiment: r.share for r in metrics.distribution(df).collect()}
    assert shares == {"positive": 0.5, "negative": 0.25, None: 0.25}


def test_keyed_noise_is_normal_and_keeps_to_its_id(spark):
    many = spark.range(20_000).select(F.col("id").alias("event_id"), F.lit("Egypt").alias("country"))
    noisy = places.geo_lookup(many, jitter=2.0, seed=5, key="event_id")
    calm = places.geo_lookup(many.limit(1)).first()
    stats = noisy.agg(F.avg("lat"), F.stddev("lat"), F.avg("lon"), F.stddev("lon"),
                      F.corr("lat", "lon"), F.kurtosis("lat")).first()
    assert abs(stats[0] - calm.lat) < 0.05 and abs(stats[2] - calm.lon) < 0.05
    assert abs(stats[1] - 2) < 0.05 and abs(stats[3] - 2) < 0.05
    assert abs(stats[4]) < 0.03 and abs(stats[5]) < 0.2
    again = places.geo_lookup(many.repartition(7, F.rand(1)), jitter=2.0, seed=5, key="event_id")
    assert noisy.exceptAll(again).isEmpty() and again.exceptAll(noisy).isEmpty()
    other = places.geo_lookup(many, jitter=2.0, seed=6, key="event_id")
    assert noisy.intersect(other).isEmpty()
    nulls = places.geo_lookup(many.limit(3).withColumn("event_id", F.lit(None).cast("long")),
                              jitter=2.0, key="event_id")
    assert nulls.distinct().count() == 1 and nulls.filter("lat IS NULL OR isnan(lat)").isEmpty()
    dense = places.geo_density(many.withColumn("sentiment", F.lit("negative")), jitter=2.0, seed=5,
                               key="event_id")
    assert dense.agg(F.sum("n")).first()[0] == 20_000


@pytest.mark.parametrize("step, radius", [(1.0, 0), (1.0, 1), (2.5, 3), (7.0, 2), (90.0, 2)])
def test_smooth_density_equals_brute_force(spark, step, radius):
    top, half = math.floor(90 / step), int(180 // step)
    low = math.floor(-90 / step)
    cells = [(0, 0, 5), (0, 1, 7), (top, half - 1, 3), (low, -half, 11), (0, -half, 2)]
    expected = Counter()
    for lat, lon, n in cells:
        for up in range(-radius, radius + 1):
            for right in range(-radius, radius + 1):
                if low <= lat + up <= top:
                    to = lon + right
                    if 180 % step == 0:
                        to = (to + half) % (2 * half) - half
                    expected[lat + up, to] += n * math.comb(2 * radius, radius + up) * math.comb(
                        2 * radius, radius + right)
    df = spark.createDataFrame(cells, "lat_cell long, lon_cell long, n long")
    found = places.smooth_density(df, step, radius)
    assert {(r.lat_cell, r.lon_cell): r.weight for r in found.collect()} == expected
    assert places.smooth_density(df.limit(0), step, radius).isEmpty()


def test_smooth_density_refuses_radii_that_could_overflow(spark):
    with pytest.raises(ValueError):
        places.smooth_density(spark.createDataFrame([], "lat_cell long, lon_cell long, n long"),
                              radius=8)
