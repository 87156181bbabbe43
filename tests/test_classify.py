import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewire.operators import classify, models
from tidewire.plans import streams as plans
from tidewire.sources import messages, sinks
from tidewire.streaming import queries


@pytest.fixture(scope="module")
def model(spark):
    examples = spark.range(400).select(
        F.when(F.col("id") % 5 < 3, F.concat(F.lit("good news "), F.col("id")))
        .otherwise(F.concat(F.lit("bad trouble "), F.col("id"))).alias("text"),
        F.when(F.col("id") % 5 < 3, 1).otherwise(0).alias("target"))
    return classify.train_classifier(examples, features=1 << 12), examples


NAMES = ("negative", "positive")


def test_better_than_the_majority(spark, model):
    fitted, examples = model
    scored = classify.classify_text(examples, fitted, NAMES)
    assert scored.columns == ["text", "target", "sentiment_label", "confidence"]
    right = scored.filter((F.col("sentiment_label") == "positive") == (F.col("target") == 1))
    assert scored.count() == 400 and right.count() / 400 > 0.6
    bounds = scored.agg(F.min("confidence"), F.max("confidence")).first()
    assert 0.5 <= bounds[0] <= bounds[1] <= 1


def test_weights_leave_the_rows_where_they_lie(spark, monkeypatch):
    """A shuffle by class would bring all rows of a class to one task."""
    class Unfitted:
        def __init__(self, stages):
            pass

        def fit(self, rows):
            return rows

    monkeypatch.setattr(classify, "Pipeline", Unfitted)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows = classify.train_classifier(spark.range(0, 1000, 1, 7).select(
            F.col("id").cast("string").alias("text"),
            F.when(F.col("id") % 10 > 0, (F.col("id") % 10 > 6).cast("int")).alias("target")))
        assert rows.rdd.getNumPartitions() == 7
        weights = {(r.target, r._weight): r["count"]
                   for r in rows.groupBy("target", "_weight").count().collect()}
    finally:
        spark.conf.set(key, before)
    assert weights == {(0, 900 / 1200): 600, (1, 900 / 600): 300}


def test_every_class_needs_a_label(spark, model):
    fitted, examples = model
    with pytest.raises(ValueError, match="2 classes"):
        classify.classify_text(examples, fitted, NAMES[:1])


def test_scored_stream(spark, model, tmp_path):
    folder = str(tmp_path)
    rows = [("good news", "web", None, "2024-01-01 00:00:00"), (None, None, "Egypt", None)]
    sent = sinks.encode_json(spark.createDataFrame(
        rows, "text string, source string, country string, timestamp string"))
    sent.select(F.col("value").cast("string")).write.text(f"{folder}/in")
    stored = plans.scored_messages(messages.read_messages(
        spark, messages.LineFiles(f"{folder}/in")), model[0], NAMES)
    queries.run_to_end(queries.append_to(stored, f"{folder}/c", path=f"{folder}/out",
                                         trigger={"availableNow": True}))
    found = {(r.text, r.country): r for r in spark.read.parquet(f"{folder}/out").collect()}
    assert set(found) == {("good news", "Jordan"), ("", "Egypt")}
    assert found[("good news", "Jordan")].sentiment_label == "positive"
    assert all(r.processed_at for r in found.values())


def test_a_model_is_fitted_once_for_the_same_rows_and_settings(spark, model, tmp_path):
    examples, folder = model[1], str(tmp_path / "models")
    fits = []

    def fit(rows, **settings):
        fits.append(settings)
        return classify.train_classifier(rows, **settings)

    def stored(rows, **settings):
        return models.stored_model(spark, folder, rows, {"features": 64, **settings}, fit)

    first = stored(examples)
    again = stored(examples.repartition(5).orderBy(F.rand(3)))
    assert len(fits) == 1 and again.stages[-1].coefficients == first.stages[-1].coefficients
    assert sorted(os.listdir(folder)) == [models.fingerprint(
        examples, {"_fit": f"{fit.__module__}.{fit.__qualname__}", "features": 64})]
    stored(examples, regularization=0.5)
    stored(examples.unionByName(examples))
    stored(examples.limit(399))
    assert len(fits) == 4 and len(os.listdir(folder)) == 4
    scored = [classify.classify_text(examples, one, NAMES).orderBy("text").collect()
              for one in (first, again)]
    assert scored[0] == scored[1]


def test_dead_letters_of_the_social_job(spark, model, tmp_path):
    folder = str(tmp_path)
    lines = ['{"text": "good news", "country": "Egypt"}', "nothing", '{"text": "x"']
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(
        f"{folder}/in")
    sent = messages.read_messages(spark, messages.LineFiles(f"{folder}/in"), position=True)
    out, dead = sinks.BatchFolders(f"{folder}/out"), sinks.BatchFolders(f"{folder}/dead")
    queries.run_to_end(plans.run_social(sent, model[0], NAMES, [out], f"{folder}/c",
                                        {"availableNow": True}, dead))
    stored = spark.read.parquet(f"{folder}/out")
    assert [(r.text, r.country) for r in stored.collect()] == [("good news", "Egypt")]
    assert plans.PAYLOAD not in stored.columns
    letters = spark.read.parquet(f"{folder}/dead").collect()
    assert {r[plans.PAYLOAD] for r in letters} == set(lines[1:])
    assert len({r.message_id for r in letters}) == 2


def test_python_model(spark):
    loads = spark.sparkContext.accumulator(0)

    def scorer(batches):
        loads.add(1)
        for texts in batches:
            glad = texts.str.contains("good")
            yield pd.DataFrame({"label": glad.map({True: "5 stars", False: "1 star"}),
                                "confidence": glad.map({True: 0.9, False: 0.8})})

    df = spark.createDataFrame([("good",), ("bad",)] * 50, "text string").coalesce(2)
    rows = classify.classify_with(df, scorer).collect()
    assert {(r.text, r.sentiment_label, r.confidence) for r in rows} == {
        ("good", "5 stars", 0.9), ("bad", "1 star", 0.8)}
    assert loads.value <= 2
