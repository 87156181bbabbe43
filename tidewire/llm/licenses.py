"""License notices found by diagonal voting, in DataFrame functions only."""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidewire.llm.keys import KEY, keyed
from tidewire.session import small_table

GRAM = 2
#: Diagonals this far apart belong to one place: a few words put in or left out.
DRIFT = 2
LEAST_COVERAGE = 0.85
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    """Words that stand for a license. A phrase counts only where all its words stand together."""

    label: str
    text: str
    phrase: bool = False


# Phrases and their labels.
PHRASES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
)

# Notices in common use, in the words of their licenses.
NOTICES = (
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy "
                    "of this software and associated documentation files"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("gpl", "licensed under the gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without "
                    "modification are permitted provided that the following conditions are met"),
    Template("bsd", "licensed under the bsd license"),
    Template("cc-by", "licensed under cc by 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by", "creative commons attribution 4 0 international license"),
    Template("cc0", "dedicated to the public domain under cc0 1 0"),
    Template("mpl", "mozilla public license version 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose "
                    "with or without fee is hereby granted"),
    Template("proprietary", "all rights reserved"),
)


def plain_words(text: Column) -> Column:
    """Runs of letters, digits and anything beyond ASCII, with A-Z as a-z."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    spaced = F.trim(F.regexp_replace(lowered, _BETWEEN, " "))
    return F.transform(F.array(spaced), lambda words: F.when(
        words == "", F.array().cast("array<string>")).otherwise(F.split(words, " ")))[0]


def gram_table(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """template, label, phrase, n_grams, at, and the two words and hash of each gram.

    Made of the program's templates, so its size is known and does not grow with any table.
    """
    rows = []
    for number, template in enumerate(templates):
        words = template.text.split()
        if not GRAM <= len(words) <= 62:
            raise ValueError(f"a template has 2 to 62 words: {template.text!r}")
        rows += [(number, template.label, int(template.phrase), len(words) - 1, at, *pair)
                 for at, pair in enumerate(zip(words, words[1:]))]
    schema = StructType([
        StructField("template", IntegerType()), StructField("label", StringType()),
        StructField("phrase", IntegerType()), StructField("n_grams", IntegerType()),
        StructField("at", IntegerType()), StructField("g0", StringType()),
        StructField("g1", StringType())])
    return F.broadcast(small_table(spark, rows, schema).withColumn("g", F.xxhash64("g0", "g1")))


def spans(rows: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """Where templates lie: KEY, template, label, phrase, first and last word, coverage.

    All rolling grams meet the templates' grams by hash and words. A match votes for the diagonal
    (place less place in the template); the grams seen on a diagonal are a bit mask, so repeated
    rows do not vote twice. Neighbouring diagonals merge, and a place counts if enough of the
    template's grams lie there: all, in a row, for phrases.
    """
    words = rows.select(*KEY, plain_words(F.col("_text")).alias("_w"))
    pairs = words.filter(F.size("_w") >= GRAM).select(*KEY, F.posexplode(F.arrays_zip(
        F.col("_w").alias("w0"), F.slice("_w", 2, F.size("_w") - 1).alias("w1"))))
    grams = pairs.select(*KEY, F.col("pos"), F.col("col.w0").alias("w0"),
                         F.col("col.w1").alias("w1"), F.xxhash64("col.w0", "col.w1").alias("_h"))
    table = gram_table(rows.sparkSession, templates)
    met = grams.join(table, (F.col("_h") == F.col("g")) & (F.col("w0") == F.col("g0"))
                     & (F.col("w1") == F.col("g1")))
    diagonals = met.groupBy(*KEY, "template", "label", "phrase", "n_grams",
                            (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.bit_or(F.expr("shiftleft(1L, at)")).alias("mask"),
        F.min("pos").alias("first"), F.max("pos").alias("last"))
    same = [*KEY, "template"]
    along = Window.partitionBy(*same).orderBy("diagonal")
    drift = F.when(F.col("phrase") == 1, 0).otherwise(DRIFT)
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > drift
    numbered = diagonals.withColumn("place", F.sum(F.coalesce(apart.cast("int"), F.lit(1))).over(
        along))
    merged = numbered.groupBy(*same, "label", "phrase", "n_grams", "place").agg(
        F.bit_count(F.bit_or("mask")).alias("votes"),
        F.min("first").alias("first"), (F.max("last") + GRAM - 1).alias("last"))
    coverage = F.col("votes") / F.col("n_grams")
    long_enough = F.col("last") - F.col("first") < 2 * (F.col("n_grams") + 1)
    return merged.withColumn("coverage", F.when(long_enough, coverage).otherwise(0.0)).filter(
        (F.col("phrase") == 0) | (F.col("votes") == F.col("n_grams")))


def scan(docs: DataFrame, *, id: str = "doc_id", text: str = "text",
         phrases: Sequence[Template] = PHRASES, notices: Sequence[Template] = NOTICES,
         least_coverage: float = LEAST_COVERAGE) -> DataFrame:
    """License phrases and notices of every whole text.

    Returns one row per input row: id, n_words, n_base (places of phrases), first_word and
    last_word (their smallest and largest start, else null), base_labels, labels (with those of
    notices of which at least ``least_coverage`` is there), and score (the best coverage of a
    template, 0 to 1). Null and empty texts have no words and empty labels. Rows equal in id and
    text get equal results, each its own row. Other columns are ignored.
    """
    rows = keyed(docs, id, text)
    found = spans(rows, [*phrases, *notices])
    base = F.col("phrase") == 1
    sure = base | (F.col("coverage") >= least_coverage)

    def labels(which: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(F.when(which, F.col("label")))), ",")

    per_text = found.groupBy(*KEY).agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(sure).alias("labels"),
        F.max("coverage").alias("score"))
    counted = rows.select("_id", *KEY, F.regexp_count("_text", F.lit(
        r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long").alias("n_words"))
    return counted.join(per_text, KEY, "left").select(
        F.col("_id").alias(id), "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
