"""Spelling variants: words one edit apart, found by asymmetric q-chunks, and the form each leads to."""

from __future__ import annotations

import string
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.session import ensure_checkpoint_dir

#: Maximal runs of these are words; A-Z have become a-z before.
RUNS = "[a-zÀ-ÿ]+"
#: Pairs of words behind one chunk up to which they are compared; beyond, the chunk is lengthened.
PAIRS = 512


def word_counts(docs: DataFrame, *, id: str = "doc_id", text: str = "text",
                change: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(word, n): all words of all whole texts, with A-Z as a-z, and how often they occur.

    ``change`` makes the word that counts from the id and the word that is written. Null texts
    have no words. Counts are combined in the map tasks, so a very common word is no hot key.
    """
    lowered = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    words = docs.select(F.col(id).alias("_id"), F.explode(
        F.regexp_extract_all(lowered, F.lit(RUNS), F.lit(0))).alias("word"))
    if change is not None:
        words = words.select(change(F.col("_id"), F.col("word")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _sides(words: DataFrame) -> DataFrame:
    """Every word once for its chunks, and once for its grams among words of each length that is
    its own or one less; ``length`` is that of the word whose chunks are met."""
    own = F.length("word")
    sides = F.array(
        F.struct(F.lit(True).alias("chunk"), own.alias("length")),
        F.struct(F.lit(False).alias("chunk"), own.alias("length")),
        F.struct(F.lit(False).alias("chunk"), (own - 1).alias("length")))
    return words.select("word", "n", F.explode(sides).alias("side")).select(
        "word", "n", "side.*", F.lit(0).alias("start"), F.col("side.length").alias("end"))


def _halved(rows: DataFrame) -> DataFrame:
    """Each row once with its edit in the left and once in the right half of its open stretch.

    The open stretch [start, end) is where a word of ``length`` may differ; what is left and right
    of it is equal in both words of a pair. Of two disjoint chunks one edit leaves one alone, and
    this stands in the other word at its own place, or one later if it is behind the edit and that
    word is longer by one.
    """
    middle = F.floor((F.col("start") + F.col("end")) / 2).cast("int")
    halves = F.explode(F.array(
        F.struct("start", middle.alias("end")),
        F.struct(middle.alias("start"), "end")))
    halved = rows.select("word", "n", "chunk", "length", halves.alias("open")).select(
        "word", "n", "chunk", "length", "open.*")
    after = F.col("length") - F.col("end")
    before = F.expr("substring(word, 1, start)")
    behind = F.when(after > 0, F.expr("right(word, length - end)")).otherwise("")
    # equal keys of different chunks only add candidates, which are verified
    return halved.withColumn("key", F.xxhash64("length", "start", "end", before, behind))


def near_words(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of words that differ by one inserted, deleted or replaced code
    point, each pair once.

    ``words`` holds distinct words and their counts. The shorter word of a pair (either, if equally
    long) contributes two disjoint chunks, the other its grams at the places where a chunk can
    stand, at most one further on. A chunk that more than ``pairs`` pairs share is lengthened: its
    open rest is cut into two chunks again, of which one edit leaves one alone, until few share it
    or only one code point is open. So no pair is lost and no common chunk makes all its pairs.
    """
    ensure_checkpoint_dir(words.sparkSession)
    rows, found = _sides(words), []
    while True:
        rows = _halved(rows).checkpoint()
        groups = rows.groupBy("key").agg(
            F.count_if("chunk").alias("chunks"), F.count_if(~F.col("chunk")).alias("grams"),
            F.max(F.col("end") - F.col("start")).alias("open"),
            (F.min("word") != F.max("word")).alias("several")).filter(
            "several AND chunks > 0 AND grams > 0").withColumn(
            "crowded", (F.col("chunks") * F.col("grams") > pairs) & (F.col("open") > 1)).select(
            "key", "crowded").checkpoint()
        few = rows.join(groups.filter("NOT crowded"), "key", "left_semi")
        left = few.filter("chunk").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
        right = few.filter("NOT chunk").select("key", F.col("word").alias("b"),
                                               F.col("n").alias("n_b"))
        met = left.join(right, "key").filter(
            (F.length("a") < F.length("b")) | (F.col("a") < F.col("b")))
        found.append(met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b"))
        rows = rows.join(groups.filter("crowded"), "key", "left_semi")
        if groups.filter("crowded").isEmpty():
            return reduce(DataFrame.union, found).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms from each word that has a form. A form occurs at
    least twice as often as its word, so chains are short and have no cycles; each round doubles
    the steps that a root stands for."""
    roots = forms.select("word", F.col("form").alias("root")).checkpoint()
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = roots.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")).checkpoint()
        roots = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return roots


def variants(counts: DataFrame, *, least_length: int = 5, least_count: int = 3,
             factor: int = 2, pairs: int = PAIRS) -> DataFrame:
    """Every word of ``counts`` (word, n) that is long and frequent enough, with the form it leads to.

    Two words are near if one inserted, deleted or replaced code point makes one of the other. The
    form of a word is its near word of largest n, of equal ones the first in code-point order, if
    it occurs at least ``factor`` times as often; the root is where the forms lead in the end, or
    the word itself. Candidates come from :func:`near_words`; each is verified.

    Returns word, form, root, n, n_near (number of near words) and form_n; form and form_n are null
    where a word has no form. An empty table gives an empty result; a null word is left out; words
    of any length are compared whole. Words are distinct in ``counts``; other columns are ignored.
    """
    ensure_checkpoint_dir(counts.sparkSession)
    words = counts.select("word", "n").filter(
        (F.length("word") >= least_length) & (F.col("n") >= least_count)).checkpoint()
    near = near_words(words, pairs)
    both = near.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m"))
    both = both.union(near.select("b", "a", "n_a"))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best"))
    led = words.join(best, "word", "left")
    leads = -F.col("best.less") >= factor * F.col("n")
    formed = led.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, F.col("best.other")).alias("form"),
        F.when(leads, -F.col("best.less")).alias("form_n")).checkpoint()
    roots = _roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, *, id: str = "doc_id", text: str = "text",
                      change: Callable[[Column, Column], Column] | None = None,
                      **options) -> DataFrame:
    """:func:`variants` of all words of the whole texts of some documents. Null and empty texts have
    no words; rows that repeat an id or a text count as often as they stand; other columns are
    ignored, whatever their names."""
    return variants(word_counts(docs, id=id, text=text, change=change), **options)
