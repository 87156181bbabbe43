"""Document fingerprints by one-permutation MinHash, in DataFrame functions only."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.keys import KEY, keyed
from tidewire.llm.words import mix
from tidewire.session import ensure_checkpoint_dir

BINS_LOG2 = 7
BINS = 1 << BINS_LOG2
#: Low-order bits kept of the smallest hash of a bin.
BITS = 8
SHINGLE = 5
#: Bins that an empty bin asks in turn before it asks all that are filled.
PROBES = 16
_SPACES = r"[\x20\x09-\x0D]+"


def _probe(turn: int) -> Column:
    """The bin that each bin asks in its ``turn``-th attempt: a hash of both."""
    bins = mix(np.arange(BINS, dtype=np.uint64) * np.uint64(PROBES) + np.uint64(turn + 1))
    return F.array(*[F.lit(int(bin)) for bin in bins >> np.uint64(64 - BINS_LOG2)])


def shingles(text: Column, size: int = SHINGLE) -> Column:
    """Runs of ``size`` words of a text with A-Z as a-z, or all words of a shorter one."""
    plain = F.trim(F.regexp_replace(F.lower(text), _SPACES, " "))
    run = rf"(?<![^ ])(?=((?:[^ ]++ ){{{size - 1}}}[^ ]++))"
    return F.transform(F.array(plain), lambda words: F.when(
        words == "", F.array().cast("array<string>")).otherwise(F.transform(
            F.array(F.regexp_extract_all(words, F.lit(run), 1)),
            lambda runs: F.when(F.size(runs) > 0, runs).otherwise(F.array(words)))[0]))[0]


def _densified(filled: Column) -> Column:
    """The bytes of all bins from a map of the filled ones.

    An empty bin takes the value of the first filled bin that it asks. Which bins it asks, and in
    which order, is a hash of its own number, so two documents agree on a borrowed value as often
    as on an own one (optimal densification). After ``PROBES`` attempts it takes the filled bin
    with the smallest hash of both numbers.
    """
    every = F.sequence(F.lit(0), F.lit(BINS - 1))

    def fill(known: Column, bins: Column) -> Column:
        return F.transform(every, lambda i: F.coalesce(
            F.get(bins, i), *[F.get(bins, F.get(_probe(turn), i)) for turn in range(PROBES)],
            F.array_min(F.transform(F.map_entries(known), lambda e: F.struct(
                F.xxhash64(i, e["key"]).alias("h"), e["value"].alias("v"))))["v"]))

    return F.transform(F.array(filled), lambda known: F.transform(
        F.array(F.transform(every, lambda i: F.try_element_at(known, i))),
        lambda bins: fill(known, bins))[0])[0]


def with_fingerprints(rows: DataFrame, keys: list[str], texts: list[str]) -> DataFrame:
    """``keys`` and, for every column of texts, an array of ``BINS`` bytes named fp_<column>.

    Rows are distinct by ``keys`` and should be partitioned by some of them; the shingle hashes of
    a text are then binned where it lies. Texts without words have a null array.
    """
    contents = rows.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(name).alias("text")) for name in texts]))
        .alias("_c"))
    hashes = contents.select(*keys, F.col("_c.name").alias("_name"),
                             F.explode(shingles(F.col("_c.text"))).alias("_s")).select(
        *keys, "_name", F.xxhash64("_s").alias("_h"))
    bins = hashes.groupBy(*keys, "_name", F.shiftrightunsigned(
        "_h", 64 - BINS_LOG2).cast("int").alias("_bin")).agg(
        F.min(F.col("_h").bitwiseAND((1 << (64 - BINS_LOG2)) - 1)).alias("_least"))
    # kept as a signed byte
    low = (F.col("_least").bitwiseAND((1 << BITS) - 1) - (1 << (BITS - 1))).cast("tinyint")
    filled = bins.groupBy(*keys, "_name").agg(F.map_from_entries(F.collect_list(F.struct(
        "_bin", low.alias("_low")))).alias("_filled"))
    packed = filled.withColumn("_fp", _densified(F.col("_filled")))
    return packed.groupBy(*keys).agg(*[
        F.first(F.when(F.col("_name") == name, F.col("_fp")), ignorenulls=True).alias(f"fp_{name}")
        for name in texts])


def packed(fingerprint: Column) -> Column:
    """Two hexadecimal digits a bin; the empty string for a text without words."""
    return F.coalesce(F.array_join(F.transform(
        fingerprint, lambda byte: F.lpad(F.lower(F.hex(byte + F.lit(1 << (BITS - 1)))),
                                         BITS // 4, "0")), ""), F.lit(""))


def likeness(one: Column, other: Column) -> Column:
    """Estimated Jaccard similarity: the share of equal bins, less what equal low bits give by
    chance. Two texts without words are alike, one and another with words are not."""
    equal = F.aggregate(F.zip_with(one, other, lambda x, y: (x == y).cast("int")), F.lit(0),
                        lambda total, x: total + x)
    chance = 1.0 / (1 << BITS)
    estimate = (equal / F.lit(float(BINS)) - chance) / (1.0 - chance)
    return F.when(one.isNull() & other.isNull(), 1.0).otherwise(
        F.coalesce(F.greatest(F.lit(0.0), estimate), F.lit(0.0)))


def following(rows: DataFrame) -> DataFrame:
    """KEY and the key (next_a, next_b) of the next row by id (null first), the first after the
    last. Ids are sorted by range in parallel; one row per range is stitched at the ends."""
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select("_id", *KEY).repartitionByRange(width, "_id", "_b").withColumn(
        "_range", F.spark_partition_id()).checkpoint()
    inside = Window.partitionBy("_range").orderBy("_id", "_b")
    key = F.struct(*KEY)
    place = F.struct(F.col("_id").isNotNull(), "_id", "_b")
    firsts = ranged.groupBy("_range").agg(F.min_by(key, place).alias("_first"))
    by_range = Window.orderBy("_range")
    # one row per range, not per document
    ends = firsts.select(
        F.col("_range").alias("_end"),
        F.coalesce(F.lead("_first").over(by_range), F.first("_first").over(
            by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .alias("_then"))
    led = ranged.withColumn("_next", F.lead(key).over(inside))
    found = led.join(F.broadcast(ends), F.col("_range") == F.col("_end"))
    then = F.coalesce("_next", "_then")
    return found.select(*KEY, then["_a"].alias("next_a"), then["_b"].alias("next_b"))


def edited_and_next(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text, of its edit, and how alike they and the next text are.

    The edit replaces the last half of a text (code points, rounded down) by as many first ones of
    the next document by id. Returns one row per input row: id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next. Null texts count as empty; texts
    without words have an empty fingerprint. Rows equal in id and text are one document with one
    successor, written as often as they came; rows with one id and different texts follow one
    another, and rows without an id come first. A lone document is followed by itself. An empty
    table gives an empty result; other columns are ignored.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = keyed(docs, id, text)
    sizes = rows.select("_id", *KEY, F.char_length("_text").cast("long").alias("n")).groupBy(
        "_id", *KEY, "n").agg(F.count(F.lit(1)).alias("_copies")).checkpoint()
    order = following(sizes).checkpoint()
    # copies collapse before the texts move; both joins below use the one exchange of them
    whole = rows.groupBy(*KEY).agg(F.first("_text").alias("_text"))
    wanted = sizes.join(order, KEY).select(
        F.col("_a").alias("of_a"), F.col("_b").alias("of_b"), F.col("next_a").alias("_a"),
        F.col("next_b").alias("_b"), F.floor(F.col("n") / 2).cast("int").alias("_half"))
    heads = whole.join(wanted, KEY).select(
        F.col("of_a").alias("_a"), F.col("of_b").alias("_b"),
        F.expr("substring(_text, 1, _half)").alias("_head"))
    edited = whole.join(heads, KEY).select(*KEY, "_text", F.concat(
        F.expr("substring(_text, 1, char_length(_text) - cast(floor(char_length(_text) / 2)"
               " as int))"), "_head").alias("_edited"))
    shas = edited.select(*KEY, F.sha2("_edited", 256).alias("sha"))
    prints = with_fingerprints(edited, KEY, ["_text", "_edited"])
    known = sizes.join(shas.join(prints, KEY, "left"), KEY).checkpoint()
    others = known.select(F.col("_a").alias("next_a"), F.col("_b").alias("next_b"),
                          F.col("fp__text").alias("fp_next"))
    result = known.join(order, KEY).join(others, ["next_a", "next_b"])
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return result.select(
        F.col("_id").alias(id), F.col("n").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        packed(F.col("fp__text")).alias("fingerprint"),
        packed(F.col("fp__edited")).alias("edited_fingerprint"),
        likeness(F.col("fp__text"), F.col("fp__edited")).alias("near_edited"),
        likeness(F.col("fp__text"), F.col("fp_next")).alias("near_next"),
        copies.alias("_copy")).drop("_copy")
