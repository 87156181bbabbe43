"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.session import MAX_BROADCAST_ROWS, ensure_checkpoint_dir

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 48
LEVEL_BITS = 12
WEIGHTS = (3.0, 1.0, 2.0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(id: Column, text: Column) -> Column:
    """48 bits that depend on id and text alone, so that reruns agree."""
    body = F.md5(F.coalesce(text, F.lit("")))
    whole = F.md5(F.concat(F.coalesce(id.cast("string"), F.lit("")), F.lit(":"), body))
    return F.conv(F.substring(whole, 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, repeats: float) -> DataFrame:
    """Words wanted of each source: shares by weight, none above ``repeats`` times its size.

    Sources take their weights in code point order, null last, repeating. What a full source can
    not take is shared among the others until none is above: sources fill up in order of size per
    weight, so one pass in that order finds the common level. One row per source.
    """
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(weight)) for weight in weights])
    weighted = sizes.withColumn("_weight", F.get(
        cycle, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))))
    weighted = weighted.withColumn("_most", F.lit(float(repeats)) * F.col("source_size"))
    filling = Window.orderBy(F.col("_most") / F.col("_weight"), F.col("_source").asc_nulls_last())
    before = F.coalesce(F.sum("_most").over(filling.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0.0))
    open_weight = F.sum("_weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    everything = F.sum("source_size").over(
        Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding,
                                             Window.unboundedFollowing))
    budget = F.lit(float(share)) * everything
    levels = weighted.withColumn("_level", (budget - before) / open_weight).withColumn(
        "_place", F.row_number().over(filling))
    stays_open = F.col("_most") / F.col("_weight") > F.col("_level")
    level = F.min(F.when(stays_open, F.struct("_place", "_level"))).over(
        Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding,
                                             Window.unboundedFollowing))["_level"]
    target = F.coalesce(F.least("_most", F.col("_weight") * level), F.col("_most"))
    return levels.select("_source", "source_size", target.alias("target"))


def _boundary(histogram: DataFrame) -> DataFrame:
    """Per source the bucket in which the budget is reached, and the words below it."""
    running = Window.partitionBy("_source").orderBy("_bucket")
    reached = histogram.withColumn("_sum", F.col("_below") + F.sum("_words").over(
        running.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    first = reached.filter(F.col("_sum") >= F.col("_budget")).groupBy("_source", "_budget").agg(
        F.min(F.struct("_bucket", (F.col("_sum") - F.col("_words")).alias("_below"),
                       "_words")).alias("_first"))
    return first.select("_source", "_budget", "_first.*")


def mix(docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = 1.5,
        repeats: float = 2.0) -> DataFrame:
    """How often each document goes into a mix whose sources have the wanted numbers of words.

    Of a source that should give t of its s words, every document is taken floor(t / s) times, and
    once more where its hash is up to a threshold. Words are summed by source and hash bucket; the
    bucket in which the budget ends is summed again by the next bits, and so on down to one hash
    value, which is taken if that comes nearer. Thresholds are nested: more budget only adds
    documents. No row is sorted or sent anywhere for this but sums per source and bucket.

    Returns one row per input row: id, size, source_size, target, taken (words, repeats counted)
    and copies. Null and empty texts have size 0. A null source is a source. Rows equal in id and
    text share their hash and so their fate. An empty table gives an empty result. Other columns
    are ignored.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    sized = docs.select(
        F.col(id).alias("_id"), F.col(source).alias("_source"),
        word_count(F.col(text)).alias("_size"),
        document_hash(F.col(id), F.col(text)).alias("_hash")).checkpoint()
    low_bits = HASH_BITS - LEVEL_BITS
    histogram = sized.groupBy(
        "_source", F.shiftright("_hash", low_bits).alias("_bucket")).agg(
        F.sum("_size").alias("_words")).checkpoint()
    wanted = targets(histogram.groupBy("_source").agg(F.sum("_words").alias("source_size")),
                     weights, share, repeats)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    plan = wanted.withColumn("_whole", F.coalesce(whole, F.lit(0))).withColumn(
        "_budget", F.col("target") - F.col("_whole") * F.col("source_size")).checkpoint()
    few = plan.count() <= MAX_BROADCAST_ROWS

    def small(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if few else table

    budgets = plan.filter(F.col("_budget") > 0).select(F.col("_source").alias("_s"), "_budget")
    edge = _boundary(histogram.join(small(budgets), F.col("_source").eqNullSafe(F.col("_s")))
                     .withColumn("_below", F.lit(0)))
    while low_bits > 0:
        step = small(edge.select(F.col("_source").alias("_s"), F.col("_bucket").alias("_prefix"),
                                 "_budget", "_below"))
        inside = sized.join(step, F.col("_source").eqNullSafe(F.col("_s"))
                            & (F.shiftright("_hash", low_bits) == F.col("_prefix")))
        low_bits -= LEVEL_BITS
        edge = _boundary(inside.groupBy(
            "_source", "_budget", "_below", F.shiftright("_hash", low_bits).alias("_bucket")).agg(
            F.sum("_size").alias("_words"))).checkpoint()
    nearer = F.col("_below") + F.col("_words") - F.col("_budget") <= (
        F.col("_budget") - F.col("_below"))
    limits = edge.select(F.col("_source").alias("_s"),
                         (F.col("_bucket") - F.when(nearer, 0).otherwise(1)).alias("_limit"))
    plan = plan.join(small(limits), F.col("_source").eqNullSafe(F.col("_s")), "left").select(
        F.col("_source").alias("_of"), "source_size", "target", "_whole",
        F.coalesce("_limit", F.lit(-1)).alias("_limit"))
    copies = F.col("_whole") + (F.col("_hash") <= F.col("_limit")).cast("long")
    return sized.join(small(plan), F.col("_source").eqNullSafe(F.col("_of"))).select(
        F.col("_id").alias(id), F.col("_size").alias("size"), "source_size", "target",
        (copies * F.col("_size")).alias("taken"), copies.alias("copies"))
