"""Phrase collocations from depth-truncated suffix subtrees, built group by group of word prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.words import NOT_SPACE, Words, blocks, mix, words_of
from tidewire.session import ensure_checkpoint_dir

#: Bytes that end a piece; words are runs of others but space and tab.
PIECE_ENDS = np.isin(np.arange(256), [*b".,;:!?", *range(10, 14)])
WORD_BYTES = NOT_SPACE & ~PIECE_ENDS
#: Leaves of the suffix tree that one group of prefixes may hold: the memory budget of a task.
BUDGET = 400_000
#: Groups at most; beyond, the budget grows. It bounds the list of prefixes that are too heavy.
MOST_GROUPS = 100_000
#: Whole texts of about so many bytes are read together.
SCAN_BYTES = 1 << 19
#: Pairs, or suffixes, that a task counts before it passes them on; some 50 bytes each, three times
#: over while they are added up. What is passed on early is added up before the shuffle all the same.
HELD = 1 << 18
#: Bits of the filter of frequent words and pairs: so many each, within bounds (8 KB and 32 MB).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28
#: Parts in which each language's best phrases are ranked before the winners meet.
RANKING_PARTS = 256


def _tongues(part: pa.RecordBatch, words: Words) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Per word: number of its language among those of the block, and that language's hash."""
    held = part.column("lang").dictionary_encode()
    names, number = held.dictionary.to_pylist(), held.indices.to_numpy()
    hashes = np.array([int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "big")
                       for name in names], np.uint64)
    of = np.repeat(number, np.diff(words.first))
    return of, hashes[of], names


def _keys(words: Words, tongue: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each word and of it with its next, and whether that stands in the same piece."""
    ends = np.concatenate(([0], np.cumsum(PIECE_ENDS[words.data])))
    joined = np.zeros(len(words.hash), bool)
    joined[:-1] = ends[words.start[1:]] == ends[words.end[:-1]]
    last = words.first[1:] - 1
    joined[last[last >= 0]] = False
    single = mix(words.hash + tongue)
    return single, mix(single + np.uint64(3) * np.append(words.hash[1:], np.uint64(0))), joined


def _summed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row for each key, with the sum of n; ``held`` is emptied, so that its rows do not stay in
    memory beside their copy."""
    rows = pa.concat_batches(held)
    held.clear()
    keys = rows.column("key").to_numpy()
    _, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
    n = np.bincount(inverse, rows.column("n").to_numpy()).astype(np.int64)
    return rows.take(pa.array(at)).set_column(rows.schema.get_field_index("n"), "n", pa.array(n))


def _combined(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (key, n, ...) with those of one key added up, as far as they are held together."""
    held, rows = [], 0
    for part in parts:
        held.append(part)
        rows += part.num_rows
        if rows > HELD:
            held = [_summed(held)]
            rows = held[0].num_rows
            if rows > HELD // 2:
                yield held.pop()
                rows = 0
    if held:
        yield _summed(held)
    # the worker goes on to other tasks
    pa.default_memory_pool().release_unused()


def frequent(docs: DataFrame, least: int) -> DataFrame:
    """(key): hashes of the words, and pairs of words within pieces, that occur ``least`` times in a
    language."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> Iterator[pa.RecordBatch]:
            for part, texts in blocks(batches, "text", SCAN_BYTES):
                words = words_of(texts, WORD_BYTES)
                single, pair, joined = _keys(words, _tongues(part, words)[1])
                keys, n = np.unique(np.concatenate((single, pair[joined])), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

        yield from _combined(counted())

    counts = docs.mapInArrow(rows, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least).select("key")


def key_filter(keys: DataFrame, count: int) -> np.ndarray:
    """One bit for each value that ``keys`` have modulo its size, as bytes. Its size follows their
    number up to 32 MB; beyond, it only lets more pass."""
    bits = 1 << max(1, BITS_EACH * count - 1).bit_length()
    bits = min(max(bits, LEAST_BITS), MOST_BITS)
    place = keys.select((F.pmod("key", F.lit(bits)) + 1).alias("place"))
    found = place.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
    held = np.zeros(bits // 8, np.uint8)
    for bucket, bitmap in found.collect():  # bits / 32,768 rows of 4 KB
        begin = (bucket - 1) * 4096
        held[begin:begin + 4096] = np.frombuffer(bytes(bitmap), np.uint8)[:len(held) - begin]
    return held


def _within(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys & np.uint64(8 * len(held) - 1)
    return (held[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of some runs behind one another, and where each begins; one more entry at the end."""
    offsets = np.concatenate(([0], np.cumsum(size)))
    return data[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])], offsets


def leaves(docs: DataFrame, held, most_words: int) -> DataFrame:
    """(lang, phrase, n): the suffixes that begin at each frequent word, cut after ``most_words``
    words, at the end of the piece, or where no frequent pair goes on; and how often each occurs.

    What is left out or cut off is part of no frequent phrase. The empty phrase stands for the
    root: all words of the language.
    """
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32

    def suffixes(part: pa.RecordBatch, words: Words) -> pa.RecordBatch:
        number, tongue, names = _tongues(part, words)
        key, pair, joined = _keys(words, tongue)
        begins = _within(held.value, key)
        goes_on = joined & _within(held.value, pair)
        depth, reached = np.ones(len(key), np.int64), begins.copy()
        for ahead in range(1, most_words):
            reached[:-ahead] &= goes_on[ahead - 1:-1]
            reached[-ahead:] = False
            further = np.zeros_like(key)
            further[:-ahead] = words.hash[ahead:]
            depth += reached
            key = np.where(reached, mix(key + np.uint64(3) * further), key)
        # the block's words with one space after each
        data, begin = _gathered(words.data, words.start, words.end - words.start + 1)
        data = lower[data]
        data[begin[1:] - 1] = 32
        some = np.flatnonzero(begins)
        _, first, n = np.unique(key[some], return_index=True, return_counts=True)
        at = some[first]
        phrase, offsets = _gathered(data, begin[at], begin[at + depth[at]] - 1 - begin[at])
        phrases = pa.StringArray.from_buffers(
            len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(phrase))
        roots = np.unique(number)
        of = np.concatenate((number[at], roots)).astype(np.int32)
        _, place = np.unique(number, return_index=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((key[at], tongue[place])).view(np.int64)),
             pa.DictionaryArray.from_arrays(of, names).cast(pa.string()),
             pa.concat_arrays([phrases, pa.array([""] * len(roots), pa.string())]),
             pa.array(np.concatenate((n, np.bincount(number)[roots])).astype(np.int64))],
            ["key", "lang", "phrase", "n"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = ((part, words_of(texts, WORD_BYTES))
                for part, texts in blocks(batches, "text", SCAN_BYTES))
        counted = (suffixes(part, words) for part, words in read if len(words.hash))
        for out in _combined(counted):
            yield out.select(["lang", "phrase", "n"])

    found = docs.mapInArrow(rows, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def prefix_groups(suffixes: DataFrame, most_words: int, budget: int) -> DataFrame:
    """The leaves with the depth of their prefix and the group that holds it.

    A prefix is the first word of a suffix; one with more leaves than an eighth of the budget is
    extended by the next word, as often as needed. Prefixes are dealt by hash into as many groups
    as the leaves have budgets, so a group holds about one budget, and three by a rare chance only.
    """
    total = suffixes.count()
    budget = max(budget, total // MOST_GROUPS)
    groups = -(-total // budget) or 1
    rows = suffixes.withColumn("depth", F.lit(1))
    parts = F.split("phrase", " ")
    for depth in range(1, most_words):
        named = rows.withColumn("prefix", F.xxhash64("lang", F.array_join(
            F.slice(parts, 1, depth), " ")))
        # at most eight a group; prefixes of equal hash are only extended earlier
        heavy = named.groupBy("prefix").agg(
            F.count_if(F.col("depth") == depth).alias("leaves")).filter(
            F.col("leaves") > budget // 8).select("prefix", F.lit(True).alias("heavy")).checkpoint()
        if heavy.isEmpty():
            break
        rows = named.join(F.broadcast(heavy), "prefix", "left").select(
            "lang", "phrase", "n", F.when(F.col("heavy"), F.lit(depth + 1)).otherwise(
                F.col("depth")).alias("depth"))
    prefix = F.array_join(F.slice(parts, F.lit(1), F.col("depth")), " ")
    return rows.withColumn("group", F.pmod(F.xxhash64("lang", prefix), F.lit(groups)))


def subtree(table: pa.Table, least: int, most_words: int) -> pa.Table:
    """(lang, phrase, words, n) of the nodes over some leaves (lang, phrase, n, depth of the prefix):
    from the deepest level up, a node's count is its own leaf's plus those of its children. Nodes
    above the prefix of a leaf are partial, whatever their count, and given as such."""
    words = pc.add(pc.count_substring(table.column("phrase"), " "), 1)
    table = table.select(["lang", "phrase", "n", "depth"])
    below, out = table.slice(0, 0), []
    for level in range(most_words, 0, -1):
        here = pa.concat_tables([table.filter(pc.equal(words, level)), below])
        summed = here.group_by(["lang", "phrase"]).aggregate([("n", "sum"), ("depth", "max")])
        nodes = pa.table({"lang": summed["lang"], "phrase": summed["phrase"], "n": summed["n_sum"],
                          "depth": summed["depth_max"]}).cast(table.schema)
        shown = nodes.filter(pc.or_(pc.greater_equal(nodes["n"], least),
                                    pc.greater(nodes["depth"], level)))
        out.append(pa.table({"lang": shown["lang"], "phrase": shown["phrase"],
                             "words": pa.array(np.full(len(shown), level, np.int32)),
                             "n": shown["n"]}))
        parent = pc.replace_substring_regex(nodes["phrase"], " [^ ]*$", "")
        below = nodes.set_column(1, "phrase", parent)
    return pa.concat_tables(out)


def phrase_counts(groups: DataFrame, least: int, most_words: int) -> DataFrame:
    """(lang, phrase, words, n) of all phrases that occur ``least`` times, from the subtrees."""
    def build(table: pa.Table) -> pa.Table:
        return subtree(table, least, most_words)

    nodes = groups.groupBy("group").applyInArrow(
        build, "lang string, phrase string, words int, n long")
    return nodes.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= least)


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of the phrases of two words or more, by their worst cut;
    of equally bad ones the first."""
    parts = F.split("phrase", " ")
    cuts = counts.filter("words > 1").select(
        "lang", "phrase", "words", F.col("n").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), parts.alias("parts")).select(
        "lang", "phrase", "words", "a", "k", F.array_join(F.slice("parts", 1, F.col("k")), " ")
        .alias("first"), F.array_join(F.slice("parts", F.col("k") + 1, F.col("words")), " ")
        .alias("rest"))
    for name, column in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(name),
                                       F.col("n").alias(column)), ["lang", name])
    # products may pass 64 bits
    wide = {name: F.col(name).cast("decimal(19,0)") for name in "alr"}
    score = F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * wide["a"],
                            wide["l"] + wide["r"])
    worst = cuts.select("lang", "phrase", "words", "a", F.struct(score.alias("score"), "k", "l", "r")
                        .alias("cut")).groupBy("lang", "phrase", "words", "a").agg(
        F.min("cut").alias("cut"))
    return worst.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def covered(counts: DataFrame, most_words: int, percent: int) -> DataFrame:
    """(lang, phrase): phrases that stand inside a longer one with ``percent`` of their count."""
    parts = F.split("phrase", " ")
    spans = F.array(*[F.struct(F.lit(begin).alias("begin"), F.lit(size).alias("size"))
                      for size in range(2, most_words) for begin in range(1, most_words)
                      if begin + size - 1 <= most_words])
    inner = counts.filter("words > 2").select(
        "lang", "words", F.col("n").alias("longer"), parts.alias("parts"),
        F.explode(spans).alias("span")).filter(
        "span.size < words AND span.begin + span.size - 1 <= words").select(
        "lang", "longer", F.array_join(F.slice("parts", F.col("span.begin"), F.col("span.size")),
                                       " ").alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return most.join(counts.select("lang", "phrase", "n"), ["lang", "phrase"]).filter(
        F.col("longer").cast("decimal(19,0)") * 100
        >= F.col("n").cast("decimal(19,0)") * percent).select("lang", "phrase")


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", most_words: int = 4,
                 least: int = 30, percent: int = 80, top: int = 2000,
                 budget: int = BUDGET) -> DataFrame:
    """Each language's best phrases of two to ``most_words`` words.

    A-Z count as a-z; texts are cut at ``.,;:!?`` and line ends into pieces, and those at spaces and
    tabs into words. A phrase that occurs ``least`` times is cut in two at each place; its score
    is two million times its count over the sum of its parts' counts, rounded down, at the worst
    place. Phrases inside a longer one that occurs ``percent`` percent as often are dropped. The
    suffixes at all words are cut to ``most_words`` words, dealt into groups of prefixes by a
    memory budget, and counted in one subtree a group.

    Returns lang, rank, phrase (words joined by a space), a (its count), l and r (its parts'), n
    (words of the language) and score. A null language counts as ``und``; null and empty texts
    have no words; texts of any length are read whole; repeated rows count each time; an empty
    table gives an empty result; other columns are ignored. Equal scores go by count, then by the
    phrase's bytes.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
                        F.col(text).cast("binary").alias("text"))
    keys = frequent(texts, least).checkpoint()
    held = spark.sparkContext.broadcast(key_filter(keys, keys.count()))
    suffixes = leaves(texts, held, most_words).checkpoint()
    below = suffixes.filter("phrase != ''")
    counts = phrase_counts(prefix_groups(below, most_words, budget), least,
                           most_words).checkpoint()
    totals = suffixes.filter("phrase = ''").select("lang", "n")
    kept = scored(counts).join(covered(counts, most_words, percent), ["lang", "phrase"], "left_anti")
    best = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANKING_PARTS))
    leading = kept.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", part).orderBy(*best))).filter(F.col("rank") <= top)
    ranked = leading.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
