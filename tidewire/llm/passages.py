"""Repeated passages by collinear chains of shared seeds."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.collocations import _within, key_filter
from tidewire.llm.keys import KEY, keyed, packed
from tidewire.llm.words import (
    NOT_SPACE,
    blocks,
    prefix_hashes,
    run_hashes,
    shingle_hashes,
    words_of,
)
from tidewire.session import ensure_checkpoint_dir, remove_folder, scratch_folder

SEED_WORDS = 8
WINDOW = 16
LEAST_WORDS = 50
LEAST_SIMILARITY = 0.8
#: Cost of a word skipped between two seeds of a chain, on either side. A seed weighs its words.
GAP_COST = 0.1
#: Words beside a chain that alignment may still reach, and the grid that regions lie on.
MARGIN, GRID = 96, 32
#: Words of one side that differ in a row before an alignment ends, and equal words that must
#: follow them.
MOST_EDIT, RESYNC = 8, 3
#: Windows to look up, up to which all tasks get them rather than by a shuffle.
MAX_WINDOWS = 1_000_000


def seed_places(words: np.ndarray, seed: int = SEED_WORDS, window: int = WINDOW,
                ) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a text's seeds: the smallest of any ``window`` runs in a row.

    Equal texts of ``seed + window - 1`` words have a seed in common wherever they stand.
    """
    runs = shingle_hashes(words, seed)
    if len(words) < seed + window - 1:
        return np.zeros(0, np.int64), runs[:0]
    views = np.lib.stride_tricks.sliding_window_view(runs, window)
    places = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    return places, runs[places]


def seeds(rows: DataFrame, least_words: int, held: Broadcast | None = None) -> DataFrame:
    """no (whether the id is null), KEY, at and seed of every text that could hold a passage; with a
    filter ``held``, of the seeds that pass it."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "_text"):
            words = words_of(texts)
            text_of, at, hashes = [], [], []
            for row, (begin, end) in enumerate(zip(words.first[:-1], words.first[1:])):
                if end - begin >= least_words:
                    places, values = seed_places(words.hash[begin:end])
                    if held is not None:
                        pass_ = _within(held.value, values)
                        places, values = places[pass_], values[pass_]
                    text_of.append(np.full(len(places), row))
                    at.append(places)
                    hashes.append(values.view(np.int64))
            if text_of:
                take = pa.array(np.concatenate(text_of))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(name).take(take) for name in ("no", *KEY)),
                     pa.array(np.concatenate(at), pa.int32()), pa.array(np.concatenate(hashes))],
                    ["no", *KEY, "at", "seed"])

    selected = rows.select(F.col("_id").isNull().alias("no"), *KEY,
                           F.col("_text").cast("binary").alias("_text"))
    return selected.mapInArrow(
        found, f"no boolean, _a {dict(rows.dtypes)['_a']}, _b long, at int, seed long")


class _Prefixes:
    """Fenwick tree over places: the best value at any place before one."""

    def __init__(self, size: int):
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (size + 1)

    def raise_to(self, place: int, value: tuple[float, int]) -> None:
        place += 1
        while place < len(self.best):
            if value > self.best[place]:
                self.best[place] = value
            place += place & -place

    def before(self, place: int) -> tuple[float, int]:
        found = (float("-inf"), -1)
        while place > 0:
            if self.best[place] > found:
                found = self.best[place]
            place -= place & -place
        return found


def chains(matches: Sequence[tuple[int, int]], weight: float = SEED_WORDS,
           gap: float = GAP_COST) -> list[list[tuple[int, int]]]:
    """Chains of matches (place here, place there) that rise in both, best first.

    A chain scores its matches less ``gap`` for every word between them on either side, so the
    best predecessor of a match is the one with the largest score plus ``gap`` times its own
    places: a prefix maximum. Every match is in one chain.
    """
    order = sorted(set(matches), key=lambda m: (m[1], -m[0]))
    places = sorted({m[0] for m in order})
    tree = _Prefixes(len(places))
    score, previous = [0.0] * len(order), [-1] * len(order)
    for i, (here, there) in enumerate(order):
        rank = bisect_left(places, here)
        value, j = tree.before(rank)
        gain = value - gap * (here + there)
        score[i] = weight + max(0.0, gain)
        previous[i] = j if gain > 0 else -1
        tree.raise_to(rank, (score[i] + gap * (here + there), i))
    taken, result = [False] * len(order), []
    for i in sorted(range(len(order)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not taken[i]:
            taken[i] = True
            chain.append(order[i])
            i = previous[i]
        if chain:
            result.append(chain[::-1])
    return result


def _resync(x: list[int], y: list[int], i: int, j: int, step: int) -> tuple[int, int] | None:
    """The fewest words to skip on either side until ``RESYNC`` equal ones follow."""
    reach = MOST_EDIT + RESYNC
    if step > 0:
        xs, ys = x[i:i + reach], y[j:j + reach]
    else:
        xs, ys = x[max(0, i + 1 - reach):i + 1][::-1], y[max(0, j + 1 - reach):j + 1][::-1]
    places: dict[tuple, int] = {}
    for q in range(len(ys) - RESYNC + 1):
        places.setdefault(tuple(ys[q:q + RESYNC]), q)
    best: tuple[int, int, int] | None = None
    for p in range(len(xs) - RESYNC + 1):
        q = places.get(tuple(xs[p:p + RESYNC]))
        if q is not None and (best is None or p + q < best[0]):
            best = (p + q, p, q)
    return None if best is None else (i + step * best[1], j + step * best[2])


def _extend(x: list[int], y: list[int], i: int, j: int, step: int) -> tuple[int, int, int]:
    """Aligns from (i, j) in one direction; ends and equal words behind the last equal word."""
    equal, end = 0, (i, j)
    while 0 <= i < len(x) and 0 <= j < len(y):
        if x[i] == y[j]:
            equal += 1
            i, j = i + step, j + step
            end = (i, j)
        else:
            found = _resync(x, y, i, j, step)
            if found is None:
                break
            i, j = found
    return (*end, equal)


def _between(x: list[int], y: list[int]) -> int:
    """Equal words in order of two runs: a longest common subsequence, a row of bits at a time."""
    places: dict[int, int] = {}
    for place, word in enumerate(x):
        places[word] = places.get(word, 0) | 1 << place
    every = (1 << len(x)) - 1
    open_ = every
    for word in y:
        met = open_ & places.get(word, 0)
        open_ = ((open_ + met) | (open_ - met)) & every
    return len(x) - open_.bit_count()


def _blocks(x: list[int], y: list[int], chain: Sequence[tuple[int, int]],
            seed: int) -> list[list[int]]:
    """Begin and end in both texts of runs that are equal word for word, along a chain."""
    found: list[list[int]] = []
    for a, b in chain:
        n = seed
        if found:
            i, j = found[-1][2:]
            overlap = max(i - a, j - b, 0)
            a, b, n = a + overlap, b + overlap, seed - overlap
        if n <= 0 or x[a:a + n] != y[b:b + n]:
            continue
        if found and x[i:a] == y[j:b]:
            found[-1][2:] = a + n, b + n
        else:
            found.append([a, b, a + n, b + n])
    return found


def stretches(x: list[int], y: list[int], chain: Sequence[tuple[int, int]],
              least_words: int = LEAST_WORDS, least_similarity: float = LEAST_SIMILARITY,
              seed: int = SEED_WORDS) -> list[tuple[int, int, int, int, int]]:
    """Begin and end in both texts, and equal words, of the passages along a chain.

    The words between seeds are compared by longest common subsequence, those beside a passage as
    far as they keep agreeing. The chain is cut into stretches that are long and alike enough so
    that equal words less others, and less ``MOST_EDIT`` for every stretch, are most: it is cut
    where more words differ than that, unless a side would be too short or too different alone.
    """
    blocks = _blocks(x, y, chain, seed)
    if not blocks:
        return []
    a, b = blocks[0][:2]
    begins = [_extend(x, y, a - 1, b - 1, -1)]
    ends, between, agreed = [], [], True
    for (*_, i, j), (a, b, *_) in zip(blocks, blocks[1:]):
        gap_x, gap_y = x[i:a], y[j:b]
        p, q, after = _extend(gap_x, gap_y, 0, 0, 1)
        ends.append((i + p, j + q, after))
        p2, q2, before = _extend(gap_x, gap_y, a - i - 1, b - j - 1, -1)
        begins.append((i + p2, j + q2, before))
        between.append(_between(gap_x, gap_y))
        inner_x, inner_y = gap_x[p:max(p, p2 + 1)], gap_y[q:max(q, q2 + 1)]
        agreed &= (max(len(inner_x), len(inner_y)) - 2 * _between(inner_x, inner_y)) <= MOST_EDIT
    ends.append(_extend(x, y, *blocks[-1][2:], 1))
    size = np.array([c - a for a, _, c, _ in blocks])
    upto = np.cumsum(size) + np.cumsum([0, *between])
    from_x, from_y, before = (np.array(column) for column in zip(*begins))

    def value(first: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Equal words of the stretches between blocks, and their worth, -1 if they are none."""
        to_x, to_y, after = ends[last]
        wide, high = to_x - from_x[first] - 1, to_y - from_y[first] - 1
        long = np.maximum(wide, high)
        equal = upto[last] - upto[first] + size[first] + before[first] + after
        enough = (np.minimum(wide, high) >= least_words) & (equal / long >= least_similarity)
        return equal, np.where(enough, 2 * equal - long - MOST_EDIT, -1)

    chosen = []
    if agreed and value(np.array([0]), len(ends) - 1)[1][0] >= 0:
        chosen.append((0, len(ends) - 1))
    else:
        best, cut = np.zeros(len(ends) + 1, np.int64), []
        for last in range(len(ends)):
            gain = value(np.arange(last + 1), last)[1]
            total = np.where(gain < 0, -1, best[:last + 1] + gain)
            first = int(total.argmax())  # the longest of several that are as good
            cut.append(first if total[first] > best[last] else -1)
            best[last + 1] = max(best[last], total[first])
        last = len(ends) - 1
        while last >= 0:
            if cut[last] >= 0:
                chosen.append((cut[last], last))
                last = cut[last]
            last -= 1
    return [(int(from_x[first]) + 1, ends[last][0], int(from_y[first]) + 1, ends[last][1],
             int(value(np.array([first]), last)[0][0])) for first, last in chosen[::-1]]


def _chained(matches: DataFrame) -> DataFrame:
    """A row per chain: both texts, the regions to compare, and the chain in region places."""
    kind = dict(matches.dtypes)["_a"]
    # as many as a text has seeds, at most
    per_text = matches.groupBy("no", *KEY).agg(F.collect_set(F.struct(
        "src_no", "src_a", "src_b", "at", "src_at")).alias("matches"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row_of, out = [], []
            for row, found in enumerate(batch.column("matches")):
                by_source: dict[tuple, list] = {}
                for m in found.as_py():
                    by_source.setdefault((m["src_no"], m["src_a"], m["src_b"]), []).append(
                        (m["at"], m["src_at"]))
                for (src_no, src_a, src_b), pairs in by_source.items():
                    for chain in chains(pairs):
                        (here, there), (here2, there2) = chain[0], chain[-1]
                        begin, src_begin = (max(0, p - MARGIN) // GRID * GRID
                                            for p in (here, there))
                        end, src_end = (-(-(p + SEED_WORDS + MARGIN) // GRID) * GRID
                                        for p in (here2, there2))
                        row_of.append(row)
                        out.append((src_no, src_a, src_b, begin, end, src_begin, src_end,
                                    [p - begin for p, _ in chain],
                                    [p - src_begin for _, p in chain]))
            if out:
                key = [batch.column(name).take(pa.array(row_of)) for name in ("no", *KEY)]
                values = [pa.array(column, type_) for column, type_ in zip(zip(*out), (
                    pa.bool_(), batch.column("_a").type, pa.int64(), *[pa.int32()] * 4,
                    pa.list_(pa.int32()), pa.list_(pa.int32())))]
                yield pa.RecordBatch.from_arrays([*key, *values], [
                    "no", *KEY, "src_no", "src_a", "src_b", "begin", "end", "src_begin",
                    "src_end", "here", "there"])

    return per_text.mapInArrow(
        rows, f"no boolean, _a {kind}, _b long, src_no boolean, src_a {kind}, src_b long, begin "
              "int, end int, src_begin int, src_end int, here array<int>, there array<int>")


def _regions(rows: DataFrame, found: DataFrame) -> DataFrame:
    """KEY, begin, end and words (32 bits each) of the regions that chains ask for."""
    kind = dict(rows.dtypes)["_a"]
    asked = found.select(*KEY, "begin", "end").union(found.select(
        "src_a", "src_b", "src_begin", "src_end")).groupBy(*KEY).agg(
        F.collect_set(F.struct("begin", "end")).alias("asked"))
    texts = rows.select(*KEY, F.col("_text").cast("binary").alias("_text")).join(
        asked, KEY).dropDuplicates(KEY)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "_text"):
            words = words_of(texts)
            low = (words.hash & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            rows, spans, values = [], [], []
            for row, asked in enumerate(batch.column("asked").to_pylist()):
                first, last = words.first[row], words.first[row + 1]
                for span in asked:
                    rows.append(row)
                    spans.append((span["begin"], span["end"]))
                    values.append(low[first + span["begin"]:min(last, first + span["end"])]
                                  .tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name).take(pa.array(rows, pa.int64())) for name in KEY),
                 pa.array([s[0] for s in spans], pa.int32()),
                 pa.array([s[1] for s in spans], pa.int32()), pa.array(values, pa.binary())],
                [*KEY, "begin", "end", "words"])

    return texts.mapInArrow(cut, f"_a {kind}, _b long, begin int, end int, words binary")


def _best_first(chains: list[dict], regions: dict[tuple[int, int], list[int]],
                least_words: int, least_similarity: float) -> Iterator[tuple]:
    """Passages of one text: its chains, most seeds first, are aligned and cut into stretches that
    are passages, unless they lie within a passage that is already found."""
    spans: list[tuple[int, int]] = []
    order = sorted(chains, key=lambda c: (-len(c["here"]), c["src_no"], c["src_a"], c["src_b"],
                                          c["begin"], c["here"], c["there"]))
    for chain in order:
        begin, src_begin = chain["begin"], chain["src_begin"]
        first, last = begin + chain["here"][0], begin + chain["here"][-1] + SEED_WORDS
        if any(a <= first and last <= b for a, b in spans):
            continue
        for a, b, c, d, equal in stretches(
                regions[begin, chain["end"]], memoryview(chain["y"]).cast("I").tolist(),
                list(zip(chain["here"], chain["there"])), least_words, least_similarity):
            if not any(low <= begin + a and begin + b <= high for low, high in spans):
                spans.append((begin + a, begin + b))
                yield (chain["src_no"], chain["src_a"], chain["src_b"], begin + a, begin + b,
                       src_begin + c, src_begin + d, equal / max(b - a, d - c))


def _aligned(found: DataFrame, regions: DataFrame, least_words: int,
             least_similarity: float) -> DataFrame:
    """Stretches of chains whose alignment is long and alike enough, as spans of words."""
    there = regions.select(F.col("_a").alias("src_a"), F.col("_b").alias("src_b"),
                           F.col("begin").alias("src_begin"), F.col("end").alias("src_end"),
                           F.col("words").alias("y"))
    chained = found.join(there, ["src_a", "src_b", "src_begin", "src_end"]).groupBy(
        "no", *KEY).agg(F.collect_list(F.struct(
            "src_no", "src_a", "src_b", "begin", "end", "src_begin", "here", "there", "y"))
            .alias("chains"))
    own = regions.groupBy(*KEY).agg(F.collect_list(F.struct("begin", "end", "words"))
                                    .alias("regions"))
    both = chained.join(own, KEY)
    kind = dict(both.dtypes)["_a"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row_of, out = [], []
            for row in range(batch.num_rows):
                own = {(r["begin"], r["end"]): memoryview(r["words"]).cast("I").tolist()
                       for r in batch.column("regions")[row].as_py()}
                for passage in _best_first(batch.column("chains")[row].as_py(), own, least_words,
                                           least_similarity):
                    row_of.append(row)
                    out.append(passage)
            if out:
                key = [batch.column(name).take(pa.array(row_of)) for name in ("no", *KEY)]
                values = [pa.array(column, type_) for column, type_ in zip(zip(*out), (
                    pa.bool_(), batch.column("_a").type, *[pa.int64()] * 5, pa.float64()))]
                yield pa.RecordBatch.from_arrays([*key, *values], [
                    "no", *KEY, "src_no", "src_a", "src_b", "start_word", "end_word",
                    "source_start", "source_end", "similarity"])

    return both.mapInArrow(
        rows, f"no boolean, _a {kind}, _b long, src_no boolean, src_a {kind}, src_b long, "
              "start_word long, end_word long, source_start long, source_end long, "
              "similarity double")


def open_windows(places: Sequence[int], spans: Sequence[tuple[int, int]], words: int) -> np.ndarray:
    """Places from which ``words`` words could stand in one earlier text, but are in no span.

    ``places`` are those of a text's seeds that earlier texts hold. In words that one earlier text
    holds all seeds are such, and these lie at most ``WINDOW`` places apart.
    """
    at = np.unique(np.asarray(places, np.int64))
    ends = np.flatnonzero(np.diff(at, append=at[-1:] + WINDOW + 1) > WINDOW)
    begins = np.concatenate(([0], ends[:-1] + 1))
    within = words - (SEED_WORDS + WINDOW - 1)
    starts = [np.arange(max(0, low - WINDOW + 1), high - within + 1)
              for low, high in zip(at[begins].tolist(), at[ends].tolist())]
    found = np.unique(np.concatenate(starts)) if starts else at
    for begin, end in spans:
        found = found[(found < begin) | (found + words > end)]
    return found


def _asked(found: DataFrame, spans: DataFrame, words: int) -> DataFrame:
    """no, KEY and starts: the open windows of every text that has some."""
    places = found.groupBy("no", *KEY).agg(F.flatten(F.collect_list(F.transform(
        "here", lambda at: at + F.col("begin")))).alias("places"))
    taken = spans.groupBy("no", *KEY).agg(F.collect_list(F.struct("start_word", "end_word"))
                                          .alias("spans"))
    kind = dict(found.dtypes)["_a"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = [open_windows(places, [tuple(span.values()) for span in spans or ()], words)
                      for places, spans in zip(batch.column("places").to_pylist(),
                                               batch.column("spans").to_pylist())]
            open_ = pa.array([len(s) > 0 for s in starts], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("no", *KEY)),
                 pa.array(starts, pa.list_(pa.int32()))], ["no", *KEY, "starts"]).filter(open_)

    return places.join(taken, ["no", *KEY], "left").mapInArrow(
        rows, f"no boolean, _a {kind}, _b long, starts array<int>")


def _windows(rows: DataFrame, words: int, held: Broadcast | None = None,
             known: np.ndarray | None = None) -> DataFrame:
    """no, KEY, at and hash of runs of ``words`` words: those at ``starts``, or else all of them
    that pass the filter ``held`` and are ``known`` (sorted; all if None)."""
    chosen = "starts" in rows.columns

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "_text"):
            block = words_of(texts)
            sums = prefix_hashes(block.hash)
            sizes = np.diff(block.first)
            if chosen:
                asked = batch.column("starts")
                text_of = np.repeat(np.arange(len(sizes)), pc.list_value_length(asked).to_numpy())
                places = asked.flatten().to_numpy().astype(np.int64)
            else:
                text_of = np.repeat(np.arange(len(sizes)), sizes)
                places = np.arange(len(text_of)) - (block.first[:-1] - block.first[0])[text_of]
            inside = places + words <= sizes[text_of]
            text_of, places = text_of[inside], places[inside]
            start = block.first[text_of] + places
            values = run_hashes(sums, start, start + words)
            if held is not None:
                pass_ = _within(held.value, values)
                text_of, places, values = text_of[pass_], places[pass_], values[pass_]
            values = values.view(np.int64)
            if known is not None and len(known):
                near = np.minimum(np.searchsorted(known, values), len(known) - 1)
                pass_ = known[near] == values
                text_of, places, values = text_of[pass_], places[pass_], values[pass_]
            take = pa.array(text_of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name).take(take) for name in ("no", *KEY)),
                 pa.array(places, pa.int32()), pa.array(values)],
                ["no", *KEY, "at", "seed"])

    carried = ["no", *KEY, "_text", *(["starts"] if chosen else [])]
    selected = rows.withColumns({"no": F.col("_id").isNull(),
                                 "_text": F.col("_text").cast("binary")}).select(*carried)
    return selected.mapInArrow(
        found, f"no boolean, _a {dict(rows.dtypes)['_a']}, _b long, at int, seed long")


def _first_holders(sown: DataFrame) -> DataFrame:
    """seed, src_no, src_a, src_b and src_at of seeds that more than one text holds."""
    first = sown.groupBy("seed").agg(F.min(F.struct("no", *KEY, "at")).alias("src"),
                                     F.max(F.struct("no", *KEY)).alias("last"))
    return first.filter((F.col("src._a") != F.col("last._a"))
                        | (F.col("src._b") != F.col("last._b"))).select(
        "seed", F.col("src.no").alias("src_no"), F.col("src._a").alias("src_a"),
        F.col("src._b").alias("src_b"), F.col("src.at").alias("src_at"))


def _met(sown: DataFrame, holders: DataFrame) -> DataFrame:
    own = (F.col("_a") == F.col("src_a")) & (F.col("_b") == F.col("src_b"))
    return sown.join(holders, "seed").filter(~own)


def _whole_windows(rows: DataFrame, found: DataFrame, spans: DataFrame,
                   words: int) -> DataFrame | None:
    """Chains of runs of ``words`` words, each with its own first holder, from what chains of seeds
    left open; None if there are none.

    The seeds of a passage may be dealt to several earlier texts that hold parts of it. The first
    holder of a whole run holds all of it.
    """
    asked = _asked(found, spans, words).checkpoint()
    n_asked = asked.agg(F.sum(F.size("starts"))).first()[0]
    if not n_asked:
        return None
    starts = asked.drop("no")
    open_ = _windows(rows.join(F.broadcast(starts) if n_asked <= MAX_WINDOWS else starts, KEY),
                     words).distinct().checkpoint()
    hashes, known = open_.select(F.col("seed").alias("key")).distinct(), None
    n_hashes = hashes.count()
    held = rows.sparkSession.sparkContext.broadcast(key_filter(hashes, n_hashes))
    if n_hashes <= MAX_WINDOWS:
        known = np.sort(hashes.toArrow().column("key").to_numpy())
    holders = _first_holders(_windows(rows, words, held, known)).checkpoint()
    met = _met(open_, holders).checkpoint()
    return None if met.isEmpty() else _chained(met).checkpoint()


def _repeated_seeds(rows: DataFrame, least_words: int) -> Broadcast:
    """A filter that lets all seeds pass that occur more than once, and few others, so that only
    these are shuffled with their places. Beyond 32 MB it only lets more pass."""
    often = seeds(rows, least_words).groupBy(F.col("seed").alias("key")).agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").select("key").checkpoint()
    return rows.sparkSession.sparkContext.broadcast(key_filter(often, often.count()))


def _passages(rows: DataFrame, least_words: int, least_similarity: float) -> DataFrame:
    """KEY, source and spans of the passages, with _id and source_id."""
    spark = rows.sparkSession
    folder = scratch_folder(spark, "seeds")
    seeds(rows, least_words, _repeated_seeds(rows, least_words)).write.parquet(folder)
    sown = spark.read.parquet(folder)
    # written, so that the join below can split a seed that very many texts hold
    shared = _first_holders(sown).checkpoint()
    found = _chained(_met(sown, shared)).checkpoint()
    remove_folder(spark, folder)
    spans = _aligned(found, _regions(rows, found), least_words, least_similarity).checkpoint()
    more = _whole_windows(rows, found, spans, max(least_words, SEED_WORDS + WINDOW - 1))
    if more is not None:
        spans = spans.union(_aligned(more, _regions(rows, more), least_words, least_similarity))
    return spans.withColumns({"_id": F.when(~F.col("no"), F.col("_a")),
                              "source_id": F.when(~F.col("src_no"), F.col("src_a"))})


def repeated_passages(docs: DataFrame, *, id: str = "doc_id", text: str = "text",
                      least_words: int = LEAST_WORDS,
                      least_similarity: float = LEAST_SIMILARITY) -> DataFrame:
    """Passages of whole texts that an earlier document (by id, null last) holds already.

    Seeds are runs of words that any two equal stretches of 23 words share. A seed is matched with
    the first document that holds it, so a passage in many documents makes one match each, not one
    for every pair. Matches of two documents are chained and the chains aligned, and cut
    where more than ``MOST_EDIT`` words differ if that leaves passages on both sides; passages of at
    least ``least_words`` words on both sides with at least ``least_similarity`` of them equal in
    order remain. A chain within a passage that is already found is not aligned again, so a passage
    has one source. Words are runs of anything but ASCII white space with A-Z as a-z.

    Returns id, source_id, start_word, end_word (from 0, end exclusive), source_start, source_end
    and similarity. Null, empty and short texts hold no passage; repeats inside one text are not
    looked for; rows equal in id and text are one document. An empty table gives an empty result;
    other columns are ignored.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    found = _passages(keyed(docs, id, text), least_words, least_similarity)
    return found.select(F.col("_id").alias(id), "source_id", "start_word", "end_word",
                        "source_start", "source_end", "similarity")


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans, whose white space goes with them."""
    data = text.encode("utf-8", "surrogatepass")
    words = words_of([data], NOT_SPACE)
    pieces, at = [], 0
    for begin, end in sorted(spans):
        start, stop = int(words.start[begin]), int(words.end[min(end, len(words.end)) - 1])
        if stop > at:
            pieces.append(data[at:max(at, start)])
            at = stop
    pieces.append(data[at:])
    return b"".join(pieces).decode("utf-8", "replace").strip()


def drop_repeated(docs: DataFrame, *, id: str = "doc_id", text: str = "text",
                  length: str | None = "n_chars", least_words: int = LEAST_WORDS,
                  least_similarity: float = LEAST_SIMILARITY) -> DataFrame:
    """The documents without passages that earlier ones hold; texts of nothing else go.

    Columns stay as they are but for ``text`` and ``length``. The first document of a passage
    keeps it. Documents without repeats, null texts and empty ones stay untouched.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = keyed(docs, id, text)
    spans = _passages(rows, least_words, least_similarity).groupBy(*KEY).agg(F.collect_set(
        F.struct("start_word", "end_word")).alias("_spans")).checkpoint()
    marked = packed(docs, id, text).join(spans, KEY, "left")

    @F.pandas_udf("string")
    def shortened(texts, spans):
        return texts.combine(spans, lambda t, s: _without(
            t, [(x["start_word"], x["end_word"]) for x in s]))

    kept = marked.filter(F.col("_spans").isNull()).select("_row.*")
    whole = F.col("_row").getField
    cut = marked.filter(F.col("_spans").isNotNull()).select(*[
        shortened(whole(name), F.col("_spans")).alias(name) if name.lower() == text.lower()
        else whole(name).alias(name) for name in docs.columns]).filter(F.col(text) != "")
    if length and length in docs.columns:
        cut = cut.withColumn(length, F.char_length(text).cast(dict(docs.dtypes)[length]))
    return kept.unionByName(cut)
