"""Benchmark items in documents, also with other numbers, names and units."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.keys import KEY, keyed, packed
from tidewire.llm.words import VALUE_OF_LOWER, blocks, mix, prefix_hashes, run_hashes, shingle_hashes
from tidewire.session import ensure_checkpoint_dir

WINDOW = 8
#: Words of a window that are no placeholders; windows with fewer say nothing. An item that has no
#: other windows is looked for as a whole.
LEAST_LITERAL = 5
#: Items with fewer tokens, or fewer words that are no placeholders, are found word for word only;
#: items with fewer than ``SHORTEST`` tokens can not be told from chance.
LEAST_TOKENS, LEAST_OWN, SHORTEST = 6, 2, 3
#: Tokens of an item that show a leak, or this share of a shorter item.
LEAK_TOKENS, LEAK_SHARE = 13, 0.8
#: Share of the placeholders that may contradict the others.
MOST_CONFLICT = 0.2
#: Template windows of a benchmark up to which all tasks get their hashes.
MAX_BROADCAST_WINDOWS = 1_000_000

UNITS = ("km kilometers kilometres m meters metres cm mm miles mile feet foot inches inch kg g "
         "grams kilograms pounds lb lbs ounces tons seconds second minutes minute hours hour days "
         "day weeks week months month years year percent dollars dollar cents euros euro pounds "
         "degrees liters litres ml gallons mph kmh km/h").split()

_CODE = np.arange(256)
_DIGIT = (_CODE >= 48) & (_CODE <= 57)
_UPPER = (_CODE >= 65) & (_CODE <= 90)
_TOKEN = _DIGIT | _UPPER | ((_CODE >= 97) & (_CODE <= 122)) | (_CODE >= 128)
_STOP = np.isin(_CODE, [ord(c) for c in ".!?:\n"])
_NUMBER, _UNIT, _NAME = (mix(np.array([n], np.uint64))[0] for n in (101, 102, 103))


def _hash_of(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate(([True], data == 32, [True])).astype(np.int8)))
    return run_hashes(prefix_hashes(VALUE_OF_LOWER[data]), edges[::2], edges[1::2])


_UNIT_HASHES = np.sort(_hash_of(UNITS))


class Tokens:
    """Template tokens of a block of texts: numbers, names and the units behind numbers are
    placeholders; names in a row are one. A name is a capitalised word that opens no sentence."""

    def __init__(self, texts: list[bytes]):
        lengths = np.fromiter((len(text) + 1 for text in texts), np.int64, len(texts))
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.data = data
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = _TOKEN[data]
        # a separator between two digits belongs to the number
        point = np.flatnonzero((data[1:-1] == 46) | (data[1:-1] == 44)) + 1
        point = point[_DIGIT[data[point - 1]] & _DIGIT[data[point + 1]]]
        inside[point + 1] = 1
        edges = np.flatnonzero(np.diff(inside))
        start, end = edges[::2], edges[1::2]
        digits = np.concatenate(([0], np.cumsum(_DIGIT[data])))
        number = digits[end] - digits[start] > 0
        stops = np.concatenate(([0], np.cumsum(_STOP[data])))
        before = np.concatenate(([0], end[:-1]))
        opens = stops[start] - stops[before] > 0
        if len(opens):
            opens[0] = True
        second = data[np.minimum(start + 1, len(data) - 1)] if len(start) else data[:0]
        capital = _UPPER[data[start]] | ((data[start] == 0xC3) & (second >= 0x80)
                                         & (second <= 0x9E))
        hashes = run_hashes(prefix_hashes(VALUE_OF_LOWER[data]), start, end)
        name = capital & ~opens & ~number
        near = np.zeros(len(start), bool)
        near[1:] = number[:-1] & (start[1:] - end[:-1] <= 1)
        unit = near & ~number & np.isin(hashes, _UNIT_HASHES)
        follows = np.zeros(len(start), bool)
        follows[1:] = name[:-1] & name[1:] & ~opens[1:]
        hashes = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, hashes)))
        keep = np.flatnonzero(~follows)
        self.hash, self.start = hashes[keep], start[keep]
        last = np.concatenate((keep[1:], [len(start)])) - 1
        self.end = end[last] if len(keep) else end[:0]
        self.slot = (number | unit | name)[keep]
        text_start = np.concatenate(([0], np.cumsum(lengths)))
        self.first = np.searchsorted(self.start, text_start)

    def slots(self, begin: int, end: int) -> list[dict]:
        """Placeholders among some tokens: place in the window and what stands there."""
        return [{"at": int(n - begin),
                 "value": self.data[self.start[n]:self.end[n]].tobytes().decode(
                     "utf-8", "replace").lower()}
                for n in begin + np.flatnonzero(self.slot[begin:end])]


_WINDOWS = "w long, size int, at int, slots array<struct<at:int,value:string>>"


def windows(rows: DataFrame, carried: list[str], sizes: list[int],
            known: np.ndarray | None = None, whole: bool = False) -> DataFrame:
    """The ``carried`` columns and template windows (hash, size, place, placeholders) of texts.

    ``sizes`` are the lengths of windows; ``whole`` keeps one length per text: the largest, or
    that of a shorter text, or all of a text whose windows have too few literal words. ``known`` are
    the only hashes of interest, sorted.
    """
    kinds = dict(rows.dtypes)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "_text"):
            tokens = Tokens(texts)
            text_of, out = [], []
            for row, (begin, end) in enumerate(zip(tokens.first[:-1], tokens.first[1:])):
                n = int(end - begin)
                if n < SHORTEST:
                    continue
                literal = np.concatenate(([0], np.cumsum(~tokens.slot[begin:end])))
                for size in ([min(n, max(sizes))] if whole else [s for s in sizes if s <= n]):
                    hashes = shingle_hashes(tokens.hash[begin:end], size).view(np.int64)
                    good = np.ones(len(hashes), bool)
                    if whole:
                        good = literal[size:] - literal[:-size] >= min(LEAST_LITERAL, size - 1)
                        if not good.any():
                            size, good = n, np.ones(1, bool)
                            hashes = shingle_hashes(tokens.hash[begin:end], n).view(np.int64)
                    if known is not None:
                        near = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                        good &= known[near] == hashes
                    for at in np.flatnonzero(good):
                        text_of.append(row)
                        out.append({"w": int(hashes[at]), "size": size, "at": int(at),
                                    "slots": tokens.slots(begin + at, begin + at + size)})
            if out:
                names = [batch.column(name).take(pa.array(text_of)) for name in carried]
                more = pa.RecordBatch.from_pylist(out, schema)
                yield pa.RecordBatch.from_arrays([*names, *more.columns],
                                                 [*carried, *schema.names])

    schema = pa.schema([("w", pa.int64()), ("size", pa.int32()), ("at", pa.int32()),
                        ("slots", pa.list_(pa.struct([("at", pa.int32()),
                                                      ("value", pa.string())])))])
    kept = ", ".join(f"{name} {kinds[name]}" for name in carried)
    selected = rows.select(*carried, F.col("_text").cast("binary").alias("_text"))
    return selected.mapInArrow(found, f"{kept}, {_WINDOWS}")


def judge(matches: list[dict], n_tokens: int) -> tuple[str, int, float] | None:
    """Kind of leak, tokens covered and share of consistent placeholders; None if it is no leak.

    Windows are grouped by the offset between document and item. Each offset that (with its
    neighbours) covers enough of the item is judged, and the strongest verdict counts: verbatim
    before changed, then the larger cover. So a torn copy does not hide a whole one elsewhere.
    """
    by_offset: dict[int, list[dict]] = {}
    for match in matches:
        by_offset.setdefault(match["at"] - match["item_at"], []).append(match)
    best: tuple[str, int, float] | None = None
    for offset in sorted(by_offset):
        # the offset's own windows last, so that they decide where neighbours say otherwise
        near = [m for d in (-2, 2, -1, 1, 0) for m in by_offset.get(offset + d, ())]
        verdict = _judge_band(near, n_tokens)
        if verdict and (best is None or (verdict[0] == "verbatim", *verdict[1:])
                        > (best[0] == "verbatim", *best[1:])):
            best = verdict
    return best


def _judge_band(near: list[dict], n_tokens: int) -> tuple[str, int, float] | None:
    """The verdict on windows of about one offset. The placeholders agree if each of the item's
    values has one value in the document and the other way round."""
    covered = len({m["item_at"] + n for m in near for n in range(m["size"])})
    if covered < min(LEAK_TOKENS, LEAK_SHARE * n_tokens):
        return None
    pairs: dict[int, tuple[str, str]] = {}
    for m in near:
        for ours, theirs in zip(m["slots"], m["item_slots"]):
            pairs[m["item_at"] + theirs["at"]] = (theirs["value"], ours["value"])
    if all(a == b for a, b in pairs.values()):
        return "verbatim", covered, 1.0
    if n_tokens < LEAST_TOKENS or n_tokens - len(pairs) < LEAST_OWN:
        return None
    forward: dict[str, dict[str, int]] = {}
    backward: dict[str, dict[str, int]] = {}
    for theirs, ours in pairs.values():
        for table, key, value in ((forward, theirs, ours), (backward, ours, theirs)):
            counts = table.setdefault(key, {})
            counts[value] = counts.get(value, 0) + 1
    agreed = min(sum(max(c.values()) for c in table.values()) for table in (forward, backward))
    share = agreed / len(pairs)
    return ("changed", covered, share) if share >= 1 - MOST_CONFLICT else None


def leaks(docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """KEY of documents and the benchmark items in them, verbatim or with other values."""
    ensure_checkpoint_dir(docs.sparkSession)
    items = benchmark.select(F.col(item_id).alias("item"),
                             F.coalesce(F.col(item_text), F.lit("")).alias("_text"))
    theirs = windows(items, ["item"], [window], whole=True).checkpoint()
    sizes = [row["size"] for row in theirs.select("size").distinct().collect()]
    rows = keyed(docs, id, text)
    known = None
    hashes = theirs.select("w").distinct()
    few = hashes.count() <= MAX_BROADCAST_WINDOWS
    if few:
        known = np.sort(hashes.toArrow().column("w").to_numpy()) if sizes else np.zeros(1, np.int64)
    ours = windows(rows, ["_id", *KEY], sizes or [window], known)
    tokens = theirs.groupBy("item").agg(F.max(F.col("at") + F.col("size")).alias("n_tokens"))
    other = theirs.join(tokens, "item").select(
        "w", "size", "item", "n_tokens", F.col("at").alias("item_at"),
        F.col("slots").alias("item_slots"))
    met = ours.join(F.broadcast(other) if few else other, ["w", "size"])
    # what a document repeats over and over is one match per place
    pairs = met.groupBy("_id", *KEY, "item", "n_tokens").agg(F.collect_set(F.struct(
        "at", "item_at", "size", "slots", "item_slots")).alias("matches"))
    kinds = dict(pairs.dtypes)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, found = [], []
            for row, (matches, n) in enumerate(zip(batch.column("matches").to_pylist(),
                                                   batch.column("n_tokens").to_pylist())):
                verdict = judge(matches, n)
                if verdict is not None:
                    kept.append(row)
                    found.append(verdict)
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(name).take(pa.array(kept)) for name in (
                        "_id", *KEY, "item", "n_tokens")),
                     pa.array([f[0] for f in found]), pa.array([f[1] for f in found], pa.int32()),
                     pa.array([f[2] for f in found], pa.float64())],
                    ["_id", *KEY, "item", "n_tokens", "kind", "covered", "consistent"])

    return pairs.mapInArrow(
        judged, f"_id {kinds['_id']}, _a {kinds['_a']}, _b long, item {kinds['item']}, n_tokens "
                "int, kind string, covered int, consistent double")


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """Which documents hold which benchmark items.

    Numbers, names and units become typed placeholders, so a question with other values has the
    same template. Windows of ``window`` tokens (all tokens of a shorter item) are joined by hash;
    a document leaks an item if the windows at one offset cover enough of it and its values stand
    in one consistent mapping to the item's.

    Returns id, item_id, kind (``verbatim`` or ``changed``), n_tokens (of the item), covered and
    consistent (share of placeholders that fit). An item whose windows are all numbers, names and
    units but for a few words is looked for as a whole. Null and empty texts leak nothing, items of
    fewer than ``LEAST_TOKENS`` tokens are found word for word only, those of fewer than
    ``SHORTEST`` never, rows equal in id and text are one document, and
    either table may be empty. Other columns are ignored.
    """
    found = leaks(docs, benchmark, id=id, text=text, item_id=item_id, item_text=item_text,
                  window=window)
    return found.select(F.col("_id").alias(id), F.col("item").alias("item_id"), "kind", "n_tokens",
                        "covered", "consistent")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id",
                      text: str = "text", **options) -> DataFrame:
    """The documents that leak no benchmark item, with all their columns, of any names.

    Texts may be of any length; rows equal in id and text go or stay together.
    """
    bad = leaks(docs, benchmark, id=id, text=text, **options).select(*KEY).distinct()
    return packed(docs, id, text).join(bad, KEY, "left_anti").select("_row.*")
