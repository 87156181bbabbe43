"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersections of sorted arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.graph import components
from tidewire.llm.words import blocks, mix, shingle_hashes, words_of
from tidewire.session import ensure_checkpoint_dir

#: Parts of a set that hold fewer shingles are weak: many unlike sets may share them.
WEAK = 3
#: Members on a side of a tile.
TILE = 1024
#: Bits of a signature: this many a shingle of the largest set in its band, rounded up to 2**n.
BITS = 2


class Bands:
    """Size bands such that linked sets lie in one band or in neighbouring ones.

    A tile's context is the band of the larger set. Its ``parts`` are one more, and some to spare,
    than the shingles in which two linked sets of that band or the one below can differ.
    """

    def __init__(self, percent: int, largest: int):
        edges = [1]
        while edges[-1] <= 2 * largest + 2:
            edges.append(100 * edges[-1] // percent + 1)
        self.percent, self.edges = percent, np.array(edges, np.int64)
        most = self.edges[1:] - 1
        self.differ = 2 * most * (100 - percent) // (100 + percent)
        self.spare = np.maximum(1, self.differ // 8)
        self.parts = self.differ + 1 + self.spare
        self.bits = np.maximum(64, 1 << np.ceil(np.log2(BITS * most)).astype(np.int64))

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.edges, size, "right")) - 1


def tile_keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys of the tiles in which a set meets all it can be linked with.

    The universe of shingles is dealt into parts by hash; two linked sets of one context agree in
    whole parts, in more than ``spare`` of them. A set leaves out its weak parts where they are no
    more than the spare ones, so one part in common is always left.
    """
    own = bands.of(len(shingles))
    spread = mix(shingles.view(np.uint64))
    keys = []
    for band in (own, own + 1):
        if bands.differ[band] == 0:  # linked sets of this size are equal
            continue
        parts = int(bands.parts[band])
        part = (spread % np.uint64(parts)).astype(np.int64)
        held = np.bincount(part, minlength=parts)
        total = np.zeros(parts, np.uint64)
        np.add.at(total, part, mix(spread + np.uint64(band)))
        key = mix(total + mix(np.arange(parts, dtype=np.uint64) + np.uint64(band << 32)))
        weak = held < WEAK
        keys.append(key[~weak] if weak.sum() <= bands.spare[band] else key)
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def bitmap(shingles: np.ndarray, bits: int) -> bytes:
    place = mix(shingles.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(bits - 1)
    held = np.zeros(bits, np.uint8)
    held[place] = 1
    return np.packbits(held, bitorder="little").tobytes()


def _set_of(words: np.ndarray, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(words, size).view(np.int64))


def _digest(shingles: np.ndarray) -> bytes:
    """128 bits that only equal sets share, but for a negligible chance."""
    bits = shingles.view(np.uint64)
    with np.errstate(over="ignore"):
        return b"".join(int(mix(bits * np.uint64(2) + np.uint64(odd)).sum(dtype=np.uint64))
                        .to_bytes(8, "big") for odd in (1, 0x1F83D9ABFB41BD6B))


def shingle_rows(docs: DataFrame, shingle_words: int, percent: int, *, id: str,
                 text: str) -> DataFrame:
    """_id, n, digest, tiles and bitmap of the distinct word shingles of each whole text."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent, 1 << 10)
        for part, texts in blocks(batches, "_text"):
            words = words_of(texts)
            sets = [_set_of(words.hash[begin:end], shingle_words)
                    for begin, end in zip(words.first[:-1], words.first[1:])]
            largest = max(map(len, sets), default=0)
            if largest >= bands.edges[-2] // 2:
                bands = Bands(percent, largest)
            keys = [tile_keys(s, bands) if len(s) else np.zeros(0, np.uint64) for s in sets]
            offsets = np.cumsum([0, *map(len, keys)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_digest(s) for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(offsets, pa.array(
                     np.concatenate(keys).view(np.int64), pa.int64())),
                 pa.array([bitmap(s, int(bands.bits[bands.of(len(s))])) if len(s) else b""
                           for s in sets], pa.binary())],
                ["_id", "n", "digest", "tiles", "bitmap"])

    chosen = docs.select(F.col(id).alias("_id"), F.col(text).cast("binary").alias("_text"))
    kind = dict(chosen.dtypes)["_id"]
    return chosen.mapInArrow(
        rows, f"_id {kind}, n long, digest binary, tiles array<long>, bitmap binary")


def _folded(maps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of words, all folded to the shortest."""
    least = min(map(len, maps))
    rows = [np.frombuffer(one, np.uint64).reshape(-1, least // 8) for one in maps]
    return np.stack([np.bitwise_or.reduce(one) if len(one) > 1 else one[0] for one in rows])


def may_link(n: np.ndarray, maps: np.ndarray, one: int, others: np.ndarray,
             percent: int) -> np.ndarray:
    """Which of ``others`` the member ``one`` can be linked with.

    A bit that only one side has set is a shingle that the other side has not, so the sizes less
    such bits bound the overlap from above.
    """
    m = n[others]
    alone = np.bitwise_count(maps[one] & ~maps[others]).sum(axis=1, dtype=np.int64)
    other = np.bitwise_count(maps[others] & ~maps[one]).sum(axis=1, dtype=np.int64)
    overlap = np.minimum(n[one] - alone, m - other)
    return 100 * overlap >= percent * (n[one] + m - overlap)


class Forest:
    """Which members are connected so far."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def apart(self, one: int, others: np.ndarray) -> np.ndarray:
        return others[self.label[others] != self.label[one]]

    def join(self, one: int, other: int) -> bool:
        mine, its = self.label[one], self.label[other]
        if mine == its:
            return False
        self.label[self.label == its] = mine
        return True


def _tree(n: np.ndarray, maps: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs that connect all members that may be linked, directly or through others; of ``side``
    1 and 0, if both occur, only pairs across are compared."""
    forest, found = Forest(len(n)), []
    for one in np.flatnonzero(side == side.max()):
        others = np.arange(one) if side.min() == side.max() else np.flatnonzero(side == side.min())
        others = forest.apart(one, others)
        if len(others):
            for other in others[may_link(n, maps, one, others, percent)]:
                if forest.join(one, other):
                    found.append((one, other))
    return found


def _dealt(members: DataFrame, size: int = TILE) -> DataFrame:
    """Members (group, of, ...) of groups of ``of``, in tiles (group, i, j, side): one tile for a
    group of up to ``size``, else one for each pair of its blocks, dealt by hash."""
    blocks_ = F.ceil(F.col("of") / size).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks_).cast("int")
    every = F.transform(F.sequence(F.lit(0), blocks_ - 1), lambda other: F.struct(
        F.least(own, other).alias("i"), F.greatest(own, other).alias("j"),
        F.when(own > other, 1).otherwise(0).alias("side")))
    return members.select("*", F.explode(every).alias("cell")).select(*members.columns, "cell.*")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of the rows of one or more whole tiles (group, i, j) from sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(c)[batch.num_rows - 1].as_py() for c in ("group", "i", "j")]
        same = np.ones(batch.num_rows, bool)
        for name, value in zip(("group", "i", "j"), last):
            same &= batch.column(name).to_numpy(zero_copy_only=False) == value
        begin = batch.num_rows - int(same.sum())
        if begin or (held and [held[-1].column(c)[0].as_py() for c in ("group", "i", "j")] != last):
            yield pa.Table.from_batches([*held, batch.slice(0, begin)])
            held = []
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def _tiles(table: pa.Table) -> Iterator[slice]:
    if table.num_rows:
        edge = np.zeros(table.num_rows, bool)
        for name in ("group", "i", "j"):
            values = table.column(name).to_numpy()
            edge[1:] |= values[1:] != values[:-1]
        edges = [0, *np.flatnonzero(edge), table.num_rows]
        yield from (slice(begin, end) for begin, end in zip(edges[:-1], edges[1:]))


def candidates(nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of nodes that bitmaps do not rule out; all such pairs of a tile are connected by
    those given, of which there are fewer than members of the tile."""
    spread = nodes.select("node", F.explode("tiles").alias("group"))
    of = F.count(F.lit(1)).over(Window.partitionBy("group"))
    met = spread.withColumn("of", of).filter("of > 1")
    members = _dealt(met.join(nodes.select("node", "n", "bitmap"), "node"))

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches):
            node, n, side = (table.column(name).to_numpy() for name in ("node", "n", "side"))
            maps, ends = table.column("bitmap"), []
            for tile in _tiles(table):
                held = _folded(maps[tile.start:tile.stop].to_pylist())
                ends += [(node[tile][one], node[tile][other])
                         for one, other in _tree(n[tile], held, side[tile], percent)]
            if ends:
                pairs = np.array(ends, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], ["a", "b"])

    placed = members.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
    return placed.mapInArrow(trees, "a long, b long").distinct()


def overlaps(one: np.ndarray, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many shingles a set shares with each of some others, all as sorted arrays, the others
    behind one another."""
    place = np.minimum(np.searchsorted(one, values), len(one) - 1)
    hits = np.concatenate(([0], np.cumsum(one[place] == values)))
    return hits[offsets[1:]] - hits[offsets[:-1]]


def _links(sets: list[np.ndarray], maps: np.ndarray, side: np.ndarray,
           percent: int) -> list[tuple[int, int]]:
    """Links that connect all linked members of a tile; across its sides only, if it has two."""
    n = np.array([len(s) for s in sets])
    forest, found = Forest(len(n)), []
    for one in np.flatnonzero(side == side.max()):
        others = np.arange(one) if side.min() == side.max() else np.flatnonzero(side == side.min())
        others = forest.apart(one, others)
        if len(others):
            others = others[may_link(n, maps, one, others, percent)]
        for begin in range(0, len(others), 64):
            some = forest.apart(one, others[begin:begin + 64])
            if not len(some):
                continue
            offsets = np.concatenate(([0], np.cumsum(n[some])))
            common = overlaps(sets[one], np.concatenate([sets[o] for o in some]), offsets)
            linked = 100 * common >= percent * (n[one] + n[some] - common)
            found += [(one, other) for other in some[linked] if forest.join(one, other)]
    return found


def _sets(docs: DataFrame, wanted: DataFrame, shingle_words: int, id: str, text: str) -> DataFrame:
    """(digest, shingles, bitmap) of the documents whose ids are wanted, from their whole texts."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in blocks(batches, "_text"):
            words = words_of(texts)
            sets = [_set_of(words.hash[begin:end], shingle_words)
                    for begin, end in zip(words.first[:-1], words.first[1:])]
            offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets), pa.int64()))],
                ["digest", "shingles"])

    ids = wanted.select(F.col("_id").alias("_wanted")).distinct()
    texts = docs.select(F.col(id).alias("_id"), F.col(text).cast("binary").alias("_text")).join(
        ids, F.col("_id").eqNullSafe(F.col("_wanted")), "left_semi").select("_text")
    return texts.mapInArrow(rows, "digest binary, shingles array<long>")


def links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, *, shingle_words: int, percent: int,
          id: str, text: str) -> DataFrame:
    """(a, b): links between nodes that connect all that are linked, confirmed on full sets.

    Nodes connected by candidate pairs form a family; a family's full sets meet in one tile, or in
    tiles of pairs of its blocks.
    """
    families = components(pairs).checkpoint()
    sizes = families.groupBy("component").agg(F.count(F.lit(1)).alias("of"))
    named = families.join(sizes, "component").select("node", F.col("component").alias("group"), "of")
    wanted = named.join(nodes.select("node", "_id", "digest"), "node").checkpoint()
    sets = _sets(docs, wanted, shingle_words, id, text).join(
        wanted.select("digest", "node", "group", "of"), "digest").dropDuplicates(["node"])

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches):
            node, side = (table.column(name).to_numpy() for name in ("node", "side"))
            column, ends = table.column("shingles"), []
            for tile in _tiles(table):
                held = [row.values.to_numpy() for row in column[tile.start:tile.stop]]
                bits = int(max(64, 1 << (8 * max(map(len, held)) - 1).bit_length()))
                maps = _folded([bitmap(s, bits) for s in held])
                ends += [(node[tile][one], node[tile][other])
                         for one, other in _links(held, maps, side[tile], percent)]
            if ends:
                found = np.array(ends, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.min(axis=1)), pa.array(found.max(axis=1))], ["a", "b"])

    placed = _dealt(sets.select("node", "group", "of", "shingles")).repartition(
        "group", "i", "j").sortWithinPartitions("group", "i", "j")
    return placed.mapInArrow(confirmed, "a long, b long")


def jaccard_components(docs: DataFrame, *, id: str = "doc_id", text: str = "text",
                       shingle_words: int = 3, percent: int = 90) -> DataFrame:
    """Documents connected by links between those whose word shingle sets are similar.

    Words are runs of anything but ASCII white space, with A-Z as a-z; the set of a text with fewer
    words than a shingle is its whole sequence. Two documents are linked if
    100 * intersection >= ``percent`` * union. Equal sets collapse first. Sets are banded by size;
    in each band they meet in tiles of equal parts of their sets, of which linked sets always share
    one, so no link is lost. In a tile bit counts of hashed bitmaps bound the overlap from above;
    what they leave is confirmed by intersecting the full sets as sorted arrays.

    Returns one row per input row: id, n_shingles and component_id (the smallest id reachable).
    Null texts and texts without words have no shingles and are linked with nothing; texts of any
    length are read whole. Rows without an id count for similarity but never name a component that
    has an id. Rows that repeat an id are the same document. An empty table gives an empty
    result; other columns are ignored, whatever their names.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = shingle_rows(docs, shingle_words, percent, id=id, text=text).checkpoint()
    held = rows.filter("n > 0").groupBy("digest").agg(
        F.min("_id").alias("_id"), F.first("n").alias("n"), F.first("tiles").alias("tiles"),
        F.first("bitmap").alias("bitmap"))
    nodes = held.withColumn("node", F.monotonically_increasing_id()).checkpoint()
    pairs = candidates(nodes, percent).checkpoint()
    named = nodes.select("digest", "_id", "node")
    if not pairs.isEmpty():
        found = links(docs, nodes, pairs, shingle_words=shingle_words, percent=percent, id=id,
                      text=text).checkpoint()
        if not found.isEmpty():
            named = named.join(components(found), "node", "left")
            named = named.withColumn("component", F.coalesce("component", "node"))
            first = named.groupBy("component").agg(F.min("_id").alias("_id"))
            named = named.select("digest", "component").join(first, "component")
    named = named.select("digest", F.col("_id").alias("_first"))
    out = rows.select("_id", "n", "digest").join(named, "digest", "left")
    return out.select(F.col("_id").alias(id), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") == 0, F.col("_id")).otherwise(F.col("_first"))
                      .alias("component_id"))
