"""Near duplicates by bottom-k sketches, inverted lists and exact checks."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.graph import components
from tidewire.llm.keys import KEY, keyed, packed
from tidewire.llm.words import blocks, mix, shingle_hashes, words_of
from tidewire.session import ensure_checkpoint_dir

SKETCH = 48
#: Wanted documents up to which their ids are sent to all tasks rather than joined by a shuffle.
MAX_WANTED = 1_000_000
#: Members of a list with which all others are compared first.
STARS = 4
#: Members from which an open list is compared in cells; those of a shorter one are joined.
LONG_LIST = 64
#: Retained values that a cell compares, and members on a side of it.
FINE_SKETCH, CELL = 512, 256


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """The distinct word shingles of each text, as sorted hashes; A-Z count as a-z."""
    words = words_of(texts)
    for begin, end in zip(words.first[:-1], words.first[1:]):
        yield np.unique(shingle_hashes(words.hash[begin:end], size).view(np.int64))


def signature(shingles: np.ndarray) -> bytes:
    """128 bits that equal sets share and different sets, but for a negligible chance, do not."""
    bits = shingles.view(np.uint64)
    with np.errstate(over="ignore"):
        return b"".join(int(mix(bits + salt).sum(dtype=np.uint64)).to_bytes(8, "big")
                        for salt in (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)))


def sketches(docs: DataFrame, shingle_words: int, *, id: str, text: str,
             size: int = SKETCH) -> DataFrame:
    """_id, KEY, n_shingles, signature and the ``size`` smallest shingle hashes of each whole text."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "_text"):
            sets = list(shingle_sets(texts, shingle_words))
            offsets = np.cumsum([0, *(min(size, len(s)) for s in sets)], dtype=np.int32)
            smallest = np.concatenate([s[:size] for s in sets])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("_id", *KEY)),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([signature(s) for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(offsets, pa.array(smallest, pa.int64()))],
                ["_id", *KEY, "n_shingles", "signature", "sketch"])

    selected = keyed(docs, id, text).withColumn("_text", F.col("_text").cast("binary"))
    kind = dict(selected.dtypes)["_id"]
    return selected.mapInArrow(rows, f"_id {kind}, _a {kind}, _b long, n_shingles long, "
                                     "signature binary, sketch array<long>")


def _share_needed(similarity: float, size: int = SKETCH) -> float:
    """Share of a sketch that similar sets have in common, with room for chance. Fewest values agree
    where one set holds the other: of each ``size`` retained ones about the similarity j. Five
    standard deviations less are needed, and never less than one value."""
    room = 5 * math.sqrt(similarity * (1 - similarity) / size)
    return max(similarity - room, 1 / size)


def inverted_lists(nodes: DataFrame, similarity: float) -> DataFrame:
    """(value, node, n, place): the retained values by which similar sets can meet.

    Sketches that agree in a needed number o of their values must already agree among the
    k - o + 1 rarest, so common values are left to documents that hold little else. Values of one
    document only lead nowhere and are dropped.
    """
    values = nodes.select("node", "n", F.size("sketch").alias("k"),
                          F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ranked = values.join(shared, "value").withColumns({
        "place": F.row_number().over(Window.partitionBy("node").orderBy("df", "value")),
        "n_shared": F.count(F.lit(1)).over(Window.partitionBy("node"))})
    needed = F.ceil(F.col("k") * _share_needed(similarity))
    prefix = F.col("k") - needed + 1 - (F.col("k") - F.col("n_shared"))
    return ranked.filter(F.col("place") <= prefix).select("value", "node", "n", "place")


def _alike_in_size(one: Column, other: Column, similarity: float) -> Column:
    return F.least(one, other) >= similarity * F.greatest(one, other)


def _estimated(pairs: DataFrame, nodes: DataFrame, similarity: float, size: int) -> DataFrame:
    """Pairs whose similarity, estimated on the sketch of their union, is not far too low.

    The union of two sketches holds all small values of the union of the sets, up to the largest
    value of the shorter-reaching one; the share of these that both have estimates the similarity.
    """
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(
            F.col("node").alias(side), F.col("sketch").alias(f"s{side}"),
            F.when(F.size("sketch") < size, F.lit((1 << 63) - 1)).otherwise(
                F.element_at("sketch", -1)).alias(f"to_{side}")), side)
    reach = F.least("to_a", "to_b")
    union = F.size(F.filter(F.array_union("sa", "sb"), lambda x: x <= reach))
    both = F.size(F.filter(F.array_intersect("sa", "sb"), lambda x: x <= reach))
    return pairs.filter(both >= 0.65 * similarity * union).select("a", "b")


def _sets(docs: DataFrame, wanted: DataFrame, shingle_words: int, id: str, text: str,
          most: int | None = None) -> DataFrame:
    """(node, n, shingles) of the wanted nodes (node, _id), from the whole texts: all shingles, or
    the ``most`` smallest."""
    ids = wanted.select(F.col("_id").alias("_wanted")).distinct()
    if ids.count() <= MAX_WANTED:
        ids = F.broadcast(ids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "_text"):
            sets = list(shingle_sets(texts, shingle_words))
            held = [s[:most] for s in sets]
            offsets = np.cumsum([0, *map(len, held)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([signature(s) for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(held), pa.int64()))],
                ["node", "n", "shingles"])

    texts = docs.select(F.col(id).alias("_id"), F.col(text).cast("binary").alias("_text")).join(
        ids, F.col("_id").eqNullSafe(F.col("_wanted")), "left_semi").select("_text")
    found = texts.mapInArrow(rows, "node binary, n long, shingles array<long>")
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = np.zeros(batch.num_rows, bool)
            for row, (one, other) in enumerate(zip(batch.column("_a"), batch.column("_b"))):
                x, y = (side.values.to_numpy(zero_copy_only=False) for side in (one, other))
                common = len(np.intersect1d(x, y, assume_unique=True))
                kept[row] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side),
                                       F.col("shingles").alias(f"_{side}")), side)
    return pairs.mapInArrow(check, "a binary, b binary")


def _confirmed(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, *, percent: int,
               shingle_words: int, id: str, text: str, size: int) -> DataFrame | None:
    """The links among candidate pairs (a, b): first by estimate, then on the full sets."""
    pairs = _estimated(pairs.distinct(), nodes, percent / 100, size).checkpoint()
    if pairs.isEmpty():
        return None
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _sets(docs, wanted.join(nodes.select("node", "_id"), "node"), shingle_words, id, text)
    return _verified(pairs, sets, percent).checkpoint()


def _star_pairs(postings: DataFrame, similarity: float) -> DataFrame:
    """Every member of a list with a few of them, chosen by hash."""
    pivots = postings.groupBy("value").agg(
        F.count(F.lit(1)).alias("members"),
        *[F.min_by(F.struct("node", "n"), F.xxhash64("node", F.lit(star))).alias(f"p{star}")
          for star in range(STARS)]).filter("members > 1")
    met = postings.join(pivots, "value").select(
        "node", "n", F.explode(F.array_distinct(F.array(*[f"p{star}" for star in range(STARS)])))
        .alias("pivot"))
    met = met.filter((F.col("node") != F.col("pivot.node"))
                     & _alike_in_size(F.col("n"), F.col("pivot.n"), similarity))
    return met.select(F.least("node", "pivot.node").alias("a"),
                      F.greatest("node", "pivot.node").alias("b"))


def _open_lists(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings of lists with several components, with the component of each, the members of
    the list, those outside its largest component, and whether that holds this one."""
    lists = postings.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    parts = lists.groupBy("value", "component").agg(F.count(F.lit(1)).alias("size"))
    open_ = parts.groupBy("value").agg(
        F.sum("size").alias("members"), F.max("size").alias("largest"),
        F.max_by("component", F.struct("size", "component")).alias("major"),
        F.count(F.lit(1)).alias("parts")).filter("parts > 1").select(
        "value", "members", (F.col("members") - F.col("largest")).alias("minors"), "major")
    return lists.join(open_, "value").withColumn("minor", F.col("component") != F.col("major"))


def _open_pairs(lists: DataFrame, similarity: float) -> DataFrame:
    """All pairs of one list in different components, each at the first list they share."""
    before = Window.partitionBy("node").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1)
    members = lists.withColumn("earlier", F.collect_list("value").over(before))
    others = members.select("value", F.col("node").alias("b"), F.col("n").alias("n_b"),
                            F.col("component").alias("of_b"), F.col("earlier").alias("earlier_b"))
    return members.join(others, "value").filter(
        (F.col("node") < F.col("b")) & (F.col("component") != F.col("of_b"))
        & _alike_in_size(F.col("n"), F.col("n_b"), similarity)
        & ~F.arrays_overlap("earlier", "earlier_b")).select(F.col("node").alias("a"), "b")


def _common(ones: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """How many values each of ``ones`` has in common with each of ``others``."""
    both = np.intersect1d(np.unique(np.concatenate(ones)), np.unique(np.concatenate(others)))
    found = np.zeros((len(ones), len(others)), np.float32)

    def held(sketches: list[np.ndarray], values: np.ndarray) -> np.ndarray:
        marks = np.zeros((len(sketches), len(values)), np.float32)
        for row, sketch in enumerate(sketches):
            places = np.minimum(np.searchsorted(values, sketch), len(values) - 1)
            marks[row, places[values[places] == sketch]] = 1
        return marks

    for begin in range(0, len(both), 4096):
        values = both[begin:begin + 4096]
        found += held(ones, values) @ held(others, values).T
    return found


def compared(ones: dict[str, list], others: dict[str, list], percent: int,
             size: int = FINE_SKETCH) -> list[tuple[int, int, bool]]:
    """(place in ones, place in others, whether it is certain) of links between components.

    Both sides hold n, component and shingles (the ``size`` smallest) of their members. Where both
    sets are whole the link is certain, and one is given for a member and a component; else pairs
    are given whose similarity on the sketch of the union is at most five standard deviations
    below ``percent``.
    """
    similarity = percent / 100
    n, m = (np.array(side["n"])[:, None] for side in (ones, others))
    m = m.T
    x, y = ones["shingles"], others["shingles"]
    common = _common(x, y)
    last = np.iinfo(np.int64).max
    to_x, to_y = (np.array([last if len(s) == k else s[-1] for s, k in zip(side["shingles"],
                                                                           side["n"])])
                  for side in (ones, others))
    # each side's values up to the nearer of both reaches
    of_x = np.minimum(np.array([np.searchsorted(s, to_y, "right") for s in x]),
                      np.array([len(s) for s in x])[:, None])
    of_y = np.minimum(np.array([np.searchsorted(s, to_x, "right") for s in y]).T,
                      np.array([len(s) for s in y])[None])
    union = of_x + of_y - common
    whole = (to_x == last)[:, None] & (to_y == last)[None]
    slack = 5 * math.sqrt(similarity * (1 - similarity) / size)
    alike = np.where(whole, 100 * common >= percent * union, common >= (similarity - slack) * union)
    parts = {part: place for place, part in enumerate({*ones["component"], *others["component"]})}
    own, their = (np.array([parts[part] for part in side["component"]])
                  for side in (ones, others))
    alike &= (own[:, None] != their[None]) & (np.minimum(n, m) >= similarity * np.maximum(n, m))
    found, known = [], set()
    for i, j in np.argwhere(alike).tolist():
        if not whole[i, j]:
            found.append((i, j, False))
        elif (i, their[j]) not in known:
            known.add((i, their[j]))
            found.append((i, j, True))
    return found


def joining(found: list[tuple[int, int, bool]], own: list, their: list,
            ) -> list[tuple[int, int, bool]]:
    """Of the links of a cell, the certain ones that join components which those before leave apart,
    and the estimated ones between components that no certain ones join. ``own`` and ``their`` name
    the components of both sides."""
    above: dict = {}

    def top(part):
        while part in above:
            above[part] = above.get(above[part], above[part])
            part = above[part]
        return part

    kept = []
    for i, j, sure in sorted(found, key=lambda link: not link[2]):
        one, other = top(own[i]), top(their[j])
        if one != other:
            kept.append((i, j, sure))
            if sure:
                above[one] = other
    return kept


def _dealt(members: Column, minors: Column) -> Column:
    """Rows of a list that is dealt into cells."""
    return members * F.ceil(minors / CELL) + minors * F.ceil(members / CELL)


def _merged(lists: DataFrame) -> DataFrame:
    """Long lists (value, node, n, component, members, minors, minor), those of one family as one.

    The members of a large group share many lists. Lists with common members are a family; where
    it makes no more rows to compare the whole family once, it takes the place of its lists.
    """
    first = lists.groupBy("value").agg(F.min("node").alias("a"))
    links = lists.join(first, "value").select("a", F.col("node").alias("b")).filter("a != b")
    named = lists.join(components(links).withColumnRenamed("component", "family"),
                       "node").checkpoint()
    members = named.select("family", "node", "n", "component").distinct()
    parts = members.groupBy("family", "component").agg(F.count(F.lit(1)).alias("size"))
    whole = parts.groupBy("family").agg(
        F.sum("size").alias("members"), (F.sum("size") - F.max("size")).alias("minors"),
        F.max_by("component", F.struct("size", "component")).alias("major"))
    apart = named.groupBy("family", "value").agg(
        F.first(_dealt(F.col("members"), F.col("minors"))).alias("rows")).groupBy("family").agg(
        F.sum("rows").alias("rows"))
    once = whole.join(apart, "family").filter(
        _dealt(F.col("members"), F.col("minors")) <= F.col("rows")).drop("rows").checkpoint()
    columns = ["value", "node", "n", "component", "members", "minors", "minor"]
    families = members.join(once, "family").withColumns({
        "value": F.xxhash64("family"), "minor": F.col("component") != F.col("major")})
    rest = named.join(once.select("family"), "family", "left_anti")
    return families.select(columns).union(rest.select(columns))


def _cell_pairs(lists: DataFrame, docs: DataFrame, nodes: DataFrame, *, percent: int,
                shingle_words: int, id: str, text: str) -> DataFrame:
    """(a, b, certain) from long lists: members outside a list's largest component meet all others.

    Both sides are dealt into blocks of about ``CELL`` members by hash, and each pair of blocks is
    one small task of its own, which gives back links only.
    """
    fine = _sets(docs, lists.select("node").distinct().join(nodes.select("node", "_id"), "node"),
                 shingle_words, id, text, FINE_SKETCH).select("node", "shingles")
    hashed = F.xxhash64("node")
    wide = F.ceil(F.col("members") / CELL).cast("long")
    high = F.ceil(F.col("minors") / CELL).cast("long")
    row, column = F.pmod(hashed, high), F.pmod(hashed, wide)
    side = lists.select(
        "value", "node", "n", "component", F.explode(F.concat(
            F.when(F.col("minor"), F.transform(F.sequence(F.lit(0), wide - 1), lambda j: F.struct(
                row.alias("i"), j.alias("j"), F.lit(True).alias("one")))).otherwise(F.array()),
            F.transform(F.sequence(F.lit(0), high - 1), lambda i: F.struct(
                i.alias("i"), column.alias("j"), F.lit(False).alias("one"))))).alias("cell"))
    cells = side.select("value", "cell.*", "node", "n", "component").join(fine, "node")

    def links(table: pa.Table) -> pa.Table:
        held = [{name: part.column(name).to_pylist() for name in ("node", "n", "component")}
                | {"shingles": [s.values.to_numpy(zero_copy_only=False) for chunk in
                                part.column("shingles").chunks for s in chunk]}
                for part in (table.filter(table.column("one")),
                             table.filter(pc.invert(table.column("one"))))]
        ones, others = held
        found = compared(ones, others, percent) if ones["n"] and others["n"] else []
        found = joining(found, ones["component"], others["component"])
        ends = [sorted((ones["node"][i], others["node"][j])) for i, j, _ in found]
        return pa.table({"a": pa.array([a for a, _ in ends], pa.binary()),
                         "b": pa.array([b for _, b in ends], pa.binary()),
                         "certain": pa.array([sure for *_, sure in found], pa.bool_())})

    return cells.groupBy("value", "i", "j").applyInArrow(
        links, "a binary, b binary, certain boolean")


def similar_nodes(docs: DataFrame, nodes: DataFrame, *, percent: int, shingle_words: int, id: str,
                  text: str, size: int = SKETCH) -> DataFrame | None:
    """(node, component) of all nodes linked with another, or None if there are none.

    The members of a list are first compared with a few of them, which connects a large group of
    copies with a number of comparisons that grows with its members only. What then remains are
    pairs of one list in different components; all of these are compared, those of long lists in
    cells that give back links only, once for all lists of a large group.
    """
    given = dict(percent=percent, shingle_words=shingle_words, id=id, text=text, size=size)
    similarity = percent / 100
    postings = inverted_lists(nodes, similarity).checkpoint()
    links = _confirmed(docs, nodes, _star_pairs(postings, similarity), **given)
    alone = nodes.select("node", F.col("node").alias("component"))
    labels = alone if links is None else components(links)
    lists = _open_lists(postings, labels).checkpoint()
    crowded = lists.filter(F.col("members") > LONG_LIST)
    pairs = _open_pairs(lists.filter(F.col("members") <= LONG_LIST), similarity)
    found = [] if links is None else [links]
    if not crowded.isEmpty():
        cells = _cell_pairs(_merged(crowded).checkpoint(), docs, nodes, percent=percent, shingle_words=shingle_words,
                            id=id, text=text).distinct().checkpoint()
        found.append(cells.filter("certain").select("a", "b"))
        pairs = pairs.union(cells.filter("NOT certain").select("a", "b"))
    more = _confirmed(docs, nodes, pairs, **given)
    if more is not None:
        found.append(more)
    return components(reduce(DataFrame.union, found)) if found else None


def _labelled(docs: DataFrame, *, id: str, text: str, shingle_words: int,
              percent: int) -> DataFrame:
    """_id, KEY and n_shingles of each row; _first: the smallest id of its component, and _kept: no
    (whether the id is null), _id and _b of its first row. Both are null for texts without words."""
    rows = sketches(docs, shingle_words, id=id, text=text).checkpoint()
    nodes = rows.filter("n_shingles > 0").groupBy(F.col("signature").alias("node")).agg(
        F.min("_id").alias("_id"),
        F.min(F.struct(F.col("_id").isNull().alias("no"), "_id", "_b")).alias("_kept"),
        F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")).checkpoint()
    labels = similar_nodes(docs, nodes, percent=percent, shingle_words=shingle_words, id=id,
                           text=text)
    named = nodes.select("node", "_id", "_kept")
    if labels is not None:
        named = named.join(labels, "node", "left").withColumn(
            "component", F.coalesce("component", "node"))
        first = named.groupBy("component").agg(F.min("_id").alias("_id"),
                                               F.min("_kept").alias("_kept"))
        named = named.select("node", "component").join(first, "component").select(
            "node", "_id", "_kept")
    named = named.select(F.col("node").alias("signature"), F.col("_id").alias("_first"), "_kept")
    return rows.select("_id", *KEY, "n_shingles", "signature").join(named, "signature", "left")


def near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text",
                    shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents whose word shingle sets are similar, directly or through others.

    Words are runs of anything but ASCII white space, with A-Z as a-z; the set of a text with
    fewer words than a shingle is its whole sequence. Two documents are linked if
    100 * intersection >= ``percent`` * union. Documents with equal sets collapse before anything
    is compared; candidates come from shared values of bottom-k sketches of one hash function, are
    filtered by an estimate on the sketch of the union, and are confirmed on the full sets. A true
    pair is missed only if chance puts its sketches over four standard deviations below the mean,
    also where one set holds the other (at 80 percent, five for candidates and 4.8 for the estimate).

    Returns one row per input row: id, n_shingles, component_id (the smallest id reachable) and
    kept (id = component_id). Null texts and texts without words have no shingles, are linked with
    nothing and kept. Rows without an id count for similarity but never name a component that has
    an id; where no row of a component has one, component_id is null and all are kept. Rows that
    repeat an id are the same document. An empty table gives an empty result; other columns are
    ignored.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    found = _labelled(docs, id=id, text=text, shingle_words=shingle_words, percent=percent)
    component = F.when(F.col("n_shingles") == 0, F.col("_id")).otherwise(F.col("_first"))
    return found.select(F.col("_id").alias(id), "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("_id") == component, component.isNull()).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text",
                         shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates, with all columns: the one with the smallest id.

    Ids may be null (last) or repeated; texts tell their rows apart. Of rows equal in id and text
    any one stays. Null texts and texts without words are no duplicates of anything.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    found = _labelled(docs, id=id, text=text, shingle_words=shingle_words, percent=percent).filter(
        "n_shingles > 0").withColumn(
        "stays", F.struct(F.col("_id").isNull().alias("no"), "_id", "_b") == F.col("_kept"))
    fates = found.groupBy(*KEY).agg(F.first("stays").alias("stays"),
                                    F.count(F.lit(1)).alias("rows")).filter(
        "NOT stays OR rows > 1").select(*KEY, "stays").checkpoint()
    rows, repeated = packed(docs, id, text), fates.filter("stays")
    kept = rows.join(fates, KEY, "left_anti").select("_row.*")
    if repeated.isEmpty():
        return kept
    once = rows.join(repeated, KEY).dropDuplicates(KEY)
    return kept.unionByName(once.select("_row.*"))
