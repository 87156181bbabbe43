"""The similarity join, the collocations and the spelling variants against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tidewire.llm import collocations, jaccard_join, queries, spelling, toxicity

SCHEMA = ("doc_id long, text string, lang string, n long, word string, tiles int, node string, "
          "phrase string, _id int, `a.b` int")
LONG = " ".join(f"word{n % 997}x{n % 13}" for n in range(30_000))


def row(id, text, lang="en"):
    return (id, text, lang, 1, "w", 2, "n", "p", 3, 4)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns with clashing names."""
    return spark.createDataFrame([
        row(1, "a b c d e f g"), row(1, "a b c d e f g"), row(2, "A B C  D e f\tg"), row(3, None),
        row(4, ""), row(5, " \n"), row(None, "a b c d e f g"), row(None, "other words"),
        row(6, LONG), row(7, LONG + " end", None), row(8, "one"), row(9, "one two", None)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def brute_links(texts, size, percent):
    sets = {id: shingle_set(text, size) for id, text in texts.items()}
    holders = defaultdict(list)
    for id, own in sets.items():
        for shingle in own:
            holders[shingle].append(id)
    common = Counter((a, b) for ids in holders.values() for a in ids for b in ids if a < b)
    links = [(a, b) for (a, b), n in common.items()
             if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    return sets, links


def brute_components(texts, size, percent):
    sets, links = brute_links(texts, size, percent)
    label = {id: id for id in texts}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    return {id: (len(sets[id]), label[id]) for id in texts}


def copies(seed, groups=30, most=12):
    """Groups of texts of all sizes, with copies from equal to quite different."""
    rng, texts = random.Random(seed), {}
    vocabulary = [f"w{n}" for n in range(3000)]
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 9, 12, 20, 40, 90, 300, 900]))
        for _ in range(rng.randint(1, most)):
            copy = list(base)
            for _ in range(int(len(copy) * rng.choice([0, 0, 0.01, 0.02, 0.03, 0.04, 0.1]) + 0.5)):
                at, what = rng.randrange(len(copy) + 1), rng.choice(vocabulary)
                copy[at:at + rng.choice([0, 1])] = rng.choice([[], [what]]) or [what]
            texts[len(texts)] = " ".join(copy[:len(copy) - rng.choice([0, 0, 0, len(copy) // 20])])
    return texts


@pytest.mark.parametrize("seed, percent, size", [(1, 90, 3), (3, 80, 2)])
def test_jaccard_components_equal_brute_force(spark, seed, percent, size):
    texts = copies(seed)
    docs = spark.createDataFrame([row(id, text) for id, text in texts.items()], SCHEMA)
    found = jaccard_join.jaccard_components(docs, shingle_words=size, percent=percent).collect()
    assert len(found) == len(texts)
    assert {r[0]: (r[1], r[2]) for r in found} == brute_components(texts, size, percent)


def test_a_large_group_of_near_copies_is_dealt_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", 16)
    monkeypatch.setattr(jaccard_join._dealt, "__defaults__", (16,))
    texts = copies(4, groups=3, most=150)
    docs = spark.createDataFrame([row(id, text) for id, text in texts.items()], SCHEMA)
    found = jaccard_join.jaccard_components(docs).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == brute_components(texts, 3, 90)


@pytest.mark.parametrize("percent", [70, 80, 90, 97])
def test_linked_sets_share_a_tile(percent):
    rng = np.random.default_rng(percent)
    bands = jaccard_join.Bands(percent, 3000)
    for n in [*range(1, 60), 100, 333, 1000, 2500] * 3:
        one = np.unique(rng.integers(0, 1 << 62, n))
        differ = int(bands.differ[bands.of(len(one))])
        gone = rng.integers(0, differ + 1)
        other = np.union1d(one[rng.permutation(len(one))[min(gone, len(one) - 1):]],
                           rng.integers(0, 1 << 62, rng.integers(0, differ - gone + 1)))
        common = len(np.intersect1d(one, other))
        if 100 * common < percent * (len(one) + len(other) - common):
            continue
        if len(one) == len(other) == common:
            continue
        keys = [set(jaccard_join.tile_keys(s, bands).tolist()) for s in (one, other)]
        assert keys[0] & keys[1]
        bits = [int(bands.bits[bands.of(len(s))]) for s in (one, other)]
        maps = jaccard_join._folded([jaccard_join.bitmap(s, b) for s, b in zip((one, other), bits)])
        sizes = np.array([len(one), len(other)])
        assert jaccard_join.may_link(sizes, maps, 0, np.array([1]), percent).all()


def test_overlaps_of_sorted_arrays():
    rng = np.random.default_rng(0)
    one = np.unique(rng.integers(0, 500, 200))
    others = [np.unique(rng.integers(0, 700, n)) for n in (1, 5, 100, 400)]
    offsets = np.concatenate(([0], np.cumsum([len(o) for o in others])))
    found = jaccard_join.overlaps(one, np.concatenate(others), offsets)
    assert found.tolist() == [len(np.intersect1d(one, o)) for o in others]


def test_jaccard_edges(odd, empty):
    found = jaccard_join.jaccard_components(odd)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    rows = sorted(map(tuple, found.collect()), key=str)
    assert len(rows) == odd.count()
    by = defaultdict(set)
    for id, n, component in rows:
        by[id].add((n, component))
    assert by[1] == by[2] == {(5, 1)} and by[3] == {(0, 3)} and by[4] == {(0, 4)}
    assert by[5] == {(0, 5)} and by[None] == {(5, 1), (1, None)} and by[8] == {(1, 8)}
    assert {c for _, c in by[6] | by[7]} == {6}
    assert jaccard_join.jaccard_components(empty).count() == 0


def brute_collocations(rows, least, top, most=4, percent=80):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[i:i + size])] += 1
    out = set()
    for lang, f in counts.items():
        candidates = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and
                   any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in candidates.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                 for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return out


def prose(seed, texts=60):
    rng = random.Random(seed)
    words = [f"w{n}" for n in range(40)] + ["é", "Über", "x\x00y"]
    phrases = [" ".join(rng.choices(words, k=rng.choice([2, 3, 4, 5, 7]))) for _ in range(12)]
    def text():
        parts = [rng.choice(phrases) if rng.random() < 0.5 else rng.choice(words)
                 for _ in range(rng.randrange(60))]
        return "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "; "])
                       for p in parts)
    return [(text(), rng.choice(["en", "en", "de", None])) for _ in range(texts)]


def test_rows_are_added_up_without_a_second_copy_kept():
    parts = [pa.record_batch({"key": [2, 1, 2], "lang": ["a", "b", "a"], "n": [1, 2, 3]}),
             pa.record_batch({"key": [1], "lang": ["b"], "n": [5]})]
    held = list(parts)
    assert collocations._summed(held).to_pydict() == {
        "key": [1, 2], "lang": ["b", "a"], "n": [7, 4]}
    assert held == []
    many = [pa.record_batch({"key": np.arange(at, at + 50_000), "n": np.ones(50_000, np.int64)})
            for at in range(0, 400_000, 40_000)]
    out = list(collocations._combined(iter(many)))
    assert max(part.num_rows for part in out) <= 2 * collocations.HELD <= 1 << 19
    assert sum(pc.sum(part.column("n")).as_py() for part in out) == 500_000


@pytest.mark.parametrize("seed, budget, top", [(1, 400_000, 2000), (3, 8, 10)])
def test_collocations_equal_brute_force(spark, seed, budget, top):
    rows = prose(seed)
    docs = spark.createDataFrame([row(n, text, lang) for n, (text, lang) in enumerate(rows)], SCHEMA)
    found = collocations.collocations(docs, least=8, top=top, budget=budget).collect()
    assert {tuple(r) for r in found} == brute_collocations(rows, 8, top)
    assert len(found) == len({(r["lang"], r["rank"]) for r in found}) > 10


def test_a_full_filter_lets_all_pass():
    held = np.full(8, 255, np.uint8)
    assert collocations._within(held, np.arange(1000, dtype=np.uint64)).all()


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000 // 2
    counts = spark.createDataFrame([("en", "x", 1, big + 7), ("en", "y", 1, big - 1),
                                    ("en", "x y", 2, big - 3)],
                                   "lang string, phrase string, words int, n long")
    found = collocations.scored(counts).collect()
    assert [r["score"] for r in found] == [2_000_000 * (big - 3) // (2 * big + 6)]


def test_subtree_counts_are_sums_of_leaves():
    table = pa.table({"lang": ["en"] * 4, "phrase": ["a b c", "a b", "a d", "a"],
                      "n": pa.array([3, 4, 5, 6], pa.int64()),
                      "depth": pa.array([1, 1, 1, 1], pa.int32())})
    nodes = collocations.subtree(table, 1, 4).to_pylist()
    assert {(r["phrase"], r["n"]) for r in nodes} == {("a b c", 3), ("a b", 7), ("a d", 5), ("a", 18)}


def test_collocation_edges(spark, odd, empty):
    found = collocations.collocations(odd, least=4)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [(r["text"], r["lang"]) for r in odd.select("text", "lang").collect()]
    assert {tuple(r) for r in found.collect()} == brute_collocations(rows, 4, 2000)
    assert collocations.collocations(empty).count() == 0


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts, length, least):
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= least}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(((-words[v], v) for v in near[w]), default=None)
        form[w] = best[1] if best and -best[0] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def vocabulary(seed, n=400):
    """Words of few letters, so that many are near each other, some with much in common."""
    rng, counts = random.Random(seed), {}
    for _ in range(n):
        word = "".join(rng.choices("abé", k=rng.choice([4, 5, 5, 6, 7, 9])))
        if rng.random() < 0.3:
            word = rng.choice(["prefix", ""]) + word + rng.choice(["ending", "", "s" * 30])
        counts[word] = rng.choice([1, 2, 3, 4, 8, 16, 33, 70])
    return counts


@pytest.mark.parametrize("seed, pairs", [(1, 512), (3, 4)])
def test_variants_equal_brute_force(spark, seed, pairs):
    counts = vocabulary(seed)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = spelling.variants(words, pairs=pairs).collect()
    assert {tuple(r) for r in found} == brute_variants(counts, 5, 3)
    assert len(found) == len({r["word"] for r in found})


def test_words_are_counted_as_they_are_changed(spark):
    docs = spark.createDataFrame([row(n, t) for n, t in enumerate(
        ["Éclair ÉCLAIR éclair × straße ABCdef", "abcdef-ABCDEF9x", None, ""] * 40)], SCHEMA)
    found = {r["word"]: r["n"] for r in
             spelling.word_counts(docs, change=queries._misspelt).collect()}
    import zlib
    want = Counter()
    for id, text in docs.select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] += 1
    assert found == dict(want)
    assert any(len(w) == 5 for w in want)  # some words were changed


def test_spelling_edges(spark, odd, empty):
    found = spelling.spelling_variants(odd)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {r["word"] for r in found.collect()} == {"other", "words"} & set()
    assert spelling.spelling_variants(empty).count() == 0
    chain = spark.createDataFrame([("aaaaa", 64), ("aaaab", 32), ("aaabb", 16), ("aabbb", 8),
                                   ("abbbb", 4), ("x" * 5000, 3), ("x" * 5001, 6), (None, 9)],
                                  "word string, n long")
    by = {r["word"]: r for r in spelling.variants(chain).collect()}
    assert by["abbbb"]["root"] == "aaaaa" and by["abbbb"]["form"] == "aabbb"
    assert by["x" * 5000]["form"] == "x" * 5001 and len(by) == 7
    ties = spark.createDataFrame([("words", 3), ("wordz", 6), ("worda", 6)], "word string, n long")
    assert {r["word"]: r["form"] for r in spelling.variants(ties).collect()} == {
        "words": "worda", "wordz": None, "worda": None}


def test_no_pair_of_a_common_chunk_is_written_out(spark):
    """A thousand words with one half in common: the chunk is lengthened, not multiplied out."""
    rng = random.Random(0)
    words = {"common" + "".join(rng.choices("abcdefghij", k=6)) for _ in range(1000)}
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    found = {(r["a"], r["b"]) for r in spelling.near_words(frame, 16).select("a", "b").collect()}
    assert found == {(a, b) if len(a) < len(b) or a < b else (b, a)
                     for a in words for b in words if a < b and one_edit(a, b)}


def test_op_queries_return_their_contract(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = queries.ENTRIES["op11_jaccard_join"].query(spark, folder)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == brute_components(texts, 3, 90)
    assert found.select(F.max("n_shingles")).dtypes[0][1] == "bigint"


def test_drop_toxic_keeps_all_else(spark):
    docs = spark.createDataFrame([(1, "foul foul", 5), (1, "fine words", 5), (None, "foul foul", 5),
                                  (None, None, 5), (2, "", 5), (2, "", 5), (3, "fine foul", 5)],
                                 "doc_id long, text string, _a int").withColumns(
        {"_b": F.lit(1), "score": F.lit(2), "row": F.lit(3), "x.y": F.lit(4)})
    labels = [(100 + n, "foul words here" if n % 2 else "fine words here", n % 2) for n in range(80)]
    given = spark.createDataFrame(labels, "doc_id long, text string, toxic int")
    model = toxicity.fit(given.drop("toxic"), given.drop("text"))
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r["text"]) for r in kept.collect()) == ["", "", "None", "fine words"]
    assert toxicity.drop_toxic(docs.limit(0), model).count() == 0
