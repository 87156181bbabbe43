"""The operators against brute force on small tables, and the edge cases that they define."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.llm import (
    chat,
    decontaminate,
    fingerprints,
    fixity,
    graph,
    licenses,
    mixing,
    near_dedup,
    passages,
    quality,
    toxicity,
)
from tidewire.llm.keys import keyed

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _a int"
LONG = " ".join(f"word{n % 997}x{n % 13}" for n in range(30_000))
PASSAGE = " ".join(f"p{n}q" for n in range(70))


def row(id, text, source="s"):
    return (id, text, "en", source, len(text or ""), 0.5, 7)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns with clashing names."""
    return spark.createDataFrame([
        row(1, "a b c d e f g"), row(1, "a b c d e f g"), row(2, "A B C  D e f\tg"), row(3, None),
        row(4, ""), row(5, " \n"), row(None, "a b c d e f g"), row(None, "other words"),
        row(6, LONG), row(7, LONG + " end"), row(8, "one"), row(9, "mit license", None),
        row(10, PASSAGE + " own"), row(11, "start " + PASSAGE)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def test_mixing_takes_near_the_targets_and_never_more_than_twice(spark):
    rows = [row(n, " ".join(["w"] * (1 + n % 7)), f"s{n % 5}" if n % 3 else "s0")
            for n in range(600)]
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA).drop("score")).collect()
    again = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(found) == sorted(again)
    sizes, by = {r[0]: r[3] for r in rows}, {}
    for r in found:
        assert r["size"] == 1 + r["doc_id"] % 7 and r["taken"] in (0, r["size"], 2 * r["size"])
        by.setdefault(sizes[r["doc_id"]], []).append(r)
    weights = dict(zip(sorted(by), (3, 1, 2, 3, 1)))
    for source, own in by.items():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 7
        assert own[0]["target"] <= 2 * own[0]["source_size"]
    open_ = [s for s in by if by[s][0]["target"] < 2 * by[s][0]["source_size"] - 1e-6]
    levels = {round(by[s][0]["target"] / weights[s], 6) for s in open_}
    assert len(levels) == 1
    total = sum(own[0]["source_size"] for own in by.values())
    assert sum(own[0]["target"] for own in by.values()) == pytest.approx(1.5 * total)


def test_mixing_edges(odd, empty):
    found = mixing.mix(odd).collect()
    assert len(found) == odd.count()
    assert {r["size"] for r in found if r["doc_id"] in (3, 4, 5)} == {0}
    assert mixing.mix(empty).count() == 0


def brute_components(texts, size, percent):
    sets = {}
    for id, text in texts.items():
        w = words(text)
        sets[id] = {tuple(w[n:n + size]) for n in range(len(w) - size + 1)} or (
            {tuple(w)} if w else set())
    parent = {id: id for id in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {id: (len(sets[id]), find(id)) for id in sets}


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = {}
    for n in range(150):
        if n % 3 and n > 3:
            w = words(texts[int(rng.integers(n))])
            for _ in range(int(rng.integers(0, 6))):
                if w:
                    w[int(rng.integers(len(w)))] = f"new{rng.integers(9)}"
            texts[n] = " ".join(w)
        else:
            texts[n] = " ".join(f"v{v}" for v in rng.integers(0, 60, int(rng.integers(0, 90))))
    docs = spark.createDataFrame([row(n, t) for n, t in texts.items()], SCHEMA)
    for size in (2, 5):
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"])
                 for r in near_dedup.near_duplicates(docs, shingle_words=size).collect()}
        assert found == brute_components(texts, size, 80)


def test_needed_overlap_has_room_where_one_set_holds_the_other():
    for similarity in (0.5, 0.8, 0.9):
        least = similarity - 5 * (similarity * (1 - similarity) / near_dedup.SKETCH) ** 0.5
        assert 0 < near_dedup._share_needed(similarity) <= max(least, 1 / near_dedup.SKETCH) + 1e-9
    assert near_dedup.SKETCH * near_dedup._share_needed(0.8) < 25


def test_long_lists_in_cells_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LONG_LIST", 3)
    monkeypatch.setattr(near_dedup, "CELL", 5)
    rng = np.random.default_rng(5)
    base, texts = [f"b{n}" for n in range(80)], {}
    for n in range(60):
        w = list(base)
        for _ in range(int(rng.integers(0, 13))):
            w[int(rng.integers(80))] = f"e{rng.integers(999)}"
        texts[n] = " ".join(w)
    docs = spark.createDataFrame([row(n, t) for n, t in texts.items()], SCHEMA)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"])
             for r in near_dedup.near_duplicates(docs, shingle_words=2).collect()}
    assert found == brute_components(texts, 2, 80)
    assert 1 < len({component for _, component in found.values()}) < 60


def test_cells_give_certain_links_once_and_estimated_pairs_all():
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 1 << 62, 400))
    near, far = np.sort(base[rng.permutation(400)[:350]]), np.sort(base[rng.permutation(400)[:200]])

    def side(sets, parts, size):
        return {"n": [len(s) for s in sets], "component": parts, "shingles": [s[:size] for s in sets]}

    ones, others = [base], [near, far, near]
    assert near_dedup.compared(side(ones, [b"a"], 500), side(others, [b"b"] * 3, 500), 80,
                               500) == [(0, 0, True)]
    assert near_dedup.compared(side(ones, [b"a"], 100), side(others, [b"b", b"b", b"a"], 100), 80,
                               100) == [(0, 0, False)]
    two = near_dedup.compared(side(ones, [b"a"], 100), side([near, near], [b"b", b"b"], 100), 80, 100)
    assert two == [(0, 0, False), (0, 1, False)]


def test_a_cell_gives_back_no_more_certain_links_than_join_its_components():
    every = [(i, j, True) for i in range(20) for j in range(20)]
    found = near_dedup.joining([(0, 0, False), (0, 20, False), *every], [f"a{i}" for i in range(20)],
                               [f"b{j}" for j in range(21)])
    assert sum(sure for *_, sure in found) == 39
    assert [link for link in found if not link[2]] == [(0, 20, False)]


def test_lists_of_one_group_are_compared_once(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CELL", 5)
    group = [(v, bytes([n]), 9, bytes([min(n, 20)]), 40, 20, n < 20)
             for v in range(30) for n in range(40)]
    other = [(99, bytes([100 + n]), 9, bytes([100 + n]), 8, 7, n < 7) for n in range(8)]
    lists = spark.createDataFrame(group + other, "value long, node binary, n long, component binary, "
                                                 "members long, minors long, minor boolean")
    found = near_dedup._merged(lists).collect()
    assert len(found) == 48 and len({r["value"] for r in found}) == 2
    assert sorted({(r["members"], r["minors"]) for r in found}) == [(8, 7), (40, 20)]
    assert sum(r["minor"] for r in found) == 27


def test_near_duplicates_edges(odd, empty):
    found = near_dedup.near_duplicates(odd, shingle_words=2).collect()
    assert len(found) == odd.count()
    by = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert (by[2]["component_id"], by[2]["kept"]) == (1, False)
    assert all(by[n]["n_shingles"] == 0 and by[n]["kept"] for n in (3, 4, 5))
    assert by[7]["component_id"] == 6 and by[8]["n_shingles"] == 1
    assert {r["component_id"] for r in found if r["doc_id"] is None} == {1, None}
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_dedup_stage_keeps_one_row_of_each_group_whatever_the_ids(spark, odd, empty):
    import corpus_pipeline

    def text(k, more=""):
        return " ".join(f"t{k}_{n}" for n in range(60)) + more

    rows = [row(1, text(1)), row(None, text(1, " x")), row(None, text(2)), row(None, text(3)),
            row(None, text(3, " y")), row(5, text(1, " z")), row(5, text(4)), row(6, text(5)),
            row(6, text(5), "other"), row(None, text(6)), row(None, text(6)), row(None, None),
            row(None, ""), row(8, text(7)), row(7, text(7, " w")), row(None, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    left = corpus_pipeline.near_dedup_stage(spark, docs, "")
    assert left.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in left.collect()]
    third = [t for id, t in kept if (t or "").startswith("t3_")]
    assert len(third) == 1 and third[0] in (text(3), text(3, " y"))
    assert sorted(map(str, kept)) == sorted(map(str, [
        (1, text(1)), (None, text(2)), (None, third[0]), (5, text(4)), (6, text(5)),
        (None, text(6)), (None, None), (None, ""), (None, ""), (7, text(7, " w"))]))
    assert (None, "other words") in {(r["doc_id"], r["text"]) for r in
                                     corpus_pipeline.near_dedup_stage(spark, odd, "").collect()}
    assert corpus_pipeline.near_dedup_stage(spark, empty, "").count() == 0


def test_components_follow_long_chains(spark):
    links = spark.createDataFrame([(n, n + 1) for n in range(60)] + [(100, 101)], "a int, b int")
    found = {r["node"]: r["component"] for r in graph.components(links).collect()}
    assert found == {**{n: 0 for n in range(61)}, 100: 100, 101: 100}


def test_fingerprints_of_edits(odd, empty):
    found = fingerprints.edited_and_next(odd).collect()
    assert len(found) == odd.count()
    prints = {}
    for r in found:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert prints[1] == prints[2] and len(prints[1]) == 1 and prints[3] == prints[4] == {""}
    last = [r for r in found if r["doc_id"] == 10][0]
    text, other = PASSAGE + " own", "start " + PASSAGE
    half = len(text) // 2
    edited = text[:len(text) - half] + other[:half]
    assert last["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert fingerprints.edited_and_next(empty).count() == 0


def test_fingerprints_estimate_similarity(spark):
    base = [f"w{n}" for n in range(2000)]
    rows = [row(n, " ".join(base[:2000 - 400 * n] + [f"x{n}{k}" for k in range(400 * n)]))
            for n in range(4)]
    found = {r["doc_id"]: r for r in fingerprints.edited_and_next(
        spark.createDataFrame(rows, SCHEMA)).collect()}
    for n in range(3):
        a, b = ({tuple(w[i:i + 5]) for i in range(1996)} for w in (
            rows[n][1].split(), rows[n + 1][1].split()))
        assert found[n]["near_next"] == pytest.approx(len(a & b) / len(a | b), abs=0.15)


def test_passages_equal_brute_force_on_exact_repeats(spark):
    rng = np.random.default_rng(5)
    shared = [" ".join(f"s{k}_{n}" for n in range(60 + 20 * k)) for k in range(4)]
    texts = []
    for n in range(40):
        own = [f"o{n}_{v}" for v in rng.integers(0, 10_000, 80)]
        at = int(rng.integers(0, 80))
        middle = [shared[n % 5]] if n % 5 < 4 else []
        texts.append(" ".join(own[:at] + middle + own[at:]))
    found = passages.repeated_passages(spark.createDataFrame(
        [row(n, t) for n, t in enumerate(texts)], SCHEMA)).collect()
    assert {r["doc_id"] for r in found} == {n for n in range(5, 40) if n % 5 < 4}
    for r in found:
        here = words(texts[r["doc_id"]])[r["start_word"]:r["end_word"]]
        assert " ".join(here) == shared[r["doc_id"] % 5] and r["source_id"] == r["doc_id"] % 5


def test_passages_of_one_pair_are_found_at_any_gap(spark):
    texts, wanted = {}, {}
    for k, (size, gap) in enumerate((size, gap) for size in (60, 120) for gap in (
            0, 1, 5, 10, 20, 30, 50, 100, 150, 250, 400)):
        own, other = ([f"{side}{k}_{n}" for n in range(gap + 40)] for side in "xy")
        one, two = ([f"{side}{k}_{n}" for n in range(size)] for side in "pq")
        texts[k] = own[:20] + one + own[20:20 + gap] + two + own[20 + gap:]
        texts[100 + k] = other[:20] + one + other[20:20 + gap] + two + other[20 + gap:]
        ends = (20, 20 + size), (20 + size + gap, 20 + 2 * size + gap)
        wanted[100 + k] = [(20, 20 + 2 * size + gap)] if gap <= 5 else list(ends)
    found = {}
    for r in passages.repeated_passages(spark.createDataFrame(
            [row(n, " ".join(t)) for n, t in texts.items()], SCHEMA)).collect():
        assert r["source_id"] == r["doc_id"] - 100
        found.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"]))
    assert {id: sorted(spans) for id, spans in found.items()} == wanted


def test_passages_whose_parts_stand_in_other_documents_are_found(spark, monkeypatch):
    texts, first = {}, {}
    for k in range(12):
        p = [f"p{k}_{n}" for n in range(60)]
        cuts = {0: (0, 30, 60), 1: (0, 20, 40, 60), 2: (0, 37, 60)}[k % 3]
        for part, (begin, end) in enumerate(zip(cuts, cuts[1:])):
            texts[10 * k + part] = [f"a{k}{part}_{n}" for n in range(30)] + p[begin:end] + [
                f"b{k}{part}_{n}" for n in range(30)]
        for more in (5, 6, 7):
            texts[10 * k + more] = [f"c{k}{more}_{n}" for n in range(11 * more)] + p + [
                f"d{k}{more}_{n}" for n in range(30)]
        first[10 * k + 6] = first[10 * k + 7] = 10 * k + 5
    docs = spark.createDataFrame([row(n, " ".join(t)) for n, t in texts.items()], SCHEMA)
    for most in (passages.MAX_WINDOWS, 0):
        monkeypatch.setattr(passages, "MAX_WINDOWS", most)
        found = passages.repeated_passages(docs).collect()
        assert {r["doc_id"]: r["source_id"] for r in found} == first and len(found) == len(first)
        for r in found:
            begin = 11 * (r["doc_id"] % 10)
            assert (r["start_word"], r["end_word"]) == (begin, begin + 60)


def test_only_seeds_that_occur_again_are_kept_with_their_places(spark):
    rng = random.Random(8)
    alone = [" ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(400)) for _ in range(30)]
    both = " ".join(f"v{k}" for k in range(60))
    docs = spark.createDataFrame([*enumerate(alone), (100, f"{alone[3]} {both}"), (101, both)],
                                 "doc_id long, text string")
    rows = keyed(docs, "doc_id", "text")
    every = passages.seeds(rows, 50).collect()
    kept = passages.seeds(rows, 50, passages._repeated_seeds(rows, 50)).collect()
    often = {seed for seed, n in Counter(r["seed"] for r in every).items() if n > 1}
    assert often and {r["seed"] for r in kept} >= often and set(kept) <= set(every)
    assert len(kept) < len(every) / 3


def test_windows_of_a_block_are_those_of_its_texts(spark):
    texts = [None, "", "a b c d", "b c d e f a b c", "x", "c d e"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = keyed(docs.coalesce(1), "doc_id", "text")
    found = {(r["_a"], r["at"]): r["seed"] for r in passages._windows(rows, 3).collect()}
    runs = {(id, at): tuple((text or "").split()[at:at + 3]) for id, text in enumerate(texts)
            for at in range(len((text or "").split()) - 2)}
    assert found.keys() == runs.keys()
    assert all((found[x] == found[y]) == (runs[x] == runs[y]) for x in runs for y in runs)
    held = np.zeros(8192, np.uint8)
    place = found[2, 1] % 65536
    held[place >> 3] = 1 << (place & 7)
    some = passages._windows(rows, 3, spark.sparkContext.broadcast(held)).collect()
    assert {(r["_a"], r["at"]) for r in some} >= {(2, 1), (3, 0)} and len(some) < len(runs)


def test_open_windows_are_all_that_seeds_allow():
    rng = np.random.default_rng(4)
    for _ in range(30):
        hashes = rng.integers(0, 1 << 62, 300).astype(np.uint64)
        places = passages.seed_places(hashes)[0]
        held = places[rng.random(len(places)) < 0.8]
        begin = int(rng.integers(0, 200))
        spans = [(begin, begin + 70)]
        wanted = [s for s in range(251)
                  if set(places[(places >= s) & (places <= s + 42)]) <= set(held)
                  and not (begin <= s and s + 50 <= begin + 70)]
        assert set(wanted) <= set(passages.open_windows(held, spans, 50).tolist())


def test_stretches_keep_what_only_a_whole_chain_makes_long_enough():
    parts = list(range(30)), list(range(100, 130))
    x, y = (parts[0] + [own + n for n in range(10)] + parts[1] for own in (1000, 2000))
    chain = [(n, n) for n in (0, 10, 20, 42, 52, 60)]
    assert passages.stretches(x, y, chain) == [(0, 70, 0, 70, 60)]
    assert passages.stretches(x, y, chain, least_similarity=0.9) == []
    x, y = (list(range(60)) + [own + n for n in range(90)] + parts[1] for own in (1000, 2000))
    chain = [(n, n) for n in (5, 30, 50, 152)]
    assert passages.stretches(x, y, chain) == [(0, 60, 0, 60, 60)]


def test_passages_edges_and_cut(odd, empty):
    found = {(r["doc_id"], r["source_id"]) for r in passages.repeated_passages(odd).collect()}
    assert found == {(7, 6), (11, 10)}
    kept = passages.drop_repeated(odd)
    assert kept.columns == odd.columns
    texts = {}
    for r in kept.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert texts[11] == ["start"] and texts[7] == ["end"] and texts[10] == [PASSAGE + " own"]
    assert texts[3] == [None] and len(texts[None]) == 2 and len(texts[1]) == 2
    assert passages.repeated_passages(empty).count() == 0
    assert passages.drop_repeated(empty).count() == 0


def test_chain_is_the_best_by_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(50):
        matches = [tuple(map(int, m)) for m in rng.integers(0, 60, (9, 2))]
        best = 0.0
        for mask in range(1, 1 << len(matches)):
            chosen = sorted(matches[n] for n in range(len(matches)) if mask >> n & 1)
            if all(a[0] < b[0] and a[1] < b[1] for a, b in zip(chosen, chosen[1:])):
                gaps = sum(b[0] - a[0] + b[1] - a[1] for a, b in zip(chosen, chosen[1:]))
                best = max(best, 8 * len(chosen) - 0.1 * gaps)
        first = passages.chains(matches)[0]
        gaps = sum(b[0] - a[0] + b[1] - a[1] for a, b in zip(first, first[1:]))
        assert 8 * len(first) - 0.1 * gaps == pytest.approx(best)


ITEM = ("A farmer named Maria sold 48 apples to her friends in spring and then she sold half as "
        "many pears to Maria in summer. How many fruits did Maria sell altogether?")


def test_decontamination_finds_items_with_other_values(spark, odd, empty):
    changed = ITEM.replace("Maria", "Peter").replace("48", "1,250")
    torn = ITEM.replace("Maria", "Peter", 1).replace("48", "7")
    docs = spark.createDataFrame([
        row(1, "intro text. " + ITEM + " more text"), row(2, "Some words before.\n" + changed),
        row(3, "the farmer sold apples and pears in summer"), row(4, None),
        row(5, torn.replace("to Maria", "to Zed"))], SCHEMA)
    items = spark.createDataFrame([(7, ITEM), (8, None), (9, "too short")],
                                  "item_id int, text string")
    found = {r["doc_id"]: r["kind"] for r in decontaminate.contaminated(docs, items).collect()}
    assert found == {1: "verbatim", 2: "changed"}
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5]
    assert decontaminate.contaminated(odd, items).count() == 0
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == 5


def test_decontamination_finds_dense_and_short_items(spark, monkeypatch):
    dense = "What is 12 km plus 7 km minus 3 km"
    docs = spark.createDataFrame([
        row(1, f"Some intro. {dense} and more."),
        row(2, "Intro. " + dense.replace("12", "40").replace("7", "9")),
        row(3, "What is 12 km plus all the others"), row(4, "add 3 to 5 now please"),
        row(5, "add 4 to 6 now please")], SCHEMA)
    items = spark.createDataFrame([(1, dense), (2, "add 3 to 5"), (3, "now please")],
                                  "item_id int, text string")
    for most in (decontaminate.MAX_BROADCAST_WINDOWS, 0):
        monkeypatch.setattr(decontaminate, "MAX_BROADCAST_WINDOWS", most)
        found = {(r["doc_id"], r["item_id"], r["kind"])
                 for r in decontaminate.contaminated(docs, items).collect()}
        assert found == {(1, 1, "verbatim"), (2, 1, "changed"), (4, 2, "verbatim")}


def test_licenses_equal_brute_force(odd, empty, spark):
    rows = [row(1, "Released under the MIT License. transmit license"), row(2, "mit-license mit"),
            row(3, "the General Public License and general public  license; Apache LICENSE"),
            row(4, "Licensed under CC BY-NC 4.0."), row(5, "commit license")]
    found = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (found[1]["n_base"], found[1]["first_word"], found[1]["base_labels"]) == (1, 3, "mit")
    assert (found[2]["n_base"], found[2]["n_words"], found[2]["last_word"]) == (1, 3, 0)
    assert (found[3]["n_base"], found[3]["first_word"], found[3]["last_word"]) == (3, 1, 8)
    assert found[3]["base_labels"] == "apache,gpl"
    assert (found[4]["base_labels"], found[4]["labels"]) == ("", "cc-by-nc")
    assert (found[5]["n_base"], found[5]["base_labels"]) == (0, "")
    edges = licenses.scan(odd).collect()
    assert len(edges) == odd.count()
    assert {r["n_words"] for r in edges if r["doc_id"] in (3, 4, 5)} == {0}
    assert licenses.scan(empty).count() == 0


def test_chat_reads_back_what_was_said(spark):
    said = ["<|im_end|><|im_start|>assistant ok", "<", "|x", "<\\|a<\\\\|", "", None, "ends <"]
    rows = [(1, n, "assistant" if n % 2 else "user", t) for n, t in enumerate(said)]
    rows += [(None, 1, "odd\nrole\\n", "hello"), (2, None, None, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(turns)
    for r in formatted.collect():
        role, text = chat.parse_turn(r["formatted"])
        assert (role or None, text) in {(x[2], x[3] or "") for x in rows}
    found = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    all_turns = "".join(f"{r[2]}\n{r[3] or ''}\n" for r in rows[:7])
    learned = "".join(r[3] or "" for r in rows[:7] if r[2] == "assistant")
    assert found[1]["turns_sha256"] == hashlib.sha256(all_turns.encode()).hexdigest()
    assert found[1]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    assert found[1]["loss_chars"] == len(learned) and set(found) == {1, 2, None}
    assert chat.read_back(chat.format_turns(turns.limit(0))).count() == 0


def test_chat_flattens_parts_in_order(spark):
    parts = F.array(
        chat.text_part(F.lit("see <|image_1|>")),
        F.from_json(F.lit('{"kind":"image","ref":"a.png","width":900,"height":448}'),
                    chat.PART.replace("struct<", "").rstrip(">").replace(":", " ")),
        F.from_json(F.lit('{"kind":"audio","ref":"b.wav","seconds":2.5}'),
                    chat.PART.replace("struct<", "").rstrip(">").replace(":", " ")))
    turns = spark.range(1).select(F.lit(1).alias("conv_id"), F.lit(1).alias("turn"),
                                  F.lit("assistant").alias("role"), parts.alias("parts"))
    r = chat.format_turns(turns, parts="parts").first()
    assert "<\\|image_1|><|image_1|><|audio_2|>" in r["formatted"]
    assert [(a["ref"], a["tokens"]) for a in r["attachments"]] == [("a.png", 768), ("b.wav", 63)]
    for a in r["attachments"]:
        assert r["formatted"][a["at"]:].startswith(f"<|{a['kind']}_{a['number']}|>")


def test_fixity_finds_exactly_the_damaged_records(spark):
    rows = [(n if n % 50 else None, f"http://h{n % 3}/", "x" * (n % 40)) for n in range(1500)]
    pages = spark.createDataFrame(rows + rows[:2], "page_id long, url string, html string")
    hurt = F.when(F.col("page_id") == 77, F.lit(None)).when(
        F.col("page_id").isin(3, 999), F.lit("other")).otherwise(F.col("html"))
    records = fixity.manifest(pages, replica=hurt, file_bytes=20_000)
    found = {(r["page_id"], r["status"]) for r in fixity.audit(
        records, range_bytes=1000, fanout=4).collect()}
    assert found == {(77, "missing"), (3, "changed"), (999, "changed")}
    assert records.agg(F.sum("copies")).first()[0] == 1502
    assert fixity.audit(fixity.manifest(pages, replica=F.col("html"))).count() == 0
    assert fixity.audit(fixity.manifest(pages.limit(0), replica=F.col("html"))).count() == 0


def test_quality_and_toxicity_of_held_out_rows(spark):
    rng = np.random.default_rng(1)
    docs, labels = [], []
    for n in range(600):
        w = [f"w{v}" for v in rng.integers(0, 300, 60)]
        good, bad = n % 4 != 0, n % 6 == 0
        if not good:
            w = [f"{x}###" for x in w]
        if bad:
            w[int(rng.integers(60))] = "scoundrel"
        docs.append(row(n, " ".join(w[:30]) + ". " + " ".join(w[30:])))
        labels.append((n, int(good), int(bad)))
    docs = spark.createDataFrame(docs, SCHEMA)
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = quality.classify(docs, labels, held_out=lambda id: id % 5 == 0, threshold=0.3)
    right = scored.join(labels, "doc_id").filter("held_out AND predicted = quality").count()
    assert right == 120
    model = toxicity.fit(docs, labels.filter("doc_id % 5 != 0"))
    found = toxicity.score(docs, model).join(labels, "doc_id").filter("doc_id % 5 = 0").collect()
    assert all((r["score"] >= 0.7) == (r["toxic"] == 1) for r in found)
    for r in found:
        assert all("scoundrel" in s["sentence"] for s in r["offending"])
        assert len(r["offending"]) == r["toxic"]


def test_classifier_edges(odd, empty, spark):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 1), (8, None, None)],
                                   "doc_id long, quality int, toxic int")
    for frame, given in ((odd, labels), (odd, labels.limit(0)), (empty, labels)):
        scored = quality.classify(frame, given, held_out=lambda id: id % 5 == 0, threshold=0.3)
        rows = scored.collect() + toxicity.score(frame, toxicity.fit(frame, given)).collect()
        assert len(rows) == 2 * frame.count()
        assert all(0 <= r["score"] <= 1 for r in rows)


def test_pipeline_stages_keep_columns_and_clean_documents(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(9)
    rows = []
    for n in range(120):
        text = " ".join(f"c{v}" for v in rng.integers(0, 5000, 80))
        if n % 10 == 1:
            text += " scoundrel. " + "thing"
        rows.append(row(n, text)[:5])
    rows += [row(200, rows[5][1] + " tail")[:5], row(201, ITEM + " " + rows[0][1][:30])[:5]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(n, 1, int(n % 10 == 1)) for n in range(120)],
                          "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    left = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert left == {n for n in range(120) if n % 10 != 1}
    assert [re.sub(r"\W", "", name) for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_dedup", "passages", "decontamination", "mixing"]


def test_decontamination_finds_an_item_beside_a_torn_copy_of_it(spark):
    """The torn copy covers as much of the item as the whole one; order must not matter."""
    changed = ITEM.replace("Maria", "Peter").replace("48", "1,250")
    torn = ITEM.replace("Maria", "Peter", 1).replace("48", "7")
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    filler = " some other words of no matter at all between the two "
    docs = spark.createDataFrame([
        row(1, torn + filler + ITEM), row(2, ITEM + filler + torn), row(3, torn),
        row(4, torn + filler + changed), row(5, changed + filler + ITEM),
        row(6, torn + filler + torn)], SCHEMA)
    found = {r.doc_id: r.kind for r in decontaminate.contaminated(docs, benchmark).collect()}
    alone = {r.doc_id for r in decontaminate.contaminated(
        docs.filter("doc_id = 3"), benchmark).collect()}
    assert {n: found.get(n) for n in (1, 2, 5)} == dict.fromkeys((1, 2, 5), "verbatim")
    assert found[4] == "changed"
    assert {3, 6} & found.keys() == ({3, 6} if alone else set())


def test_rows_go_whatever_their_other_columns_are_called(spark):
    """Helper names of the operators, also in other case, as columns of the documents."""
    names = ("_a _b _id _text _row _ROWS _sa _sb _la _lb _spans _first _kept stays w item matches "
             "size no component").split()
    docs = spark.createDataFrame([
        row(1, PASSAGE + " own words"), row(2, f"begin {PASSAGE} " + " ".join(
            f"tail{n}" for n in range(40))),
        row(3, "nothing of note"), row(4, "nothing of note"), row(None, None), row(5, ITEM)],
        SCHEMA).withColumns({name: F.lit(at) for at, name in enumerate(names)})
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")

    def ids(df):
        assert df.columns == docs.columns and df.dtypes == docs.dtypes
        rows = df.collect()
        assert all(r[name] == at for r in rows for at, name in enumerate(names))
        return sorted((r.doc_id or 0) for r in rows), {r.doc_id: r.text for r in rows}

    assert ids(decontaminate.drop_contaminated(docs, benchmark))[0] == [0, 1, 2, 3, 4]
    assert ids(near_dedup.drop_near_duplicates(docs))[0] == [0, 1, 2, 3, 5]
    kept, texts = ids(passages.drop_repeated(docs))
    assert kept == [0, 1, 2, 3, 4, 5] and texts[1] == PASSAGE + " own words"
    assert texts[2].split()[0] == "begin" and PASSAGE not in texts[2]
