"""Long keyword lists: looked up by the grams of a text instead of tested one by one.

Each keyword is filed under one of its grams, the one that fewest keywords hold, in the bucket of
that gram's hash. Only keywords filed under a gram that a text holds are tested against it. The index is one literal and the lookup one expression: texts
are not shuffled, streams can use it, and the plan is as large as for a single keyword.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAM = 4
BUCKETS_PER_KEYWORD = 4
_INDEX = "array<array<struct<gram:string,wanted:string,rank:int>>>"


def _grams(word: str) -> set[str]:
    size = min(GRAM, len(word))
    return {word[at:at + size] for at in range(len(word) - size + 1)}


def _filed(keywords: Sequence[tuple[str, int]], match: str) -> list[list[dict]]:
    """Buckets of keywords with their ranks; the number of buckets grows with the keywords."""
    held = Counter(gram for word, _ in keywords for gram in _grams(word))
    buckets: list[list[dict]] = [[] for _ in range(BUCKETS_PER_KEYWORD * len(keywords))]
    for word, rank in keywords:
        gram = min(_grams(word), key=lambda one: (held[one], one))
        wanted = re.escape(word) if match == "word" else word
        buckets[zlib.crc32(gram.encode()) % len(buckets)].append(
            {"gram": gram, "wanted": wanted, "rank": rank})
    return buckets


def ranks_in(body: Column, keywords: Sequence[tuple[str, int]], match: str = "substring",
             word_characters: str = "") -> Column:
    """Ranks of the keywords that a text holds, in no order and possibly repeated; NULL for NULL.

    ``keywords`` are (word, rank) without empty words. ``body`` is used several times, so it
    should be a column or a lambda's variable. A text's grams are held as one array while it is
    looked at, some tens of bytes for each of its characters.
    """
    buckets = _filed(keywords, match)
    index = F.from_json(F.lit(json.dumps(buckets)), _INDEX)
    # a look-ahead finds a gram at every character
    found = [F.regexp_extract_all(body, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))
             for size in sorted({min(GRAM, len(word)) for word, _ in keywords})]
    grams = found[0] if len(found) == 1 else F.concat(*found)

    def filed_under(gram: Column) -> Column:
        bucket = (F.crc32(gram.cast("binary")) % F.lit(len(buckets))).cast("int")
        return F.filter(F.get(index, bucket), lambda entry: entry["gram"] == gram)

    near = F.flatten(F.transform(F.array_distinct(grams), filed_under))

    def holds(entry: Column) -> Column:
        if match == "substring":
            return F.contains(body, entry["wanted"])
        return F.regexp_like(body, F.concat(
            F.lit(f"(?<![{word_characters}])"), entry["wanted"],
            F.lit(f"(?![{word_characters}])")))

    return F.transform(F.filter(near, holds), lambda entry: entry["rank"])
