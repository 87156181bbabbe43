"""Keyword lexicons as native expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.keyword_index import ranks_in

# Beyond this many keywords the chain of tests gets long; an index of them is asked instead.
OR_CHAIN_LIMIT = 100

WORD_CHARACTERS = r"\p{L}\p{N}_"


@dataclass(frozen=True)
class Lexicon:
    """One label and the keywords that select it."""

    label: str
    keywords: tuple[str, ...]

    def __init__(self, label: str, keywords: Iterable[str]):
        words = tuple(keywords)
        if any(not isinstance(word, str) or word == "" for word in words):
            # an empty keyword is contained in every text
            raise ValueError(f"lexicon {label!r} holds an empty or non-text keyword")
        object.__setattr__(self, "label", label)
        object.__setattr__(self, "keywords", words)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _once(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` a value that is computed once however often it is used: a filter or a merged
    projection would repeat a plain expression for each use."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _holds_any(body: Column, keywords: Sequence[str], match: str) -> Column:
    """One test per keyword, joined; NULL for NULL."""
    if match == "word":
        choices = "|".join(re.escape(word) for word in keywords)
        return body.rlike(f"(?<![{WORD_CHARACTERS}])(?:{choices})(?![{WORD_CHARACTERS}])")
    return reduce(lambda a, b: a | b, (F.contains(body, F.lit(word)) for word in keywords))


def _labels(text: Column | str, lists: Sequence[Sequence[str]], case_sensitive: bool, match: str,
            of: Callable[[Sequence[Column]], Column]) -> Column:
    """``of`` the answers whether the text holds a keyword of each list; NULL text gives false.

    Few keywords are tested one by one, many are looked up in an index.
    """
    if match not in ("substring", "word"):
        raise ValueError(f"unknown match {match!r}")
    cased = [list(dict.fromkeys(words if case_sensitive else [word.lower() for word in words]))
             for words in lists]
    if not any(cased):
        return of([F.lit(False) for _ in cased])

    def tested(body: Column) -> Column:
        return of([F.coalesce(_holds_any(body, words, match), F.lit(False)) if words
                   else F.lit(False) for words in cased])

    def looked_up(body: Column) -> Column:
        ranked = [(word, rank) for rank, words in enumerate(cased) for word in words]
        ranks = F.array_distinct(F.coalesce(
            ranks_in(body, ranked, match, WORD_CHARACTERS), F.array().cast("array<int>")))
        return _once(ranks, lambda found: of(
            [F.array_contains(found, rank) for rank in range(len(cased))]))

    text = _column(text)
    body = text if case_sensitive else F.lower(text)
    if sum(map(len, cased)) > OR_CHAIN_LIMIT:
        return _once(body, looked_up)
    return tested(body) if case_sensitive else _once(body, tested)


def contains_any(text: Column | str, keywords: Sequence[str], *, case_sensitive: bool = False,
                 match: str = "substring") -> Column:
    """True where the text holds at least one keyword; NULL text gives false.

    ``match="substring"`` looks inside words too; ``match="word"`` wants whole words. A letter
    beyond U+FFFF before a keyword counts as a word's end, since Java looks back by one unit.
    """
    return _labels(text, [keywords], case_sensitive, match, lambda found: found[0])


def contains_of_each(text: Column | str, lists: Sequence[Sequence[str]],
                     of: Callable[[Sequence[Column]], Column], *, case_sensitive: bool = False,
                     match: str = "substring") -> Column:
    """``of`` the columns that ``contains_any`` gives for each list, with one look at the text."""
    return _labels(text, lists, case_sensitive, match, of)


def first_label(text: Column | str, lexicons: Sequence[Lexicon], default: str, *,
                case_sensitive: bool = False, match: str = "substring") -> Column:
    """The label of the first lexicon with a match, in the order given, else the default."""
    if not lexicons:
        return F.lit(default)

    def first(found: Sequence[Column]) -> Column:
        answer = F
        for lexicon, holds in zip(lexicons, found):
            answer = answer.when(holds, lexicon.label)
        return answer.otherwise(default)

    return _labels(text, [lexicon.keywords for lexicon in lexicons], case_sensitive, match, first)
