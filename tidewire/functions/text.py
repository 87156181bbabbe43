"""Text normalisation, tokens and keywords.

Classes are spelled out by Unicode category: Java's short classes are ASCII-only and would delete
Arabic letters. White space is listed in full for the same reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire import fixed_values as fixed
from tidewire.functions.lexicon import WORD_CHARACTERS, _column

# Few members: a class is tested one by one for every character.
WHITESPACE = r"\p{IsWhite_Space}\x{1c}-\x{1f}"
WHITESPACE_CHARACTERS = "".join(
    chr(code)
    for first, last in ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
                        (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
                        (0x3000, 0x3000))
    for code in range(first, last + 1)
)

SYMBOLS = f"[^{WORD_CHARACTERS}{WHITESPACE}]"
DIGIT_RUNS = r"\p{Nd}+"
WORDS = f"[{WORD_CHARACTERS}]+"


def normalize_text(text: Column | str) -> Column:
    """Symbols to blanks, digit runs deleted, ends trimmed; NULL gives ''."""
    blanked = F.regexp_replace(_column(text), SYMBOLS, " ")
    undigited = F.regexp_replace(blanked, DIGIT_RUNS, "")
    return F.coalesce(F.btrim(undigited, F.lit(WHITESPACE_CHARACTERS)), F.lit(""))


def _no_words() -> Column:
    return F.array().cast("array<string>")


def keywords(text: Column | str, stopwords: Sequence[str] = fixed.STOPWORDS,
             limit: int | None = fixed.KEYWORDS_PER_MESSAGE,
             longest_dropped: int = fixed.LONGEST_DROPPED_WORD) -> Column:
    """Distinct meaningful words in order of first occurrence, at most ``limit`` of them.

    ``limit=None`` returns them all. The words are those of the normalised text: with the digits
    gone, they are the runs between symbols and blanks, so one pass finds the long ones.
    """
    undigited = F.regexp_replace(_column(text), DIGIT_RUNS, "")
    longer = f"[{WORD_CHARACTERS}]{{{longest_dropped + 1},}}"
    words = F.regexp_extract_all(undigited, F.lit(longer), F.lit(0))
    if stopwords:
        distinct = F.array_except(words, F.array(*[F.lit(word) for word in stopwords]))
    else:
        distinct = F.array_distinct(words)
    distinct = F.coalesce(distinct, _no_words())
    return distinct if limit is None else F.slice(distinct, 1, limit)


def tokens(text: Column | str) -> Column:
    """Runs of letters, numbers and underscores; NULL gives an empty array."""
    return F.coalesce(F.regexp_extract_all(_column(text), F.lit(WORDS), F.lit(0)), _no_words())


def clean_tokens(text: Column | str) -> Column:
    """Space-separated tokens with symbols removed, case kept; tokens left empty are dropped."""
    return tokens(F.regexp_replace(_column(text), f"{SYMBOLS}+", ""))
