"""Sentiment and topic labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire import fixed_values as fixed
from tidewire.functions.lexicon import Lexicon, _column, contains_of_each, first_label

TOPICS = (
    Lexicon(fixed.UNEMPLOYMENT, fixed.UNEMPLOYMENT_WORDS),
    Lexicon(fixed.ANXIETY, fixed.ANXIETY_WORDS),
    Lexicon(fixed.ECONOMY, fixed.ECONOMY_WORDS),
)
CATEGORIES = tuple(Lexicon(label, words) for label, words in fixed.CATEGORY_WORDS)


def lexicon_sentiment(text: Column | str, positive: Sequence[str] = fixed.POSITIVE_WORDS,
                      negative: Sequence[str] = fixed.NEGATIVE_WORDS, *,
                      match: str = "substring") -> Column:
    """Positive or negative where only that side is found; both, neither or NULL is neutral."""
    def side(found: Sequence[Column]) -> Column:
        glad, sad = found
        return (
            F.when(glad & ~sad, fixed.POSITIVE).when(sad & ~glad, fixed.NEGATIVE)
            .otherwise(fixed.NEUTRAL)
        )

    return contains_of_each(text, [positive, negative], side, match=match)


def rating_polarity(label: Column | str) -> Column:
    """A star label to polarity: 4 or 5 first, then 1 or 2, else neutral."""
    label = _column(label)
    high = F.contains(label, F.lit("5")) | F.contains(label, F.lit("4"))
    low = F.contains(label, F.lit("1")) | F.contains(label, F.lit("2"))
    return F.when(high, fixed.POSITIVE).when(low, fixed.NEGATIVE).otherwise(fixed.NEUTRAL)


def topic_priority(text: Column | str, topics: Sequence[Lexicon] = TOPICS,
                   default: str = fixed.DEFAULT_TOPIC, *, match: str = "substring") -> Column:
    """First matching topic, ignoring case."""
    return first_label(text, topics, default, match=match)


def message_category(text: Column | str, categories: Sequence[Lexicon] = CATEGORIES,
                     default: str = fixed.DEFAULT_CATEGORY) -> Column:
    """First matching category, case-sensitive."""
    return first_label(text, categories, default, case_sensitive=True)
