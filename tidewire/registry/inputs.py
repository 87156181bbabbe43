"""Tables, stand-in lexicons and the SQL pieces shared by the registered queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidewire.functions import text as text_functions
from tidewire.functions.lexicon import Lexicon

GLAD = ("there", "amient")
SAD = ("ount", "ung")
TOPICS = (
    Lexicon("Work", ("erin", "lich")),
    Lexicon("Worry", ("ción", "ouen")),
    Lexicon("Money", ("eaux", "able")),
)
WORD_TOPICS = (
    Lexicon("Work", ("the", "der")),
    Lexicon("Worry", ("que", "los")),
    Lexicon("Money", ("la", "un")),
)
CATEGORIES = (
    Lexicon("capital", ("Thth", "Eaux", "Ción")),
    Lexicon("small", ("whthe", "ouer", "ber")),
)
STOPWORDS = ("the", "that", "que", "der", "les", "los")
EVENT_TOPICS = (
    Lexicon("Unemployment", ("err",)),
    Lexicon("Anxiety", ("click", "view")),
    Lexicon("Economy", ("PURCH",)),
)
# some 5,000 keywords of two syllables and a consonant by a rule, dealt over the three topics
_CONSONANTS, _VOWELS = "bcdfghjklmnpqrstvwxz", "aeiou"
_SYLLABLES = [consonant + vowel for consonant in _CONSONANTS for vowel in _VOWELS]
_RULED = [(a, b, c) for a in range(100) for b in range(100) for c in range(20)
          if (7 * a + 13 * b + 31 * c) % 40 == 7]
LONG_TOPICS = tuple(
    Lexicon(topic.label, [_SYLLABLES[a] + _SYLLABLES[b] + _CONSONANTS[c] for a, b, c in _RULED
                          if (a + b + c) % 3 == place])
    for place, topic in enumerate(TOPICS))
LONG_TOPICS_SQL = f"""
    WITH consonants AS (
        SELECT a, substr('{_CONSONANTS}', a + 1, 1) AS s FROM range(20) AS r(a)),
    syllables AS (
        SELECT a, substr('{_CONSONANTS}', a // 5 + 1, 1) || substr('{_VOWELS}', a % 5 + 1, 1) AS s
        FROM range(100) AS r(a))
    SELECT x.s || y.s || z.s AS word, (x.a + y.a + z.a) % 3 AS place
    FROM syllables AS x, syllables AS y, consonants AS z
    WHERE (7 * x.a + 13 * y.a + 31 * z.a) % 40 = 7
"""
POINTS = (("en", 51.5, -0.25), ("de", 52.52, 13.4), ("es", 40.42, -3.7))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_path(folder: str, name: str) -> str:
    """A pattern, since a file stream takes a folder or a pattern but not a file."""
    return f"{folder}/{name}.parque[t]"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def any_of(column: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {quoted(word)})" for word in words) + ")"


def first_of(column: str, lexicons: Sequence[Lexicon], default: str) -> str:
    """CASE over lexicons; keywords lowered where the column is."""
    lowered = column.startswith("lower(")
    whens = " ".join(
        f"WHEN {any_of(column, [w.lower() if lowered else w for w in lexicon.keywords])} "
        f"THEN {quoted(lexicon.label)}" for lexicon in lexicons)
    return f"CASE {whens} ELSE {quoted(default)} END"


SENTIMENT_SQL = (
    f"CASE WHEN {any_of('lower(text)', GLAD)} AND NOT {any_of('lower(text)', SAD)} "
    f"THEN 'positive' WHEN {any_of('lower(text)', SAD)} AND NOT {any_of('lower(text)', GLAD)} "
    f"THEN 'negative' ELSE 'neutral' END"
)
TOPIC_SQL = first_of("lower(text)", TOPICS, "General")
CATEGORY_SQL = first_of("text", CATEGORIES, "other")
EVENT_TOPIC_SQL = first_of("lower(event_type)", EVENT_TOPICS, "General")

# RE2 has no class for all white space
_SPACE_CLASS = (r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
                r"\x{202f}\x{205f}\x{3000}")
SYMBOLS_RE2 = rf"[^\p{{L}}\p{{N}}_{_SPACE_CLASS}]"
NON_SPACE_RE2 = f"[^{_SPACE_CLASS}]+"
_SPACES = " || ".join(f"chr({ord(c)})" for c in text_functions.WHITESPACE_CHARACTERS)
NORMALIZED_SQL = (
    f"trim(regexp_replace(regexp_replace(text, '{SYMBOLS_RE2}', ' ', 'g'), "
    f"'{text_functions.DIGIT_RUNS}', '', 'g'), {_SPACES})"
)
_STOP = ", ".join(quoted(word) for word in STOPWORDS)
# every kept word of a document with the place of its first occurrence
WORDS_SQL = f"""
    SELECT doc_id, word, min(place) AS place FROM (
        SELECT doc_id, unnest(parts) AS word, generate_subscripts(parts, 1) AS place FROM (
            SELECT doc_id, string_split_regex({NORMALIZED_SQL}, '[{_SPACE_CLASS}]+')
                AS parts
            FROM documents))
    WHERE length(word) > 2 AND word NOT IN ({_STOP})
    GROUP BY doc_id, word
"""
