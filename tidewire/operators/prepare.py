"""Parsing, null handling, projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewire import fixed_values as fixed
from tidewire.functions import polarity, text as text_functions


def json_parse(df: DataFrame, schema: StructType, payload: str = "json", *,
               keep: Sequence[str] = (), rejects: str | None = None) -> DataFrame:
    """Parse a JSON string column by a fixed schema and flatten it to top-level columns.

    Bad payloads become rows of NULLs, one bad field nulls that field only. With ``rejects`` the
    payload that did not fit the schema is kept in a column of that name (NULL where it fitted),
    to be split off with ``accepted`` and ``rejected``. ``keep`` passes other columns through.
    """
    if rejects is None:
        return df.select(*keep, F.from_json(payload, schema).alias("_data")).select(
            *keep, "_data.*")
    marked = StructType([*schema.fields, StructField(rejects, StringType(), True)])
    options = {"columnNameOfCorruptRecord": rejects}
    parsed = df.select(*keep, F.col(payload).alias("_payload"),
                       F.from_json(payload, marked, options).alias("_data"))
    unread = F.when(F.col("_data").isNull(), F.coalesce("_payload", F.lit("")))
    return parsed.select(
        *keep,
        *[F.col(f"_data.{field.name}").alias(field.name) for field in schema.fields],
        F.coalesce(F.col(f"_data.{rejects}"), unread).alias(rejects),
    )


def accepted(parsed: DataFrame, rejects: str) -> DataFrame:
    return parsed.filter(F.col(rejects).isNull()).drop(rejects)


def rejected(parsed: DataFrame, rejects: str, keep: Sequence[str] = ()) -> DataFrame:
    """The payloads for the dead-letter table."""
    return parsed.filter(F.col(rejects).isNotNull()).select(*keep, rejects)


def null_fill(df: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Replace NULLs column by column."""
    if defaults is None:
        defaults = {"country": fixed.DEFAULT_COUNTRY, "text": ""}
    return df.na.fill(dict(defaults))


def ensure_columns(df: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Blank every NULL text, then add the columns that are missing with their default.

    A column that exists keeps '' for its NULLs; the default is for absent columns only.
    """
    if defaults is None:
        defaults = {"country": fixed.DEFAULT_COUNTRY}
    blanked = df.na.fill("")
    missing = {name: F.lit(value) for name, value in defaults.items() if name not in df.columns}
    return blanked.withColumns(missing) if missing else blanked


def first_label(column: str) -> Column:
    """First entry of an array, NULL where it is empty."""
    return F.get(column, F.lit(0))


def project_scored(df: DataFrame, labels: str = "class.result") -> DataFrame:
    """The stored form of a scored message."""
    return df.select("text", "source", "country", first_label(labels).alias("sentiment_label"),
                     "timestamp", F.current_timestamp().alias("processed_at"))


def stamp(df: DataFrame, column: str = "processed_time") -> DataFrame:
    """Add the processing time; one value per batch."""
    return df.withColumn(column, F.current_timestamp())


def parse_event_time(df: DataFrame, column: str = "timestamp", into: str = "event_ts",
                     pattern: str = fixed.TIMESTAMP_FORMAT) -> DataFrame:
    """Read the zoneless event time text; text that is no time gives NULL."""
    return df.withColumn(into, F.try_to_timestamp(F.col(column), F.lit(pattern)))


def filter_polarity(df: DataFrame, wanted: str = fixed.NEGATIVE,
                    column: str = "sentiment") -> DataFrame:
    return df.filter(F.col(column) == wanted)


@dataclass(frozen=True)
class MessageRules:
    """What the enriched message record is made with."""

    categories: tuple = polarity.CATEGORIES
    default_category: str = fixed.DEFAULT_CATEGORY
    stopwords: tuple = fixed.STOPWORDS
    keyword_limit: int = fixed.KEYWORDS_PER_MESSAGE
    unspecified: str = fixed.UNSPECIFIED
    default_age: int = fixed.DEFAULT_AGE
    engine: str = fixed.ENGINE_TAG


def enrich_message(df: DataFrame, rules: MessageRules = MessageRules(), *, id: str = "id",
                   confidence: str | None = None, timestamp: str | None = None) -> DataFrame:
    """The display record of a message, from whichever of its source fields are there.

    ``timestamp`` names the column with the time of arrival (the clock if not given) and
    ``confidence`` the model's probability (NULL if not given).
    """
    def field(name: str, default: object) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)

    body = F.coalesce(F.col("text"), F.lit(""))
    base = df.select(
        F.col(id).cast("string").alias("id"),
        body.alias("text"),
        field("sentiment", fixed.NEUTRAL).alias("sentiment"),
        polarity.message_category(body, rules.categories, rules.default_category)
        .alias("category"),
        (F.col(confidence) if confidence else F.lit(None)).cast("double").alias("confidence"),
        field("country", rules.unspecified).alias("city"),
        field("age", rules.default_age).cast("int").alias("age"),
        field("gender", rules.unspecified).alias("gender"),
        (F.col(timestamp) if timestamp else F.current_timestamp()).alias("timestamp"),
        text_functions.keywords(body, rules.stopwords, rules.keyword_limit).alias("keywords"),
    )
    found = F.size("keywords")

    def words_if(label: str) -> Column:
        return F.when(F.col("sentiment") == label, found).otherwise(0)

    return base.select(
        "id", "text", "sentiment", "category", "confidence", "city", "age", "gender", "timestamp",
        words_if(fixed.POSITIVE).alias("positive_words"),
        words_if(fixed.NEGATIVE).alias("negative_words"),
        "keywords",
        F.array("category").alias("auto_categories"),
        F.lit(rules.engine).alias("analysis_engine"),
    )
