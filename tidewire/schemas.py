"""Payload schemas of the message streams. All fields are nullable."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


SOCIAL_MESSAGE = _struct(
    text=StringType(),
    source=StringType(),
    country=StringType(),
    timestamp=StringType(),
    manual_sentiment=StringType(),
)

SURVEY_MESSAGE = _struct(
    country=StringType(),
    year=IntegerType(),
    text=StringType(),
    age=IntegerType(),
    gender=StringType(),
)

EMPLOYMENT_INDICATOR = _struct(
    country=StringType(),
    year=IntegerType(),
    unemployment_rate=DoubleType(),
    youth_unemployment=DoubleType(),
    sector_employment=MapType(StringType(), DoubleType()),
)

SCORED_MESSAGE = _struct(
    text=StringType(),
    source=StringType(),
    country=StringType(),
    sentiment_label=StringType(),
    timestamp=StringType(),
    processed_at=TimestampType(),
)
