"""Keys that tell rows apart whether or not their ids do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["_a", "_b"]


def keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """_id, the key (_a, _b) and _text, null as empty.

    The key is never null and differs for rows that differ in id or text, so plain equality joins
    work on it. Rows equal in both share it.
    """
    kind = dict(docs.dtypes)[id]
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(id).alias("_id"), F.coalesce(F.col(id), F.lit(0).cast(kind)).alias("_a"),
        F.xxhash64(F.col(id), body).alias("_b"), body.alias("_text"))


def packed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Whole rows as ``_row`` beside their key (_a, _b), whatever the names of their columns."""
    kind = dict(docs.dtypes)[id]
    return docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row"),
        F.coalesce(F.col(id), F.lit(0).cast(kind)).alias("_a"),
        F.xxhash64(F.col(id), F.coalesce(F.col(text), F.lit(""))).alias("_b"))
