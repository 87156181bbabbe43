"""Fitted models kept under a name made from their data and settings."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators.classify import train_classifier
from tidewire.session import folder_exists, publish_folder


def fingerprint(examples: DataFrame, settings: dict) -> str:
    """A name for a fit: the same for the same rows in any order, columns, settings and Spark.

    Rows are hashed where they lie; three numbers come to the driver. Sums keep what a repeated
    row adds, which an exclusive or would cancel out.
    """
    hashes = [F.xxhash64(*examples.columns, F.lit(salt)) for salt in (0, 1)]
    rows, *sums = examples.agg(F.count(F.lit(1)), *[
        F.sum(one.cast("decimal(38,0)")) for one in hashes]).first()
    parts = [rows, *map(str, sums), examples.dtypes, sorted(settings.items()),
             examples.sparkSession.version]
    return hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()


def stored_model(spark: SparkSession, folder: str, examples: DataFrame, settings: dict,
                 fit: Callable[..., PipelineModel]) -> PipelineModel:
    """``fit(examples, **settings)``, or the model that an earlier call stored for the same.

    A model is written beside its place and then renamed, so a run that is stopped leaves no half
    of one; of two runs that fit at once the first one's model stays and both return it. Examples
    or settings that change give another name. ``fit`` goes by its own name in the hash.
    """
    named = {"_fit": f"{fit.__module__}.{fit.__qualname__}", **settings}
    path = f"{folder}/{fingerprint(examples, named)}"
    if not folder_exists(spark, path):
        draft = f"{folder}/_draft-{uuid.uuid4().hex}"
        fit(examples, **settings).write().save(draft)
        publish_folder(spark, draft, path)
    return PipelineModel.load(path)


def stored_classifier(spark: SparkSession, folder: str, examples: DataFrame,
                      **settings) -> PipelineModel:
    """The default classifier on (text, target) rows, fitted once for the same rows and settings."""
    return stored_model(spark, folder, examples, settings, train_classifier)
