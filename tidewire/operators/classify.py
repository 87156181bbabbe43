"""Pluggable text classification."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import WORDS

Scorer = Callable[[Iterator[pd.Series]], Iterator[pd.DataFrame]]


def train_classifier(examples: DataFrame, text: str = "text", target: str = "target", *,
                     features: int = 1 << 16, iterations: int = 20,
                     regularization: float = 0.01) -> PipelineModel:
    """Fit the default model on (text, integer target) rows.

    Tokens are hashed to a vector of fixed width, so the model's size does not grow with the data
    and only gradient sums travel to the driver. Frequent classes are weighted down by the inverse
    of their share.
    """
    known = examples.filter(F.col(target).isNotNull()).select(text, target)
    sizes = known.groupBy(target).agg(F.count(F.lit(1)).alias("_size"))
    classes, total = sizes.agg(F.count(F.lit(1)), F.sum("_size")).first()
    # one row a class, as the model has: a shuffle by class would give each class to one task
    weighted = known.join(F.broadcast(sizes), target).withColumn(
        "_weight", F.lit(total) / (F.col("_size") * F.lit(classes))).drop("_size")
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=WORDS, gaps=False,
                       toLowercase=True),
        HashingTF(inputCol="_tokens", outputCol="_features", numFeatures=features),
        LogisticRegression(featuresCol="_features", labelCol=target, weightCol="_weight",
                           predictionCol="_prediction", probabilityCol="_probability",
                           rawPredictionCol="_raw", maxIter=iterations, regParam=regularization),
    ]
    return Pipeline(stages=stages).fit(weighted)


def classify_text(df: DataFrame, model: PipelineModel, labels: Sequence[str], *,
                  label: str = "sentiment_label", confidence: str = "confidence") -> DataFrame:
    """Add the model's label and its probability, on a table or a stream.

    The model was fitted on a static frame; ``labels[k]`` names its class k. A model with more
    classes than ``labels`` raises a ValueError.
    """
    classes = max((getattr(stage, "numClasses", 0) for stage in model.stages), default=0)
    if classes > len(labels):
        raise ValueError(f"the model has {classes} classes, of which {len(labels)} have labels")
    scored = model.transform(df)
    names = F.array(*[F.lit(name) for name in labels])
    return scored.select(
        *df.columns,
        F.get(names, F.col("_prediction").cast("int")).alias(label),
        F.array_max(vector_to_array("_probability")).alias(confidence),
    )


def classify_with(df: DataFrame, scorer: Scorer, text: str = "text", *,
                  label: str = "sentiment_label", confidence: str = "confidence") -> DataFrame:
    """Add label and probability from a Python model, in Arrow batches.

    ``scorer`` takes an iterator of text Series and yields frames with the columns ``label`` and
    ``confidence``. It loads its weights once before the loop, so once per task.
    """
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from scorer(texts)

    scores = F.pandas_udf(score, "label string, confidence double")
    scored = df.withColumn("_score", scores(F.col(text)))
    return scored.select(*df.columns, F.col("_score.label").alias(label),
                         F.col("_score.confidence").alias(confidence))
