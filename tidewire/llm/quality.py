"""Quality scores by regularised quadratic discriminant analysis over document statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.words import NOT_SPACE, VALUE_OF_LOWER, blocks, words_of
from tidewire.session import ensure_checkpoint_dir

#: Counts by which the shares of short texts are drawn towards none.
PRIOR = 10.0

_CODE = np.arange(256)
_LETTER = ((_CODE >= 65) & (_CODE <= 90)) | ((_CODE >= 97) & (_CODE <= 122)) | (_CODE >= 128)
_CLASSES = {
    "upper": (_CODE >= 65) & (_CODE <= 90),
    "letter": _LETTER,
    "digit": (_CODE >= 48) & (_CODE <= 57),
    "stop": np.isin(_CODE, [ord(c) for c in ".?;,"]),
    "symbol": ~(_LETTER | ((_CODE >= 48) & (_CODE <= 57)) | ~NOT_SPACE
                | np.isin(_CODE, [ord(c) for c in ".?;,'\"-:()"])),
    "shout": _CODE == ord("!"),
    "line": _CODE == 10,
}
STATISTICS = ("words", "word_length", "upper", "letter", "digit", "stop", "symbol", "shout",
              "line", "repeated_next", "repeated_pairs", "distinct", "short_words", "long_words",
              "bare_symbols", "commonest")


def _angle(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """A share on the scale on which its spread no longer depends on it, drawn towards none by
    :data:`PRIOR` counts so that a few words do not make an extreme."""
    return np.arcsin(np.sqrt(np.clip(count / (total + PRIOR), 0.0, 1.0)))


def _per_text(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
    return sums[first[1:]] - sums[first[:-1]]


def statistics(texts: list[bytes]) -> np.ndarray:
    """Transformed statistics of whole texts, a row each: logs of the length, shares of bytes, words
    and repeats as angles. Empty texts give the row of no counts, which is finite."""
    words = words_of(texts, NOT_SPACE, VALUE_OF_LOWER)
    n_bytes = np.diff(words.text_start).astype(np.float64) - 1
    n = np.diff(words.first).astype(np.float64)
    lengths = (words.end - words.start).astype(np.float64)
    data = words.data

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask[data], dtype=np.int64)))
        counts = sums[words.text_start[1:]] - sums[words.text_start[:-1]]
        return _angle(counts.astype(np.float64), n_bytes)

    text_of = np.repeat(np.arange(len(texts)), np.diff(words.first))
    hashes = words.hash
    same_text = text_of[1:] == text_of[:-1] if len(hashes) else np.zeros(0, bool)
    again = np.zeros(len(hashes))
    pairs = np.zeros(len(hashes), np.uint64)
    if len(hashes) > 1:
        again[1:] = same_text & (hashes[1:] == hashes[:-1])
        pairs[1:] = (hashes[1:] * np.uint64(3) + hashes[:-1]) * same_text

    def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys and the largest number of one key, per text."""
        order = np.lexsort((keys, text_of))
        new = np.ones(len(keys), bool)
        if len(keys) > 1:
            new[1:] = (keys[order][1:] != keys[order][:-1]) | ~same_text
        starts = np.flatnonzero(new)
        runs = np.diff(np.concatenate((starts, [len(keys)])))
        most = np.zeros(len(texts))
        np.maximum.at(most, text_of[starts], runs)
        return np.bincount(text_of[starts], minlength=len(texts)).astype(np.float64), most

    kinds, most = distinct(hashes)
    pair_kinds, _ = distinct(pairs)
    letters = np.concatenate(([0], np.cumsum(_CLASSES["letter"][data], dtype=np.int64)))
    bare = (letters[words.end] == letters[words.start]).astype(np.float64)
    return np.column_stack([
        np.log1p(n), np.log1p(n_bytes / np.maximum(n, 1)),
        *(share(_CLASSES[name]) for name in ("upper", "letter", "digit", "stop", "symbol", "shout",
                                             "line")),
        _angle(_per_text(words.first, again), n),
        _angle(np.maximum(n - pair_kinds, 0), n), _angle(kinds, n),
        _angle(_per_text(words.first, lengths <= 2), n),
        _angle(_per_text(words.first, lengths >= 12), n),
        _angle(_per_text(words.first, bare), n), _angle(most, n)])


class Model(NamedTuple):
    """Per class: log prior, mean, Cholesky factor of the shrunk covariance and its log
    determinant. Factors are computed once and kept."""

    log_prior: np.ndarray
    mean: np.ndarray
    factor: np.ndarray
    log_det: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1: logistic of the difference of the log densities, which are
        Mahalanobis distances by a triangular solve."""
        density = []
        for c in (0, 1):
            solved = np.linalg.solve(self.factor[c], (rows - self.mean[c]).T)
            density.append(self.log_prior[c] - 0.5 * (self.log_det[c] + (solved ** 2).sum(0)))
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def document_statistics(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id and statistics (array) of every whole text; null counts as empty, other columns are
    ignored. The only pass over the texts: fitting and scoring both start from these rows."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "_text"):
            values = statistics(texts)
            offsets = np.arange(0, values.size + 1, len(STATISTICS), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.ListArray.from_arrays(offsets, values.ravel())],
                ["_id", "statistics"])

    selected = docs.select(F.col(id).alias("_id"), F.col(text).cast("binary").alias("_text"))
    kind = dict(selected.dtypes)["_id"]
    return selected.mapInArrow(rows, f"_id {kind}, statistics array<double>").withColumnRenamed(
        "_id", id)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def gather(examples: DataFrame, label: str) -> dict[int, tuple]:
    """Number, sum and sum of products of the statistics of each class, over all rows.

    Sums are made in the tasks; a class sends one vector of fixed length from each to the next.
    """
    width = len(STATISTICS)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {c: np.zeros(1 + width + width * width) for c in (0, 1)}
        for batch in batches:
            rows = _matrix(batch.column("statistics"))
            labels = np.array(batch.column("_label").to_pylist())
            for c in (0, 1):
                own = rows[labels == c]
                sums[c] += np.concatenate(([len(own)], own.sum(0), (own.T @ own).ravel()))
        places = np.arange(1 + width + width * width)
        for c in (0, 1):
            if sums[c][0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(places), c), pa.int32()),
                     pa.array(places, pa.int32()), pa.array(sums[c])], ["c", "place", "value"])

    labelled = examples.select("statistics", F.col(label).cast("int").alias("_label")).filter(
        "_label IN (0, 1)")
    found = labelled.mapInArrow(partial, "c int, place int, value double").groupBy(
        "c", "place").agg(F.sum("value").alias("value")).collect()
    totals = {c: np.zeros(1 + width + width * width) for c in (0, 1)}
    for row in found:
        totals[row["c"]][row["place"]] = row["value"]
    return {c: (t[0], t[1:1 + width], t[1 + width:].reshape(width, width))
            for c, t in totals.items()}


def fit(examples: DataFrame, *, label: str = "quality", shrinkage: float = 0.1,
        ridge: float = 1e-2) -> Model:
    """Class means and covariances, each shrunk towards the pooled one and its diagonal.

    ``examples`` holds ``statistics`` and a label. Uses every labelled row; labels other than 0 and 1 are ignored. Without examples of a class
    the other's or the standard figures take its place, so the model stays defined.
    """
    totals = gather(examples, label)
    width = len(STATISTICS)
    n = {c: totals[c][0] for c in (0, 1)}
    everything = max(1.0, n[0] + n[1])
    overall = (totals[0][1] + totals[1][1]) / everything
    means = {c: totals[c][1] / n[c] if n[c] else overall for c in (0, 1)}
    scatter = {c: totals[c][2] - n[c] * np.outer(means[c], means[c]) if n[c]
               else np.zeros((width, width)) for c in (0, 1)}
    pooled = (scatter[0] + scatter[1]) / everything
    if n[0] + n[1] == 0:
        pooled = np.eye(width)
    factors, log_dets = [], []
    for c in (0, 1):
        own = scatter[c] / n[c] if n[c] else pooled
        weight = shrinkage + (1 - shrinkage) * width / (width + n[c])
        covariance = (1 - weight) * own + weight * pooled
        covariance = 0.95 * covariance + 0.05 * np.diag(np.diag(covariance)) + ridge * np.eye(width)
        factor = np.linalg.cholesky(covariance)
        factors.append(factor)
        log_dets.append(2 * np.log(np.diag(factor)).sum())
    priors = np.log([(n[0] + 1) / (everything + 2), (n[1] + 1) / (everything + 2)])
    return Model(priors, np.array([means[0], means[1]]), np.array(factors), np.array(log_dets))


def score(rows: DataFrame, model: Model, *, id: str = "doc_id") -> DataFrame:
    """id and score of every row of :func:`document_statistics`: the probability of class 1.

    Null and empty texts have the score of no words at all. Repeated rows are scored each; an
    empty table gives an empty result.
    """
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = model.scores(_matrix(batch.column("statistics")))
                yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(scores)],
                                                 ["_id", "score"])

    selected = rows.select(F.col(id).alias("_id"), "statistics")
    kind = dict(selected.dtypes)["_id"]
    return selected.mapInArrow(scored, f"_id {kind}, score double").withColumnRenamed("_id", id)


def classify(docs: DataFrame, labels: DataFrame, *, held_out: Callable[[Column], Column],
             threshold: float, id: str = "doc_id", text: str = "text",
             label: str = "quality") -> DataFrame:
    """Fits on the labelled documents that are not held out and scores all.

    Returns id, held_out, score and predicted (1 from ``threshold`` on). The statistics of a
    document are kept in a checkpoint, so texts are read once; only statistics are joined with
    labels. A document with several labels counts once for each.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = document_statistics(docs, id=id, text=text).checkpoint()
    known = labels.select(F.col(id).alias("_of"), F.col(label).alias("_given")).filter(
        ~held_out(F.col("_of")))
    model = fit(rows.join(known, F.col(id) == F.col("_of")), label="_given")
    return score(rows, model, id=id).select(
        id, held_out(F.col(id)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
