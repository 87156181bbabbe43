"""Toxicity by multiple-instance learning: documents are bags of sentences."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.keys import KEY, keyed
from tidewire.llm.words import VALUE_OF_LOWER, blocks, mix, prefix_hashes, run_hashes
from tidewire.session import ensure_checkpoint_dir

BUCKET_BITS = 18
GRAM_BYTES = (4, 6)
PREFIX_BYTES = (3, 4, 5, 6, 7, 8)
#: Bounds of the fit: labelled rows from which features are chosen and weights are learned,
#: features kept, and the evidence (log-likelihood ratio) that a feature needs.
MAX_EXAMPLES = 200_000
MAX_BAGS = 12_000
MAX_FEATURES = 1_000
LEAST_EVIDENCE = 20.0
#: Keys of toxic rows that are sent to all tasks; more are joined by a shuffle. Some 20 MB.
MAX_BROADCAST_KEYS = 1_000_000
#: Times as often among bad documents as among good ones.
LEAST_LIFT = 4.0

#: Set whole words and beginnings apart from runs of the same bytes elsewhere.
_WHOLE, _PREFIX = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_CODE = np.arange(256)
_WORD_BYTE = (((_CODE >= 48) & (_CODE <= 57)) | ((_CODE >= 65) & (_CODE <= 90))
              | ((_CODE >= 97) & (_CODE <= 122)) | (_CODE >= 128))
_SENTENCE_END = np.isin(_CODE, [ord(c) for c in ".!?\n"])


class Grams(NamedTuple):
    """Hashed features of a block of texts: bucket, sentence and where sentences and texts lie."""

    bucket: np.ndarray
    sentence: np.ndarray
    text_of_sentence: np.ndarray
    has_words: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text_start: np.ndarray


def grams_of(texts: list[bytes]) -> Grams:
    """Words, their beginnings, and runs of bytes within words, of every sentence; A-Z count as
    a-z."""
    lengths = np.fromiter((len(text) + 1 for text in texts), np.int64, len(texts))
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    text_start = np.concatenate(([0], np.cumsum(lengths)))
    ends = np.flatnonzero(_SENTENCE_END[data]) + 1  # every text closes with a line feed
    sentence_of_byte = np.cumsum(_SENTENCE_END[data]) - _SENTENCE_END[data]
    starts = np.concatenate(([0], ends[:-1]))
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD_BYTE[data]
    edges = np.flatnonzero(np.diff(inside))
    word_start, word_end = edges[::2], edges[1::2]
    sums = prefix_hashes(VALUE_OF_LOWER[data])
    begin, hashes = [word_start], [mix(run_hashes(sums, word_start, word_end) ^ _WHOLE)]
    for n in PREFIX_BYTES:
        at = word_start[word_end - word_start >= n]
        begin.append(at)
        hashes.append(mix(run_hashes(sums, at, at + n) ^ _PREFIX))
    outside = np.concatenate(([0], np.cumsum(inside[1:-1] == 0)))
    for n in GRAM_BYTES:
        if len(data) > n:
            at = np.flatnonzero(outside[n:] == outside[:-n])
            begin.append(at)
            hashes.append(run_hashes(sums, at, at + n))
    begin = np.concatenate(begin)
    bucket = (np.concatenate(hashes) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    has_words = np.zeros(len(ends), bool)
    has_words[sentence_of_byte[word_start]] = True
    return Grams(bucket, sentence_of_byte[begin],
                 np.searchsorted(text_start, starts, "right") - 1, has_words, starts, ends,
                 text_start)


class Model(NamedTuple):
    """Weight per bucket (0 for those not chosen) and the bias of a sentence."""

    weights: np.ndarray
    bias: float


def _hits(grams: Grams, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (sentence, bucket) among the chosen buckets, in order."""
    at = np.flatnonzero(chosen[grams.bucket])
    keys = np.unique((grams.sentence[at] << BUCKET_BITS) | grams.bucket[at])
    return keys >> BUCKET_BITS, keys & ((1 << BUCKET_BITS) - 1)


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def _labelled(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str,
              most: int) -> DataFrame:
    """Whole texts of at most ``most`` labelled rows, chosen by the hash of their id."""
    rows = labels.select(F.col(id).alias("_key"), F.col(label).cast("int").alias("_label")).filter(
        "_key IS NOT NULL AND _label IN (0, 1)")
    if rows.count() > most:
        rows = rows.orderBy(F.xxhash64("_key"), "_key", "_label").limit(most)
    return docs.select(F.col(id).alias("_id"), F.col(text).cast("binary").alias("_text")).join(
        F.broadcast(rows), F.col("_id") == F.col("_key")).select("_text", "_label")


def choose_features(examples: DataFrame, most: int, least: float) -> np.ndarray:
    """Buckets that speak for class 1: by the log-likelihood ratio of the numbers of documents."""
    size = 1 << BUCKET_BITS

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size + 1), np.int64)
        for batch, texts in blocks(batches, "_text"):
            labels = np.array(batch.column("_label").to_pylist(), np.int64)
            counts[:, size] += np.bincount(labels, minlength=2)
            grams = grams_of(texts)
            keys = np.unique((grams.text_of_sentence[grams.sentence] << BUCKET_BITS)
                             | grams.bucket)
            label = labels[keys >> BUCKET_BITS]
            for c in (0, 1):
                counts[c, :size] += np.bincount(keys[label == c] & (size - 1), minlength=size)
        seen = np.flatnonzero(counts.sum(0))
        for begin in range(0, len(seen), 50_000):
            part = seen[begin:begin + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(counts[0, part]), pa.array(counts[1, part])],
                ["bucket", "n0", "n1"])

    counts = examples.mapInArrow(partial, "bucket int, n0 long, n1 long").groupBy("bucket").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()  # a row per bucket at most
    total = counts[counts.bucket == size]
    if total.empty:
        return np.zeros(0, np.int64)
    all0, all1 = float(total.n0.iloc[0]), float(total.n1.iloc[0])
    rows = counts[counts.bucket < size].sort_values("bucket")
    n0, n1 = rows.n0.to_numpy(float), rows.n1.to_numpy(float)

    def part(observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(observed > 0, observed * np.log(observed / expected), 0.0)

    share = (n0 + n1) / (all0 + all1)
    ratio = 2 * (part(n0, all0 * share) + part(n1, all1 * share)
                 + part(all0 - n0, all0 * (1 - share)) + part(all1 - n1, all1 * (1 - share)))
    ratio[n1 * all0 <= LEAST_LIFT * n0 * all1] = 0
    best = np.argsort(-ratio, kind="stable")[:most]
    return rows.bucket.to_numpy()[best[ratio[best] >= least]].astype(np.int64)


def learn(bags: pa.Table, chosen: np.ndarray, steps: int = 400, rate: float = 0.1,
          l2: float = 3e-5) -> Model:
    """Weights of the noisy-or model by full gradient steps (Adam) on the bags."""
    weights = np.zeros(1 << BUCKET_BITS, np.float64)
    if bags.num_rows == 0:
        return Model(weights, -6.0)
    y = bags.column("label").to_numpy().astype(float)
    other = bags.column("others").to_numpy().astype(float)
    place = np.full(1 << BUCKET_BITS, -1, np.int64)
    place[chosen] = np.arange(len(chosen))

    def flat(name: str) -> tuple[np.ndarray, np.ndarray]:
        column = bags.column(name).combine_chunks()
        return (column.flatten().to_numpy(zero_copy_only=False),
                np.repeat(np.arange(bags.num_rows), column.value_lengths().to_numpy()))

    buckets, bag_of = flat("buckets")
    sentences, _ = flat("sentences")
    keys, sentence = np.unique(np.stack([bag_of, sentences]), axis=1, return_inverse=True)
    sentence = sentence.ravel()
    bag_of_sentence = keys[0].astype(np.int64)
    feature = place[buckets]
    w, b = np.full(len(chosen), 0.5), -5.0
    state = [np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)]
    n = float(len(y))
    for step in range(1, steps + 1):
        z = b + np.bincount(sentence, w[feature], len(bag_of_sentence))
        total = (np.bincount(bag_of_sentence, _softplus(z), len(y)) + other * _softplus(b))
        by_total = np.where(y == 1, -1.0 / np.expm1(np.clip(total, 1e-9, 500)), 1.0)
        by_z = by_total[bag_of_sentence] / (1 + np.exp(-z))
        slope = np.concatenate((
            np.bincount(feature, by_z[sentence], len(chosen)) / n + l2 * w,
            [(by_z.sum() + (by_total * other).sum() / (1 + np.exp(-b))) / n]))
        state[0] = 0.9 * state[0] + 0.1 * slope
        state[1] = 0.999 * state[1] + 0.001 * slope ** 2
        move = rate * (state[0] / (1 - 0.9 ** step)) / (
            np.sqrt(state[1] / (1 - 0.999 ** step)) + 1e-9)
        w, b = np.maximum(w - move[:-1], 0.0), min(b - move[-1], -4.0)
    weights[chosen] = w
    return Model(weights, float(b))


def fit(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text",
        label: str = "toxic", max_examples: int = MAX_EXAMPLES, max_bags: int = MAX_BAGS,
        max_features: int = MAX_FEATURES, least_evidence: float = LEAST_EVIDENCE) -> Model:
    """A model from labels of whole documents; no sentence is labelled.

    A sentence is bad with a probability that is logistic in the sum of its features' weights, and
    a document is bad unless all its sentences are good (noisy-or). Weights are never negative:
    good words excuse nothing. Features come from at most ``max_examples`` labelled documents,
    weights from at most ``max_bags``; both are taken by hash of the id and only where there are
    more. Without labels nothing is found bad.
    """
    examples = _labelled(docs, labels, id, text, label, max_examples)
    chosen = choose_features(examples, max_features, least_evidence)
    mask = np.zeros(1 << BUCKET_BITS, bool)
    mask[chosen] = True

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "_text"):
            grams = grams_of(texts)
            sentences, buckets = _hits(grams, mask)
            text_of = grams.text_of_sentence[sentences]
            offsets = np.searchsorted(text_of, np.arange(len(texts) + 1)).astype(np.int32)
            worded = np.bincount(grams.text_of_sentence[grams.has_words], minlength=len(texts))
            hit = np.bincount(grams.text_of_sentence[np.unique(sentences)], minlength=len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_label"), pa.array(worded - hit, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(sentences, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(buckets, pa.int32()))],
                ["label", "others", "sentences", "buckets"])

    rows = _labelled(docs, labels, id, text, label, max_bags).mapInArrow(
        bags, "label int, others long, sentences array<int>, buckets array<int>")
    return learn(rows.toArrow(), chosen)


SENTENCES = "array<struct<start:long,length:long,score:double,sentence:string>>"


def score(docs: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text",
          bad: float = 0.5, keep: list[str] = ()) -> DataFrame:
    """id, score and the offending sentences of every whole text, from the text alone.

    ``score`` is the noisy-or over all sentences; ``offending`` lists those with a score of at
    least ``bad``: where they lie (in code points), score and words. Null and empty texts have no
    sentence and score 0. Repeated rows are scored each; an empty table gives an empty result.
    Columns named in ``keep`` are carried along; others are ignored.
    """
    names = [f"_k{place}" for place in range(len(keep))]
    selected = docs.select(F.col(id).alias("_id"), F.col(text).cast("binary").alias("_text"),
                           *[F.col(column).alias(name) for column, name in zip(keep, names)])
    chosen = model.weights > 0
    weights, bias = model.weights.astype(np.float32), model.bias
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                ("score", pa.float64()), ("sentence", pa.string())]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "_text"):
            grams = grams_of(texts)
            sentences, buckets = _hits(grams, chosen)
            z = np.full(len(grams.end), bias)
            np.add.at(z, sentences, weights[buckets])
            good = np.where(grams.has_words, _softplus(z), 0.0)
            total = np.bincount(grams.text_of_sentence, good, len(texts))
            found: list[list] = [[] for _ in texts]
            for s in np.unique(sentences):
                p = float(1 / (1 + np.exp(-z[s])))
                if p >= bad:
                    row = grams.text_of_sentence[s]
                    begin = int(grams.start[s] - grams.text_start[row])
                    words = texts[row][begin:int(grams.end[s] - grams.text_start[row])].decode(
                        "utf-8", "replace")
                    found[row].append({
                        "start": len(texts[row][:begin].decode("utf-8", "replace")),
                        "length": len(words), "score": p, "sentence": words})
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(-np.expm1(-total)), pa.array(found, spans),
                 *(batch.column(name) for name in names)],
                ["_id", "score", "offending", *names])

    kinds = dict(selected.dtypes)
    schema = ", ".join([f"_id {kinds['_id']}", "score double", f"offending {SENTENCES}",
                        *(f"{name} {kinds[name]}" for name in names)])
    return selected.mapInArrow(scored, schema).withColumnsRenamed(
        {"_id": id, **dict(zip(names, keep))})


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.7, *, id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """The documents that score below ``threshold``, with all their columns.

    Only keys and texts are scored; the keys of what is toxic, told apart by id and text, are
    written down and their rows left out. Null and empty texts stay, rows that are equal in id and
    text share their fate, ids may be null, and other columns may have any name.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    found = score(keyed(docs, id, text), model, id="_id", text="_text", keep=KEY)
    toxic = found.filter(F.col("score") >= threshold).select(*KEY).distinct().checkpoint()
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    own, body = F.col("row").getField(id), F.col("row").getField(text)
    same = (F.coalesce(own, F.lit(0).cast(dict(docs.dtypes)[id])) == F.col("_a")) & (
        F.xxhash64(own, F.coalesce(body, F.lit(""))) == F.col("_b"))
    if toxic.count() <= MAX_BROADCAST_KEYS:
        toxic = F.broadcast(toxic)
    return rows.join(toxic, same, "left_anti").select("row.*")
