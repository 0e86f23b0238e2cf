"""Quality classifier: logistic regression on hashed word n-grams.

A text's features are the n-grams of its words and of its words' shapes (letter
case, digits and signs, runs as one, and whether a word repeats the one before).
Each is hashed to one of 2^``bits`` weights; its value is its share among the
text's n-grams of that sort, so a score is a sparse dot product that reads a text
once. Weights are learned by follow-the-regularised-leader updates, one labelled
document after another, on a sample of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.llm.words import GOLDEN, Words, grams, hash_spans, inside, mix, slices, words_of

# Shapes of bytes: lower-case letters, with all of other alphabets, upper-case
# letters, and digits; a sign is its own shape.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[ord("a") : ord("z") + 1] = ord("a")
SHAPE[0x80:] = ord("a")
SHAPE[ord("A") : ord("Z") + 1] = ord("A")
SHAPE[ord("0") : ord("9") + 1] = ord("0")

REPEATED = np.uint64(0xD1B54A32D192ED03)  # fixed value: sets a repeated word's shape apart


SORTS = np.arange(1, 17, dtype=np.uint64) * GOLDEN  # sets the sorts of n-grams apart


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled documents that are learned from: those whose
    ids have the lowest hashes. ``alpha`` to ``l2`` are the updates' rates."""

    bits: int = 20
    word_grams: tuple[int, ...] = (1, 2)
    shape_grams: tuple[int, ...] = (1, 2, 3)
    sample: int = 8_000
    epochs: int = 2
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 1e-5
    l2: float = 1e-4


def shapes(words: Words) -> np.ndarray:
    """A hash of each word's shape."""
    if not len(words.hashes):
        return words.hashes
    kinds = SHAPE[words.data]
    first = np.zeros(len(kinds) + 1, bool)
    first[words.starts] = True
    changed = first[:-1].copy()
    changed[1:] |= kinds[1:] != kinds[:-1]
    place = np.concatenate([[0], np.cumsum(changed)])
    out = hash_spans(kinds[changed], place[words.starts], place[words.ends])
    again = np.zeros(len(out), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.text[1:] == words.text[:-1])
    return np.where(again, mix(out ^ REPEATED), out)


def features(words: Words, settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each sort of n-gram, the number of its text and its weight's place."""
    out, text = [], words.text
    sorts = [(words.hashes, n) for n in settings.word_grams]
    shape = shapes(words)
    sorts += [(shape, n) for n in settings.shape_grams]
    for sort, (hashes, n) in enumerate(sorts):
        own = inside(text, n)
        places = mix(grams(hashes, n) + SORTS[sort]) >> np.uint64(64 - settings.bits)
        out.append((text[: len(own)][own], places[own].astype(np.int64)))
    return out


def _margin(weights: np.ndarray, bias: float, words: Words, settings: Settings) -> np.ndarray:
    n = len(words.counts)
    total = np.full(n, bias)
    for text, places in features(words, settings):
        size = np.bincount(text, minlength=n)
        total += np.bincount(text, weights[places], minlength=n) / np.maximum(size, 1)
    return total


def probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -35.0, 35.0)))


def train(texts: pa.Array, labels: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights after ``epochs`` passes over the documents in their order, and the bias.

    The bias is not learned but the log-odds of the labels, each counted once more
    than seen: the score of a text that says nothing.
    """
    size = 1 << settings.bits
    z, n = np.zeros(size), np.zeros(size)
    ones = float(np.sum(labels))
    bias = float(np.log((ones + 1) / (len(labels) - ones + 1)))

    def weight(at: np.ndarray) -> np.ndarray:
        active = np.abs(z[at]) > settings.l1
        scale = (settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2
        return np.where(active, (np.sign(z[at]) * settings.l1 - z[at]) / scale, 0.0)

    for _ in range(settings.epochs):
        for i, label in enumerate(labels):
            places, values = [], []
            for _, found in features(words_of(texts[i : i + 1]), settings):
                place, count = np.unique(found, return_counts=True)
                places.append(place)
                values.append(count / max(1, len(found)))
            at, x = np.concatenate(places), np.concatenate(values)
            at, where = np.unique(at, return_inverse=True)
            x = np.bincount(where, x)
            w = weight(at)
            gradient = (probability(bias + np.dot(w, x)) - label) * x
            step = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / settings.alpha
            z[at] += gradient - step * w
            n[at] += gradient**2
    return weight(np.arange(size)).astype(np.float32), bias


def learned(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> tuple[np.ndarray, float]:
    """The weights and bias, from a bounded sample of the labelled documents.

    ``labels`` has an id and a label of 0 or 1; rows where either is null are
    left out, and of several labels of one id the largest counts. The sample's
    ids are few enough to send to every task; its texts are put in order in one.
    What comes back has 2^``bits`` numbers. Without labelled documents all
    weights are 0.
    """
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull())
    chosen = (
        known.groupBy(F.col(id).alias("doc_id"))
        .agg(F.max(label).cast("int").alias("label"))
        .withColumn("place", F.xxhash64("doc_id"))
        .orderBy("place", "doc_id")
        .limit(settings.sample)
    )
    texts = docs.select(F.col(id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id").select("place", "doc_id", "label", "text")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        rows = rows.sort_by([(c, "ascending") for c in ("place", "doc_id", "text")])
        weights, bias = train(rows["text"].combine_chunks(), rows["label"].to_numpy(), settings)
        columns = [pa.array([weights.tobytes()], pa.binary()), pa.array([bias])]
        yield pa.RecordBatch.from_arrays(columns, names=["weights", "bias"])

    sample = sample.withColumn("doc_id", F.col("doc_id").cast("bigint")).repartition(1)
    model = sample.mapInArrow(fit, "weights binary, bias double").first()
    if model is None:
        return train(pa.array([], pa.string()), np.zeros(0), settings)
    return np.frombuffer(model["weights"], np.float32), model["bias"]


def score(
    docs: DataFrame,
    model: tuple[np.ndarray, float],
    settings: Settings = Settings(),
    text: str = "text",
    out: str = "score",
) -> DataFrame:
    """``docs`` with the probability of label 1 in the column ``out``.

    Only the text counts; a null counts as empty, whose score is that of the
    bias. Other columns pass through, and a column named ``out`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(out)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value
        for batch in chain.from_iterable(slices(b, text) for b in batches):
            words = words_of(batch.column(text))
            column = probability(_margin(weights, bias, words, settings))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(column)], names=[*batch.schema.names, out]
            )

    schema = docs.select("*", F.lit(0.0).alias(out)).schema
    return docs.mapInArrow(scored, schema)


def held_out(id: str = "doc_id") -> Column:
    """Rows no label of which is learned from: a third, by their id."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % 3 == 1
