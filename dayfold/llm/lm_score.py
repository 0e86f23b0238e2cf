"""Language-model scores by deleted interpolation of word bigrams.

A token's probability mixes three estimates: the maximum-likelihood ones of its
bigram and of its word, and an even one over all words and one unknown. The mixture
weights depend on how often the context was seen, by powers of two, and are
learned by expectation-maximisation on deleted counts: every training token is
taken as held out, its own occurrence taken off all counts.

Counts are of all training documents. Each block of documents asks the index for
the totals of its words and bigrams (``blocks.py``), then writes the counts of its
tokens down. Learning and scoring read that table. A text ends in a token of its
own, which is also the context of its first word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.llm.blocks import (
    MESSAGE,
    Entries,
    firsts,
    in_blocks,
    messages,
    pack_small,
    received,
    received_values,
    unpack_small,
)
from dayfold.llm.shared import block_count, settled
from dayfold.llm.words import grams, mix, words_of

END = mix(np.array([1], np.uint64))[0]  # stands for the end of a text

# The lowest bit of a key tells words from bigrams.
WORD, BIGRAM = np.uint64(0), np.uint64(1)

# Replies for this block carry the number of distinct training words.
TOTALS = -1

COUNTS = (
    "doc_id bigint, training boolean, n_tokens bigint, words binary, bigrams binary, "
    "distinct bigint"
)

# For learning, probabilities are grouped by steps of their logarithm, so that what
# comes to the driver has at most CONTEXTS * BINS * BINS rows.
CONTEXTS = 48
STEPS = 4  # to a power of two
BINS = 48 * STEPS
ROUNDS = 60
LEAST = 1e-6  # of the even estimate's weight


class Tokens:
    """The tokens of a block's documents, and their keys in the index."""

    def __init__(self, docs: pa.Table) -> None:
        words = words_of(docs["text"], lower=True)
        n = len(words.counts)
        # Room for an end after each text's words.
        hashes = np.insert(words.hashes, words.offsets[1:], END)
        self.counts = words.counts + 1
        self.offsets = words.offsets + np.arange(n + 1)
        before = np.concatenate([[END], hashes[:-1]]).astype(np.uint64)
        pairs = np.stack([before, hashes], axis=1).ravel()
        self.words = hashes & ~BIGRAM | WORD
        self.bigrams = grams(pairs, 2)[::2] & ~BIGRAM | BIGRAM
        self.training = np.repeat(docs["training"].to_numpy(), self.counts)

    def own(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys rising, how often each is in training here, and the key number
        of each word, then of each bigram."""
        keys = np.concatenate([self.words, self.bigrams])
        order = np.argsort(keys, kind="stable")
        begins = firsts(keys[order])
        training = np.concatenate([self.training, self.training]).astype(np.int64)
        counts = np.add.reduceat(training[order], begins)
        number = np.empty(len(keys), np.int64)
        sizes = np.diff(np.append(begins, len(keys)))
        number[order] = np.repeat(np.arange(len(begins)), sizes)
        return keys[order][begins], counts, number


def _ask(parts: int):
    def ask(docs: pa.Table) -> pa.Table:
        keys, counts, _ = Tokens(docs).own()
        return messages(docs["block"][0].as_py(), parts, keys, counts)

    return ask


def _answer(table: pa.Table) -> pa.Table:
    entries = Entries(table, 1)
    own = entries.values[0]
    totals = entries.by_key(np.add, own)
    replies = entries.values_back(totals - own)  # mostly 0
    first = entries.order[entries.begins]
    distinct = np.count_nonzero((entries.keys[first] & BIGRAM == WORD) & (totals[first] > 0))
    total = messages(TOTALS, 1, np.ones(1, np.uint64), np.array([distinct]))
    total = total.set_column(1, "part", pa.array([entries.part], pa.int32()))
    return pa.concat_tables([replies, total])


def _write(docs: pa.Table, replies: pa.Table) -> pa.Table:
    """The counts of each document's tokens, or one row with the distinct words."""
    if not docs.num_rows:
        _, values = received(replies, 1)
        names = [c.split()[0] for c in COUNTS.split(", ")][:-1]
        empty = {c: pa.nulls(1, t) for c, t in zip(names, TYPES)}
        return pa.table(empty | {"distinct": pa.array([int(values.sum())], pa.int64())})
    tokens = Tokens(docs)
    _, counts, number = tokens.own()
    counts = (counts + received_values(replies))[number]
    size = len(tokens.words)
    spans = list(zip(tokens.offsets.tolist(), tokens.offsets[1:].tolist()))
    return pa.table(
        {
            "doc_id": docs["doc_id"],
            "training": docs["training"],
            "n_tokens": pa.array(tokens.counts.astype(np.int64)),
            "words": pa.array([pack_small(counts[a:b]) for a, b in spans], pa.binary()),
            "bigrams": pa.array(
                [pack_small(counts[size + a : size + b]) for a, b in spans], pa.binary()
            ),
            "distinct": pa.nulls(len(spans), pa.int64()),
        }
    )


TYPES = [pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]


def token_counts(
    docs: DataFrame, training: Column, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The table of counts: for each document those of its words and bigrams among all
    training documents, and rows without an id that count the distinct words."""
    blocks = block_count(docs, text)
    flag = F.coalesce(training, F.lit(False)).alias("training")
    by_block = in_blocks(docs, blocks, id, text, flag).groupBy("block")
    replies = (
        by_block.applyInArrow(_ask(blocks), MESSAGE)
        .groupBy("part")
        .applyInArrow(_answer, MESSAGE)
    )
    return by_block.cogroup(replies.groupBy("block")).applyInArrow(_write, COUNTS)


@dataclass(frozen=True)
class Model:
    """Training tokens, distinct words, and the weights of the bigram, word and even
    estimates for each class of contexts."""

    tokens: int
    distinct: int
    weights: np.ndarray


def context_class(counts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, and 1 + the whole part of log2 of its count."""
    return np.frexp(counts.astype(np.float64))[1]


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    for row in batch.to_pylist():
        if row["n_tokens"] is not None:
            size = row["n_tokens"]
            words, pairs = (unpack_small(row[c], size) for c in ("words", "bigrams"))
            yield row, words, pairs


def learn(counts: DataFrame) -> Model:
    """The model of a settled table of counts.

    Over the deleted counts of all training tokens, in one pass that ends in a
    table of bounded size, on which the weights are iterated.
    """
    totals = counts.agg(
        F.sum(F.when(F.col("training"), F.col("n_tokens"))).alias("tokens"),
        F.sum("distinct").alias("distinct"),
    ).first()
    n, distinct = totals["tokens"] or 0, totals["distinct"] or 0

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            codes = [sums[0]]
            weights = [sums[1]]
            for _, words, pairs in _documents(batch):
                context = np.roll(words, 1) - 1
                code = context_class(context) * BINS + _bin(pairs - 1, context)
                code = code * BINS + _bin(words - 1, n - 1)
                codes.append(code)
                weights.append(np.ones(len(code), np.int64))
            code, where = np.unique(np.concatenate(codes), return_inverse=True)
            sums = code, np.bincount(where, np.concatenate(weights)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(s) for s in sums], names=["code", "n"])

    rows = (
        counts.where("training")
        .mapInArrow(binned, "code bigint, n bigint")
        .groupBy("code")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    code, count = rows["code"].to_numpy(), rows["n"].to_numpy().astype(np.float64)
    even = 1.0 / (distinct + 1)
    estimates = np.stack(
        [_value(code // BINS % BINS), _value(code % BINS), np.full(len(code), even)]
    )
    return Model(n, distinct, _weights(code // (BINS * BINS), estimates, count))


def _bin(part: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """The class of ``part`` / ``whole``: 0 for nothing, else by steps of its logarithm."""
    ratio = part / np.maximum(whole, 1)
    with np.errstate(divide="ignore"):
        step = np.rint(-np.log2(ratio) * STEPS)
    return np.where(part > 0, 1 + np.clip(step, 0, BINS - 2), 0).astype(np.int64)


def _value(bin: np.ndarray) -> np.ndarray:
    return np.where(bin > 0, 2.0 ** (-(bin - 1) / STEPS), 0.0)


def _weights(context: np.ndarray, estimates: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Expectation-maximisation in each class of contexts; a class without tokens has the
    weights of the class below it."""
    out = np.empty((CONTEXTS, 3))
    last = np.array([0.0, 0.0, 1.0])
    for c in range(CONTEXTS):
        own = context == c
        if own.any():
            p, n = estimates[:, own], count[own]
            # An unseen context has no bigrams to trust.
            last = np.array([0.5, 0.5, 0.5]) if c else np.array([0.0, 0.5, 0.5])
            last /= last.sum()
            for _ in range(ROUNDS):
                shares = last[:, None] * p
                shares /= shares.sum(axis=0)
                last = (shares * n).sum(axis=1) / n.sum()
            last = np.maximum(last, [0.0, 0.0, LEAST])
            last /= last.sum()
        out[c] = last
    return out


def score_texts(
    docs: DataFrame,
    training: Column,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: its id, ``training``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score``, both log10 probabilities.

    ``training`` says which documents to learn from; null counts as false. The base
    is the word's frequency with one added to each count. A null or empty text is
    its end alone. Rows with equal ids are scored and counted as often as they occur.
    Without training documents every token is unknown and has probability 1 in both.
    """
    counts = settled(token_counts(docs, training, id, text))
    model = learn(counts)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bigram, word, even = model.weights.T
        even = even / (model.distinct + 1)
        for batch in batches:
            rows = []
            for row, words, pairs in _documents(batch):
                context = np.roll(words, 1)
                c = context_class(context)
                p = bigram[c] * pairs / np.maximum(context, 1)
                p += word[c] * words / max(model.tokens, 1) + even[c]
                base = np.log10((words + 1) / (model.tokens + model.distinct + 1)).sum()
                known = int(np.count_nonzero(words))
                rows.append(
                    (row["doc_id"], row["training"], len(words), known, model.tokens,
                     float(base), float(np.log10(p).sum()))
                )
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=SCORED
            )

    kinds = ["bigint", "boolean", "bigint", "bigint", "bigint", "double", "double"]
    return counts.mapInArrow(scored, ", ".join(f"{c} {k}" for c, k in zip(SCORED, kinds)))


SCORED = ["doc_id", "training", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
