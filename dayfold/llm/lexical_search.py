"""Ranked lexical search without random access (NRA).

Every term of the queries has a list of the documents that hold it, sorted by impact,
the share of a document's score that the term brings. Lists are read in order, some
postings of each at a time. A document's score then lies between the sum of what has
been seen of it and that sum plus, for each list where it has not been seen, the
impact that the list has come to. Once documents can no longer reach the scores held
so far, reading goes on for the others alone, until both bounds of each agree.

Documents are dealt to blocks of bounded numbers of postings, each of which has its own
lists, and every query is answered in each block. The first ``FIRST`` postings of each
whole list give a score that ``k`` documents reach already, which all blocks begin with.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold.llm.shared import BROADCAST_ROWS, cut, settled, spread

# A term's bytes in UTF-8: ASCII letters and digits, and all that is not ASCII.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

# Postings in a block of documents, and queries that are answered there at a time.
BLOCK_POSTINGS = 1 << 20
BLOCK_QUERIES = 1_024

# Postings of each whole list that the first score comes from.
FIRST = 128

# Postings of each list that a block reads at first; then as many again as before.
STEP = 64

TERMS = "row bigint, id bigint, length bigint, terms array<string>, counts array<int>"


def term_counts(texts: DataFrame) -> DataFrame:
    """``row``, ``id``, the number of terms, the distinct terms and how often each
    occurs, of all ``row``, ``id`` and ``text`` that have a term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids, lengths, sizes, terms, counts = [], [], [], [0], [], []
            columns = (batch.column(c) for c in ("row", "id", "text"))
            for row, id, text in zip(*columns):
                found = Counter(TERM.findall(text.as_buffer().to_pybytes().lower()))
                if not found:
                    continue
                rows.append(row.as_py())
                ids.append(id.as_py())
                lengths.append(found.total())
                terms.extend(found)
                counts.extend(found.values())
                sizes.append(len(terms))
            offsets = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows, pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary()).cast(pa.string())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                ],
                names=["row", "id", "length", "terms", "counts"],
            )

    return texts.mapInArrow(count, TERMS)


def numbered(df: DataFrame, id: str, text: str) -> DataFrame:
    """``row``, a number of its own for each row, ``id``, and ``text``; null is empty."""
    return df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id).cast("bigint").alias("id"),
        F.coalesce(text, F.lit("")).alias("text"),
    )


def small(df: DataFrame) -> DataFrame:
    """Cut, and marked for broadcast if it has few rows."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def weight(df: Column, docs: int) -> Column:
    """How much a term counts that so many of the documents hold."""
    return F.floor(1000 * F.ln(F.lit(float(2 * docs + 2)) / (2 * df + 1).cast("double")))


def impact(weight: Column, count: Column, length: Column, docs: int, total: int) -> Column:
    """What a term brings to a score, by its count and the document's length against
    the mean; in whole numbers, division rounding down."""

    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)

    size = F.lit(100 - 50) + div(F.lit(50 * docs) * length, F.lit(total))
    return weight * div(F.lit(1_000_000_000) * count, F.lit(1000) * count + F.lit(20) * size)


def best(
    lists: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int, least: int, step: int = STEP
) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``k`` best of so many documents, and all that tie with the last of them, with
    their scores, as far as these are at least ``least``, which must be positive; and
    how many postings were read.

    ``lists`` are documents and impacts, by falling impact.
    """
    lower = np.zeros(documents, np.int64)
    open_ = np.ones(documents, bool)  # may yet be among the best
    depth, width, read = 0, step, 0
    longest = max((len(docs) for docs, _ in lists), default=0)
    while True:
        ahead = np.zeros(documents, np.int64)  # what lists may add to a document at most
        for docs, impacts in lists:
            part = slice(depth, depth + width)
            own = open_[docs[part]]
            lower[docs[part][own]] += impacts[part][own]
            read += len(docs[part])
            if depth + width < len(docs):
                ahead += impacts[depth + width]
                ahead[docs[: depth + width]] -= impacts[depth + width]
        depth += width
        width = depth
        held = lower[lower > 0]
        if len(held) >= k:
            least = max(least, int(np.partition(held, len(held) - k)[len(held) - k]))
        open_ &= lower + ahead >= least
        if depth >= longest or not ahead[open_].any():
            top = np.flatnonzero(open_ & (lower >= least))
            return top, lower[top], read


def _answer(k: int):
    """The best documents of a block for each query dealt to it."""

    def answer(postings: pa.Table, queries: pa.Table) -> pa.Table:
        rows, at = np.unique(postings["row"].to_numpy(), return_inverse=True)
        ids = np.zeros(len(rows), np.int64)
        known = np.zeros(len(rows), bool)
        ids[at] = postings["id"].fill_null(0).to_numpy()
        known[at] = postings["id"].is_valid().to_numpy()
        term, gain = postings["term"].to_numpy(), postings["impact"].to_numpy()
        order = np.lexsort((-gain, term))
        at, term, gain = at[order], term[order], gain[order]
        begins = np.searchsorted(term, queries["term"].to_numpy())
        ends = np.searchsorted(term, queries["term"].to_numpy(), "right")
        query, least = queries["query"].to_numpy(), queries["least"].to_numpy()
        out = []
        by_query = np.argsort(query, kind="stable")
        cuts = np.flatnonzero(np.diff(query[by_query])) + 1
        for own in np.split(by_query, cuts) if len(query) else []:
            lists = [(at[begins[i] : ends[i]], gain[begins[i] : ends[i]]) for i in own]
            top, scores, _ = best(lists, len(rows), k, max(1, int(least[own[0]])))
            first = np.lexsort((rows[top], ids[top], ~known[top], -scores))[:k]
            out.append((np.full(len(first), query[own[0]]), top[first], scores[first]))
        none = np.zeros(0, np.int64)
        queries_of, tops, scores = map(np.concatenate, zip((none,) * 3, *out))
        return pa.table(
            {
                "query": pa.array(queries_of, pa.int64()),
                "id": pa.array(ids[tops], pa.int64(), mask=~known[tops]),
                "row": pa.array(rows[tops], pa.int64()),
                "score": pa.array(scores, pa.int64()),
            }
        )

    return answer


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 50,
    id: str = "doc_id",
    query_id: str = "item_id",
    text: str = "text",
    block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``k`` documents that score
    highest for each query, all if fewer, with scores above 0.

    Terms are runs of letters and digits, A-Z as a-z, where all that is not ASCII counts
    as a letter; a query's terms count once each. Of equal scores the smaller id ranks
    first, documents without an id last. Rows are documents, and queries, of their own
    however their ids or texts repeat. A query without a term, or without a term that a
    document holds, has no result. Other columns are not read.
    """
    counted = settled(term_counts(numbered(docs, id, text)))
    documents, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    asked = cut(term_counts(numbered(queries, query_id, text)))
    # Terms of queries get numbers; a query's block has a bounded number of queries.
    words = asked.select(F.explode("terms").alias("word")).distinct()
    words = small(words.select("word", F.monotonically_increasing_id().alias("term")))
    parts = max(1, math.ceil(asked.count() / BLOCK_QUERIES))
    wanted = small(
        asked.select("row", spread(F.col("row"), parts).alias("part"), F.explode("terms").alias("word"))
        .join(words, "word")
        .select(F.col("row").alias("query"), "part", "term")
    )
    held = counted.select("row", "id", "length", F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    postings = settled(
        held.select(
            "row",
            "id",
            "length",
            F.col("t.terms").alias("word"),
            F.col("t.counts").cast("bigint").alias("count"),
        )
        .join(words, "word")
        .select("term", "row", "id", "length", "count")
    )
    weights = small(
        postings.groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .select("term", weight(F.col("df"), documents).alias("weight"))
    )
    gained = postings.join(weights, "term").select(
        "term",
        "row",
        "id",
        impact(F.col("weight"), F.col("count"), F.col("length"), documents, total).alias("impact"),
    )
    # A score that k documents reach by the heads of the whole lists alone.
    heads = Window.partitionBy("term").orderBy(F.desc("impact"), "row")
    first = (
        gained.select("term", "row", "impact")
        .withColumn("place", F.row_number().over(heads))
        .where(F.col("place") <= FIRST)
        .join(wanted, "term")
        .groupBy("query", "row")
        .agg(F.sum("impact").alias("lower"))
    )
    best_first = Window.partitionBy("query").orderBy(F.desc("lower"), "row")
    least = (
        first.withColumn("place", F.row_number().over(best_first))
        .where(F.col("place") == k)
        .select("query", F.col("lower").alias("least"))
    )
    asking = cut(
        wanted.join(least, "query", "left").select(
            "query", F.col("part").alias("part"), "term", F.coalesce("least", F.lit(1)).alias("least")
        )
    )
    blocks = max(1, math.ceil(postings.count() / block_postings))
    dealt = gained.join(small(wanted.select("term", "part").distinct()), "term").select(
        spread(F.col("row"), blocks).alias("block"), "part", "term", "row", "id", "impact"
    )
    everywhere = asking.withColumnRenamed("part", "asked").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    answers = (
        dealt.groupBy("block", "part")
        .cogroup(everywhere.groupBy("block", "asked"))
        .applyInArrow(_answer(k), "query bigint, id bigint, row bigint, score bigint")
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    ranked = answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = asked.select(F.col("row").alias("query"), F.col("id").alias("item_id"))
    return ranked.join(small(names), "query").select(
        "item_id", "rank", F.col("id").alias("doc_id"), "score"
    )
