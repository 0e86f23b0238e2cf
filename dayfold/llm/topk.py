"""Exact top-k by inner product: sorted lists read in step, without random access.

Candidates and queries are dealt to blocks, and a task has one block of each. It
sorts a segment of its candidates by every component, and reads each list from its
best end for the sign of the query's component, so far in each round. What is unread
is no better than where the list stands (upper bound) and no worse than its end
(lower bound). A candidate whose upper bound is under the k-th best score known
cannot qualify; when few are left their scores are resolved. Segments later in a
block start with the scores of those before. The bests of all blocks are merged.

A task reads its lists as matrix products over all its candidates, and on vectors
without much structure most candidates stay in question and are resolved by the plain
product.

Equal candidates are read once: of each vector the least ids suffice. Of rows with the
same id and vector one counts, and none is a candidate of its own id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold.llm.shared import spread

SCALE = 256

BLOCK_CANDIDATES = 8_192
BLOCK_QUERIES = 2_048
SEGMENT = 1_024

# How far the lists are read by the end of each round.
DEPTHS = (0.25, 0.5, 0.75)

# A round's survivors are resolved when they are under this part of all pairs.
FEW = 0.02

FOUND = "query_id bigint, vec_id bigint, score bigint"


def _matrix(table: pa.Table, limit: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, one of each pair; at most ``limit`` least ids of each vector."""
    ids = table["vec_id"].to_numpy()
    lists = table["vector"].combine_chunks()
    vectors = lists.flatten().to_numpy().reshape(len(ids), -1)
    rows = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.strides[0]))).ravel()
    same, number = np.unique(rows, return_inverse=True)
    order = np.lexsort((ids, number))
    number, ids = number[order], ids[order]
    new = np.ones(len(ids), bool)
    new[1:] = (number[1:] != number[:-1]) | (ids[1:] != ids[:-1])
    order, number, ids = order[new], number[new], ids[new]
    if limit is not None:
        first = np.searchsorted(number, np.arange(len(same)))
        few = np.arange(len(ids)) - first[number] < limit
        order, ids = order[few], ids[few]
    return ids, vectors[order]


class Best:
    """The k best found for each query: score down, then id up."""

    def __init__(self, queries: np.ndarray, k: int) -> None:
        self.k = k
        self.own = queries
        self.query = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        other = self.own[query] != ids
        query = np.concatenate([self.query, query[other]])
        ids = np.concatenate([self.id, ids[other]])
        score = np.concatenate([self.score, score[other]])
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep = place < self.k
        self.query, self.id, self.score = query[keep], ids[keep], score[keep]

    @property
    def least(self) -> np.ndarray:
        """Each query's k-th best score; none yet is minus infinity."""
        out = np.full(len(self.own), -np.inf)
        place = np.arange(len(self.query)) - np.searchsorted(self.query, self.query)
        full = place == self.k - 1
        out[self.query[full]] = self.score[full]
        return out


def _resolve(queries: np.ndarray, vectors: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = [np.zeros(0, np.int64)]
    for i in range(0, len(q), 1 << 16):
        out.append(np.einsum("ij,ij->i", queries[q[i : i + (1 << 16)]], vectors[c[i : i + (1 << 16)]]))
    return np.concatenate(out)


def _segment(best: Best, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
    """Read the sorted lists of one segment until nothing unresolved can qualify."""
    n, width = vectors.shape
    lists = np.sort(vectors, axis=0)
    # Rounding of sums beyond what a double holds exactly.
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * width
    slack = 0.0 if largest < 2.0**53 else largest * width * 1e-15
    up, down = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
    active = np.arange(len(queries))
    for depth in DEPTHS:
        if not len(active):
            return
        read = min(n - 1, math.ceil(n * depth))
        top, bottom = lists[n - 1 - read], lists[read]
        # A component is known where its list was read, else bounded by where it stands.
        upper = up[active] @ np.maximum(vectors, top).astype(float).T
        upper += down[active] @ np.minimum(vectors, bottom).astype(float).T
        lower = up[active] @ np.where(vectors >= top, vectors, lists[0]).astype(float).T
        lower += down[active] @ np.where(vectors <= bottom, vectors, lists[-1]).astype(float).T
        if n > best.k:  # one more than k: a query may meet itself
            place = n - best.k - 1
            least = np.partition(lower, place, axis=1)[:, place]
            least = np.maximum(best.least[active], least)
        else:
            least = best.least[active]
        open_ = upper >= least[:, None] - slack
        few = open_.sum(axis=1) <= max(2 * best.k, FEW * n)
        q, c = np.nonzero(open_[few])
        q = active[few][q]
        best.add(q, ids[c], _resolve(queries, vectors, q, c))
        active = active[~few]
    # The lists are read to their ends: all scores are known.
    if len(active):
        exact = slack == 0.0
        scores = (
            (queries[active].astype(float) @ vectors.astype(float).T).astype(np.int64)
            if exact
            else queries[active] @ vectors.T
        )
        enough = best.least[active][:, None] <= scores
        q, c = np.nonzero(enough)
        best.add(active[q], ids[c], scores[enough])


def _search(k: int):
    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        if not candidates.num_rows or not queries.num_rows:
            none = pa.array([], pa.int64())
            return pa.table({"query_id": none, "vec_id": none, "score": none})
        own, asked = _matrix(queries, None)
        ids, vectors = _matrix(candidates, k + 1)
        best = Best(own, k)
        # In order of a hash, so that segments are alike.
        order = np.argsort((ids * 0x5851F42D4C957F2D) & 0x7FFFFFFF, kind="stable")
        for i in range(0, len(ids), SEGMENT):
            part = order[i : i + SEGMENT]
            _segment(best, asked, ids[part], vectors[part])
        return pa.table({"query_id": own[best.query], "vec_id": best.id, "score": best.score})

    return search


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """For each row that ``queries`` chooses, the ``k`` rows with the highest inner
    product: ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``.

    Components are floor(256 * x). Ties go to the smaller id, and with fewer rows all
    are given. A row is no answer to its own id. Null and empty vectors, those with
    null or infinite components or NaN, and rows without an id take no part; vectors
    of different lengths are not compared; an id repeated with the same vector counts
    once. Other columns are not read.
    """
    x = F.col("vector")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = (
        vectors.where(F.col(id).isNotNull())
        .select(
            F.col(id).cast("bigint").alias("vec_id"),
            F.col(vector).cast("array<double>").alias("vector"),
            F.coalesce(queries, F.lit(False)).alias("asks"),
        )
        .where((F.size(x) > 0) & usable)
        .select("vec_id", "asks", F.transform(x, lambda v: F.floor(v * SCALE)).alias("vector"))
        .withColumn("width", F.size("vector"))
    )
    counts = rows.agg(F.count(F.lit(1)).alias("all"), F.count_if("asks").alias("ask")).first()
    c_blocks = max(1, math.ceil(counts["all"] / BLOCK_CANDIDATES))
    q_blocks = max(1, math.ceil(counts["ask"] / BLOCK_QUERIES))

    def every(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    # A block of candidates goes to each block of queries, and the other way round.
    candidates = rows.select(
        "vec_id", "vector", "width", spread(F.col("vec_id"), c_blocks).alias("c"), every(q_blocks, "q")
    )
    asked = rows.where("asks").select(
        "vec_id", "vector", "width", spread(F.col("vec_id"), q_blocks).alias("q"), every(c_blocks, "c")
    )
    keys = ["width", "c", "q"]
    found = (
        candidates.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_search(k), FOUND)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
