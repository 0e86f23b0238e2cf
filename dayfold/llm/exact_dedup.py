"""Exact dedup: one document of each group of equal texts stays.

Texts are compared by their SHA-256 digest. Digests are spread over tasks by
value, and each task keeps the live digests of its share in a cuckoo index: a
table of short fingerprints, two buckets for each digest, in front of the digests
themselves. A fingerprint that is not there proves a text new; one that is there
is checked against the whole digest stored for it.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 4
LEAST_BUCKETS = 1 << 8
KICKS = 200

# Rows in one share of the index, some 150 bytes each.
SHARE_ROWS = 1_000_000

# Fixed value: odd multiplier that spreads a fingerprint over bucket numbers.
SPREAD = 0x5BD1E995


class CuckooIndex:
    """Live digests, each with its row number; rows of deleted digests are reused.

    When a digest finds no slot after ``KICKS`` moves the table doubles and is
    filled anew from the stored digests.
    """

    def __init__(self, buckets: int = LEAST_BUCKETS) -> None:
        self.digests: list[bytes | None] = []
        self.free: list[int] = []
        self._clear(buckets)

    def __len__(self) -> int:
        return len(self.digests) - len(self.free)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = array("H", bytes(2 * SLOTS * buckets))  # 0: empty
        self.rows = array("q", bytes(8 * SLOTS * buckets))

    @staticmethod
    def _print(digest: bytes) -> int:
        return int.from_bytes(digest[8:10], "big") or 1

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * SPREAD)) & self.mask

    def _slots(self, digest: bytes) -> tuple[int, int, int]:
        mark = self._print(digest)
        bucket = int.from_bytes(digest[:8], "big") & self.mask
        return mark, bucket, self._other(bucket, mark)

    def _find(self, digest: bytes) -> int | None:
        mark, *buckets = self._slots(digest)
        for bucket in buckets:
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[slot] == mark and self.digests[self.rows[slot]] == digest:
                    return slot
        return None

    def row(self, digest: bytes) -> int | None:
        slot = self._find(digest)
        return None if slot is None else self.rows[slot]

    def insert(self, digest: bytes) -> int:
        """The digest's row number, new or known."""
        known = self.row(digest)
        if known is not None:
            return known
        if self.free:
            row = self.free.pop()
            self.digests[row] = digest
        else:
            row = len(self.digests)
            self.digests.append(digest)
        if not self._place(digest, row):
            self._grow()
        return row

    def delete(self, digest: bytes) -> int | None:
        """Forget a digest; its row number, or None if it is not there."""
        slot = self._find(digest)
        if slot is None:
            return None
        row = self.rows[slot]
        self.prints[slot] = 0
        self.digests[row] = None
        self.free.append(row)
        return row

    def _place(self, digest: bytes, row: int) -> bool:
        mark, first, second = self._slots(digest)
        bucket = first
        for kick in range(KICKS):
            for place in (first, second) if not kick else (bucket,):
                for slot in range(place * SLOTS, place * SLOTS + SLOTS):
                    if not self.prints[slot]:
                        self.prints[slot], self.rows[slot] = mark, row
                        return True
            # Full: put it in place of another, which goes to its other bucket.
            slot = bucket * SLOTS + kick % SLOTS
            mark, self.prints[slot] = self.prints[slot], mark
            row, self.rows[slot] = self.rows[slot], row
            bucket = self._other(bucket, mark)
        return False

    def _grow(self) -> None:
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self._clear(buckets)
            if all(self._place(d, row) for row, d in enumerate(self.digests) if d is not None):
                return


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest of a batch, so that a hot group is a few rows a task."""
    for batch in batches:
        sums = pa.table(batch).group_by(["digest", "removed"], use_threads=False)
        out = sums.aggregate([("keep_id", "max"), ("group_size", "sum")])
        out = out.rename_columns({"keep_id_max": "keep_id", "group_size_sum": "group_size"})
        yield from out.select(batch.schema.names).combine_chunks().to_batches()


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The live groups of one share of the digests."""
    index, keep, size, removed, schema = CuckooIndex(), [], [], [], None
    for batch in batches:
        schema = batch.schema
        for digest, doc, rows, gone in zip(*(c.to_pylist() for c in batch.columns)):
            if gone:
                removed.append(digest)
                continue
            row = index.insert(digest)
            if row == len(keep):
                keep.append(doc)
                size.append(rows)
            else:
                size[row] += rows
                if keep[row] is None or doc is not None and doc > keep[row]:
                    keep[row] = doc
    for digest in removed:
        index.delete(digest)
    if schema is not None:
        live = [row for row, digest in enumerate(index.digests) if digest is not None]
        columns = (
            [index.digests[r] for r in live],
            [keep[r] for r in live],
            [size[r] for r in live],
            [False] * len(live),
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )


def exact_dedup(
    docs: DataFrame,
    removed: DataFrame | None = None,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept`` and ``digest``.

    Of equal texts the one with the largest id stays; a null text counts as
    empty, and a null id as smaller than any. Where that id is repeated with the
    same text, one of its rows stays. Texts of ``removed`` are deleted from the
    index after all documents are in: no copy of them stays, their ``keep_id`` and
    ``group_size`` are null. Empty tables give empty results; other columns are
    not read.
    """
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    rows = (
        docs.select(F.col(id).alias("doc_id"), digest.alias("digest"))
        .groupBy("doc_id", "digest")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    added = rows.select(
        "digest",
        F.col("doc_id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        F.lit(False).alias("removed"),
    )
    schema = added.schema
    if removed is not None:
        id_type = dict(rows.dtypes)["doc_id"]
        added = added.unionByName(
            removed.select(
                digest.alias("digest"),
                F.lit(None).cast(id_type).alias("keep_id"),
                F.lit(0).cast("bigint").alias("group_size"),
                F.lit(True).alias("removed"),
            ).distinct()
        )
    # A share of the index holds its digests in memory, so many rows need many shares.
    shares = math.ceil(docs.count() / SHARE_ROWS)
    combined = added.mapInArrow(_combined, schema)
    if shares > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        combined = combined.repartition(shares, "digest")
    else:
        combined = combined.repartition("digest")
    groups = combined.mapInArrow(_indexed, schema).drop("removed")
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")
    stays = (F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return (
        rows.join(groups, "digest", "left")
        .select("doc_id", "keep_id", "group_size", "digest", copy)
        .withColumn("kept", stays & F.col("group_size").isNotNull())
        .drop("copy")
    )
