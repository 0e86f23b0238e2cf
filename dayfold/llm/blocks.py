"""Blocks of documents that ask an index, itself in parts, about their keys.

A corpus's n-grams are too many to shuffle one row each. Documents are therefore
dealt to blocks of bounded size by a hash of their id. A block sends each distinct
key once, in one row for each part of the index that holds keys of its; a part
sends one row back to each block. Keys are hashes, and a part is a range of them, so
parts are even however often a key occurs, and a hot key is one entry a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.llm.shared import spread

MESSAGE = "block int, part int, keys binary, values binary"


def in_blocks(docs: DataFrame, blocks: int, id: str, text: str, *more: Column) -> DataFrame:
    """``block``, ``doc_id``, ``text`` and more of every document; null texts are empty."""
    return docs.select(
        spread(F.col(id), blocks).alias("block"),
        F.col(id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        *more,
    )


def planes(values: np.ndarray) -> bytes:
    """Eight-byte integers with their first bytes together, their second, and so on,
    so that what is alike in them compresses."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(data: bytes, kind: type = np.int64) -> np.ndarray:
    each = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(each.T).view(kind).ravel()


def pack(keys: np.ndarray) -> bytes:
    """Rising keys as the steps between them."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)


def pack_values(*columns: np.ndarray) -> bytes:
    return planes(np.concatenate([np.zeros(0, np.int64), *columns]).astype(np.int64))


def unpack_values(data: bytes, columns: int) -> np.ndarray:
    values = from_planes(data)
    return values.reshape(columns, -1) if columns else values.reshape(0, 0)


def pack_small(values: np.ndarray) -> bytes:
    """Numbers from 0 in as many bytes each as the largest needs."""
    width = (int(values.max(initial=0)).bit_length() + 7) // 8
    return planes(values.astype(np.int64))[: width * len(values)]


def unpack_small(data: bytes, size: int) -> np.ndarray:
    return from_planes(data + bytes(8 * size - len(data)))


def firsts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def messages(block: int, parts: int, keys: np.ndarray, *values: np.ndarray) -> pa.Table:
    """Rising keys of a block, in a row for each part that has some."""
    width = (1 << 64) // parts + 1
    bounds = np.searchsorted(keys, np.array([i * width for i in range(parts)] , np.uint64))
    bounds = [*bounds.tolist(), len(keys)]
    rows = [
        (i, pack(keys[a:b]), pack_values(*(v[a:b] for v in values)))
        for i, (a, b) in enumerate(zip(bounds, bounds[1:]))
        if b > a
    ]
    return pa.table(
        {
            "block": pa.array([block] * len(rows), pa.int32()),
            "part": pa.array([r[0] for r in rows], pa.int32()),
            "keys": pa.array([r[1] for r in rows], pa.binary()),
            "values": pa.array([r[2] for r in rows], pa.binary()),
        }
    )


class Entries:
    """What one part of the index got, sorted by key; equal keys by block."""

    def __init__(self, table: pa.Table, columns: int) -> None:
        table = table.sort_by("block")
        self.part = table["part"][0].as_py()
        self.blocks = table["block"].to_numpy()
        keys = [unpack(k.as_py()) for k in table["keys"]]
        self.bounds = np.cumsum([0, *map(len, keys)])
        self.keys = np.concatenate(keys)
        values = [unpack_values(v.as_py(), columns) for v in table["values"]]
        self.values = np.concatenate(values, axis=1) if columns else None
        self.order = np.argsort(self.keys, kind="stable")
        self.begins = firsts(self.keys[self.order])
        self.sizes = np.diff(np.append(self.begins, len(self.keys)))

    def by_key(self, ufunc: np.ufunc, values: np.ndarray) -> np.ndarray:
        """``values`` reduced over the entries of each key, given back to each entry."""
        if not len(values):
            return values
        reduced = ufunc.reduceat(values[self.order], self.begins)
        out = np.empty(len(values), reduced.dtype)
        out[self.order] = np.repeat(reduced, self.sizes)
        return out

    @property
    def holders(self) -> np.ndarray:
        """For each entry, how many blocks have its key."""
        out = np.empty(len(self.keys), np.int64)
        out[self.order] = np.repeat(self.sizes, self.sizes)
        return out

    def values_back(self, values: np.ndarray) -> pa.Table:
        """A value for every entry, in the order it was sent in, without the keys."""
        rows = [
            (block, np.int64(b - a).tobytes(), pack_small(values[a:b]))
            for block, a, b in zip(self.blocks.tolist(), self.bounds, self.bounds[1:])
        ]
        return pa.table(
            {
                "block": pa.array([r[0] for r in rows], pa.int32()),
                "part": pa.array([self.part] * len(rows), pa.int32()),
                "keys": pa.array([r[1] for r in rows], pa.binary()),
                "values": pa.array([r[2] for r in rows], pa.binary()),
            }
        )

    def replies(self, wanted: np.ndarray, *values: np.ndarray) -> pa.Table:
        """The wanted entries' keys and values, in a row for each block."""
        rows = []
        for block, a, b in zip(self.blocks.tolist(), self.bounds, self.bounds[1:]):
            own = np.flatnonzero(wanted[a:b]) + a
            if len(own):
                columns = [v[own] for v in values]
                rows.append((block, pack(self.keys[own]), pack_values(*columns)))
        return pa.table(
            {
                "block": pa.array([r[0] for r in rows], pa.int32()),
                "part": pa.array([self.part] * len(rows), pa.int32()),
                "keys": pa.array([r[1] for r in rows], pa.binary()),
                "values": pa.array([r[2] for r in rows], pa.binary()),
            }
        )


def received(table: pa.Table, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's replies as rising keys and their values."""
    table = table.sort_by("part")
    keys = [unpack(k.as_py()) for k in table["keys"]]
    values = [unpack_values(v.as_py(), columns) for v in table["values"]]
    if not keys:
        return np.zeros(0, np.uint64), np.zeros((columns, 0), np.int64)
    return np.concatenate(keys), np.concatenate(values, axis=1) if columns else None


def received_values(table: pa.Table) -> np.ndarray:
    """The values that came back for all of a block's keys, rising."""
    values = [np.zeros(0, np.int64)]
    for row in table.sort_by("part").to_pylist():
        values.append(unpack_small(row["values"], int(np.frombuffer(row["keys"], np.int64)[0])))
    return np.concatenate(values)


def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted key is among the rising ``keys``, and where."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at
