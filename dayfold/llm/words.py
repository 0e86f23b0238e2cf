"""Words of many texts at once, as 64-bit hashes, on Arrow buffers.

A word is a run of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text. Equal
words have equal hashes; different words collide once in 2^64 pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Odd multipliers of the hashes (2^64 / golden ratio, and the two
# of the splitmix64 finaliser).
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)

# Text worked on at a time.
BATCH_BYTES = 3 << 20

# Bytes of the words that are hashed together.
SHORT = 64

# The lowest so many bytes of eight.
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of ``h`` over all bits (splitmix64's finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * MIX1
    h = (h ^ (h >> np.uint64(27))) * MIX2
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Hashes of all words, their byte places, and where each text's words begin."""

    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray  # text i has words offsets[i] to offsets[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def text(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and their bounds; a null has no bytes."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks)
    texts = texts.fill_null("")
    _, bounds, data = texts.buffers()
    at = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, text: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most so many bytes of text each, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(batch):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """The words of each text; with ``lower``, A-Z count as a-z."""
    data, bounds = text_bytes(texts)
    if lower:
        data = LOWER[data]
    space = SPACE[data]
    # A text begins a word however the text before it ended.
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.ones(len(data), bool)
    before[1:] = space[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = space[1:]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    offsets = np.searchsorted(starts, bounds)
    return Words(data, hash_spans(data, starts, ends), starts, ends, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes from each start to its end.

    Short spans are mixed in eight bytes after another, all at once; of the same length
    up to eight, different ones have different hashes. Long ones go through BLAKE2.
    """
    lengths = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    out = mix(lengths.astype(np.uint64) * GOLDEN)
    short = np.flatnonzero(lengths <= SHORT)
    for at in range(0, SHORT, 8):
        short = short[lengths[short] > at]
        held = np.minimum(lengths[short] - at, 8)
        out[short] = mix(out[short] ^ (eight[starts[short] + at] & LOW_BYTES[held])) + GOLDEN
    for i in np.flatnonzero(lengths > SHORT):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.uint64(int.from_bytes(digest, "little"))
    return out


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of the ``n`` words from each word on, for all but the last n - 1.

    Grams that run from one text into the next are included; ``inside`` tells.
    """
    size = max(0, len(hashes) - n + 1)
    h = np.full(size, np.uint64(n), np.uint64)
    for i in range(n):
        h = (h ^ hashes[i : i + size]) * GOLDEN
        h ^= h >> np.uint64(29)
    return mix(h)


def inside(text: np.ndarray, n: int) -> np.ndarray:
    """Which grams of ``n`` words lie in one text, by the words' text numbers."""
    size = max(0, len(text) - n + 1)
    return text[:size] == text[n - 1 : n - 1 + size]
