"""Substring dedup by relative Lempel-Ziv parsing over words.

Every document is factored against the corpus of documents with smaller ids. The
reference is indexed by windows of ``WINDOW`` words, in parts by hash; of each window
the index knows one source, its place in the earliest document that holds it. A factor
is followed from window to window for as long as that source runs on, so every word
that a repeated window covers is in a factor. A stretch that runs on longer in a later
document than in the earliest is several factors, which overlap, instead of the longest
one that a greedy parse would take; what is removed is the same. Where one factor ends
and another begins, the windows across the border are looked up like any other.

Not every window is sent to the index. Two equal windows have equal anchors, the
least hash of the ``ANCHOR``-word grams in them, and a window whose anchor occurs
in one document alone is not a repeat. Anchors, some five times fewer, go first.

A window counts as equal by its 64-bit hash, of word hashes of 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dayfold.llm.blocks import (
    MESSAGE,
    Entries,
    firsts,
    found,
    in_blocks,
    messages,
    received,
)
from dayfold.llm.shared import block_count
from dayfold.llm.words import Words, grams, inside, words_of

WINDOW = 13
ANCHOR = 6  # with windows of 13, the least of 8 grams: a step of the sliding minimum

RESULT = (
    "doc_id bigint, n_words bigint, n_removed bigint, kept string, "
    "factors array<struct<start:bigint,length:bigint,source_id:bigint,source_start:bigint>>"
)
FACTORS = pa.list_(
    pa.struct([(c, pa.int64()) for c in ("start", "length", "source_id", "source_start")])
)
NO_DOC = np.iinfo(np.int64).max


class Block:
    """The words and windows of a block's documents, in order of their ids.

    Documents without an id come last and have no windows: none is smaller.
    """

    def __init__(self, table: pa.Table) -> None:
        table = table.sort_by([("doc_id", "ascending")])
        ids = table["doc_id"].combine_chunks()
        self.ids = ids
        self.doc_ids = ids.fill_null(NO_DOC).to_numpy()
        self.words: Words = words_of(table["text"])
        text = self.words.text
        own = inside(text, WINDOW) & (self.doc_ids[text[: max(0, len(text) - WINDOW + 1)]] != NO_DOC)
        self.at = np.flatnonzero(own)  # the first word of each window
        self.doc = text[self.at]

    @property
    def anchors(self) -> np.ndarray:
        least = grams(self.words.hashes, ANCHOR)
        span = 1
        while span < WINDOW - ANCHOR + 1:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        return least[self.at]

    def windows(self, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows' hashes sorted, and which windows they are; equal ones by document."""
        hashes = grams(self.words.hashes, WINDOW)[self.at[among]]
        order = np.argsort(hashes, kind="stable")
        return hashes[order], among[order]

    def position(self, window: np.ndarray) -> np.ndarray:
        """Where windows begin in their documents."""
        return self.at[window] - self.words.offsets[self.doc[window]]


def _anchor_question(parts: int):
    def ask(table: pa.Table) -> pa.Table:
        block = Block(table)
        anchors = block.anchors
        order = np.argsort(anchors, kind="stable")
        begins = firsts(anchors[order])
        docs = block.doc[order]
        last = np.append(begins[1:], len(order)) - 1
        several = docs[begins] != docs[last]
        return messages(table["block"][0].as_py(), parts, anchors[order][begins], several)

    return ask


def _anchor_answer(table: pa.Table) -> pa.Table:
    entries = Entries(table, 1)
    shared = (entries.holders > 1) | (entries.by_key(np.maximum, entries.values[0]) > 0)
    return entries.replies(shared)


def _window_question(parts: int):
    def ask(docs: pa.Table, shared: pa.Table) -> pa.Table:
        if not docs.num_rows or not shared.num_rows:
            return messages(0, parts, np.zeros(0, np.uint64))
        block = Block(docs)
        keys, _ = received(shared, 0)
        likely = np.flatnonzero(found(keys, block.anchors)[0])
        hashes, window = block.windows(likely)
        begins = firsts(hashes)
        first = window[begins]
        ids = block.doc_ids[block.doc[first]]
        number = docs["block"][0].as_py()
        return messages(number, parts, hashes[begins], ids, block.position(first))

    return ask


def _window_answer(table: pa.Table) -> pa.Table:
    """The earliest place of a window, to blocks that do not hold it."""
    entries = Entries(table, 2)
    ids, places = entries.values
    first = entries.by_key(np.minimum, ids)
    place = entries.by_key(np.minimum, np.where(ids == first, places, NO_DOC))
    return entries.replies(first < ids, first, place)


def _sources(block: Block, earlier: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows that occur in an earlier document, that document, and the place there."""
    hashes, window = block.windows(np.arange(len(block.at)))
    begins = firsts(hashes)
    sizes = np.diff(np.append(begins, len(hashes)))
    first = window[begins]
    ids, places = block.doc_ids[block.doc[first]], block.position(first)
    keys, (far_ids, far_places) = received(earlier, 2)
    has, at = found(keys, hashes[begins])
    ids[has], places[has] = far_ids[at[has]], far_places[at[has]]
    ids, places = np.repeat(ids, sizes), np.repeat(places, sizes)
    repeat = np.flatnonzero(ids < block.doc_ids[block.doc[window]])
    order = np.argsort(window[repeat], kind="stable")
    repeat = repeat[order]
    return window[repeat], ids[repeat], places[repeat]


def _parsed(docs: pa.Table, earlier: pa.Table) -> pa.Table:
    """Factor each document of a block, and leave out what its factors cover."""
    block = Block(docs)
    words, n = block.words, len(block.doc_ids)
    window, ids, places = _sources(block, earlier)
    doc, at = block.doc[window], block.at[window]
    # A factor runs on while the next word's window goes on in the same source.
    starts = np.ones(len(at), bool)
    starts[1:] = (
        (at[1:] != at[:-1] + 1)
        | (doc[1:] != doc[:-1])
        | (ids[1:] != ids[:-1])
        | (places[1:] != places[:-1] + 1)
    )
    begins = np.flatnonzero(starts)
    length = np.diff(np.append(begins, len(at))) - 1 + WINDOW
    covered = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(covered, at[begins], 1)
    np.add.at(covered, at[begins] + length, -1)
    kept = np.cumsum(covered)[:-1] == 0
    removed = np.bincount(words.text[~kept], minlength=n)
    factor_doc = doc[begins]
    factors = pa.StructArray.from_arrays(
        [
            pa.array(v)
            for v in (block.position(window[begins]), length, ids[begins], places[begins])
        ],
        names=["start", "length", "source_id", "source_start"],
    )
    bounds = np.searchsorted(factor_doc, np.arange(n + 1)).astype(np.int32)
    return pa.table(
        {
            "doc_id": block.ids,
            "n_words": pa.array(words.counts.astype(np.int64)),
            "n_removed": pa.array(removed.astype(np.int64)),
            "kept": joined(words, kept),
            "factors": pa.ListArray.from_arrays(pa.array(bounds), factors),
        }
    )


def joined(words: Words, kept: np.ndarray) -> pa.Array:
    """Each text's kept words with one space between."""
    n = len(words.counts)
    starts, lengths = words.starts[kept], (words.ends - words.starts)[kept]
    text = words.text[kept]
    last = np.ones(len(text), bool)
    last[:-1] = text[1:] != text[:-1]
    room = lengths + ~last
    ends = np.cumsum(room)
    data = np.full(int(ends[-1]) if len(ends) else 0, ord(" "), np.uint8)
    if len(ends):
        # Shift each word's letters from where they are to where they go.
        inner = np.arange(int(lengths.sum()))
        before = np.cumsum(lengths) - lengths
        goal = np.repeat(ends - room - before, lengths) + inner
        data[goal] = words.data[np.repeat(starts - before, lengths) + inner]
    bytes_of = np.bincount(text, room, minlength=n).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(bytes_of)])
    if bounds[-1] < 1 << 31:
        buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.string(), n, buffers)
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def substring_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its words, how many fall away, the text of those kept, and
    the factors with their sources (start and length in words).

    A word falls away if a window of ``WINDOW`` words that covers it also occurs in
    a document with a smaller id, whatever falls away there. Texts with fewer words,
    null and empty texts lose none. A document without an id is compared with none;
    of rows with one id none is smaller. Other columns are not read.
    """
    blocks = block_count(docs, text)
    dealt = in_blocks(docs, blocks, id, text)
    by_block = dealt.groupBy("block")
    shared = (
        by_block.applyInArrow(_anchor_question(blocks), MESSAGE)
        .groupBy("part")
        .applyInArrow(_anchor_answer, MESSAGE)
    )
    earlier = (
        by_block.cogroup(shared.groupBy("block"))
        .applyInArrow(_window_question(blocks), MESSAGE)
        .groupBy("part")
        .applyInArrow(_window_answer, MESSAGE)
    )
    return by_block.cogroup(earlier.groupBy("block")).applyInArrow(_parsed, RESULT)
