"""Byte-level BPE: encode texts by a rank file, decode ids to bytes.

A text is cut by a pattern, and each match is encoded on its own. Within a match
the bytes are mapped to Latin-1 letters, and an Aho-Corasick automaton of all
tokens gives the longest token that starts at a byte. Encoding walks forward from
longest tokens, taking a token only where BPE would leave it beside the one
before, and backs up to shorter tokens or to the token before otherwise; a byte
found not to be a border is never tried again.
Whether two tokens may stand side by side is worked out by undoing their merges
and remembered. The outcome equals merging pairs by rank, in time proportional to the
text for a given vocabulary.

A null text counts as empty and has no ids.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dayfold.llm.words import slices

# A rank file is sent to every executor; larger ones are refused.
RANK_FILE_BYTES = 64 << 20

# Remembered words (twice as many for a while) and pairs in one Python worker.
WORDS = 150_000
PAIRS = 1_000_000
WORD_LETTERS = 48

# Rows, and bytes of text if these are fewer, worked on at a time.
SLICE = 1_000
SLICE_BYTES = 1 << 20

# A space beside other white space.
WIDE_SPACE = re.compile(r" \s|\s ")


def read_ranks(rank_file: bytes) -> dict[bytes, int]:
    """Token to rank, from lines of a base64 token and its rank."""
    lines = (line.split() for line in rank_file.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


class ByteBpe:
    """One vocabulary and pattern, ready to encode and decode."""

    def __init__(self, rank_file: bytes, pattern: str, apart: bool = False) -> None:
        ranks = read_ranks(rank_file)
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the rank file must have a token for every byte")
        self.pattern = regex.compile(pattern)
        self.apart = apart
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.id_of = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}  # the pair a token was merged from
        self.merged: dict[tuple[int, int], int] = {}
        self.shorter: dict[int, int | None] = {}  # the longest token it begins with
        self.beside: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        self._learn_merges()
        self.beside.clear()  # answers while the merges were incomplete
        self.automaton.make_automaton()
        self.spaced = _Spaced(self)

    def _learn_merges(self) -> None:
        reached: dict[str, int] = {}
        for token, rank in sorted(self.id_of.items(), key=lambda item: item[1]):
            if len(token) > 1:
                for cut in range(1, len(token)):
                    pair = reached.get(token[:cut]), reached.get(token[cut:])
                    if None not in pair and self._undo(*pair):
                        break
                else:
                    continue  # no merges lead here: such a token is only a whole piece
                self.halves[rank] = pair
                self.merged[pair] = rank
            reached[token] = rank
            self.automaton.add_word(token, rank)
        for token, rank in reached.items():  # a longer token may have the lower rank
            begins = (reached.get(token[:cut]) for cut in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((t for t in begins if t is not None), None)

    def _undo(self, left: int, right: int) -> bool:
        """Whether merging leaves a border between ``left`` and ``right``.

        Their merges are undone, latest first. If the tokens then at the border
        make a pair that ranks before the merge last undone, the pair would have
        been merged, and there would be no border.
        """
        limit = None
        while True:
            across = self.merged.get((left, right))
            if across is not None and (limit is None or across < limit):
                return False
            from_left, from_right = self.halves.get(left), self.halves.get(right)
            if from_left is None and from_right is None:
                return True
            # Of equal merges the left one comes first, so the right one is undone first.
            if from_right is None or (from_left is not None and left > right):
                limit, left = left, from_left[1]
            else:
                limit, right = right + 1, from_right[0]

    def fits(self, left: int, right: int) -> bool:
        known = self.beside.get((left, right))
        if known is None:
            if len(self.beside) >= PAIRS:
                self.beside.clear()
            known = self.beside[left, right] = self._undo(left, right)
        return known

    def encode_piece(self, piece: str) -> list[int]:
        """The ids of one match of the pattern."""
        letters = piece.encode().decode("latin-1")
        whole = self.id_of.get(letters)
        if whole is not None:
            return [whole]
        size, length, shorter, beside = len(letters), self.length, self.shorter, self.beside
        starting, longest = self.automaton.iter_long, self.longest
        # The longest token at 0, at its end, and so on: where BPE mostly ends up.
        ahead = starting(letters)
        border = bytearray(b"\x01") * (size + 1)
        out: list[int] = []
        at, token = 0, next(ahead)[1]
        while True:
            end = at + length[token]
            if border[end]:
                fits = beside.get((out[-1], token)) if out else True
                if fits or fits is None and self.fits(out[-1], token):
                    out.append(token)
                    if end == size:
                        return out
                    if ahead is None:
                        token = next(starting(letters[end : end + longest]))[1]
                    else:
                        token = next(ahead)[1]
                    at = end
                    continue
            ahead = None  # off the path of longest tokens
            before = shorter[token]
            if before is not None:
                token = before
            else:  # nothing can start here: take the token before back, and shorten it
                border[at] = 0
                token = out.pop()
                at -= length[token]

    def encode_all(self, text: str) -> list[int]:
        """Match by match, with nothing remembered."""
        return list(chain.from_iterable(map(self.encode_piece, self.pattern.findall(text))))

    def encode(self, text: str) -> list[int]:
        """The ids of a text.

        With ``apart``, no match of the pattern runs over the border before a
        space between two other letters, so that a text without wider gaps may be
        cut there, and a word with its space be remembered.
        """
        if not self.apart or WIDE_SPACE.search(text):
            return self.encode_all(text)
        first, *rest = text.split(" ")
        ids = self.encode_all(first)
        ids.extend(chain.from_iterable(map(self.spaced.__getitem__, rest)))
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class _Spaced(dict):
    """Ids of words after a space. When full, what was not asked for since the
    last time is forgotten; long words are not kept."""

    def __init__(self, bpe: ByteBpe) -> None:
        super().__init__()
        self.bpe = bpe
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word)
        if ids is None:
            first, *rest = self.bpe.pattern.findall(" " + word) or [""]
            known = self.get(first[1:]) if rest and first[:1] == " " else None
            ids = tuple(known or self.bpe.encode_piece(first))
            for piece in rest:
                ids += tuple(self.bpe.encode_piece(piece))
        if len(word) <= WORD_LETTERS:
            if len(self) >= WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=2)
def bpe_of(rank_file: bytes, pattern: str, apart: bool) -> ByteBpe:
    """Built once in each Python worker."""
    return ByteBpe(rank_file, pattern, apart)


def _sent(docs: DataFrame, ranks: str):
    """The rank file, read on the driver and sent to the executors."""
    with open(ranks, "rb") as file:
        rank_file = file.read(RANK_FILE_BYTES + 1)
    if len(rank_file) > RANK_FILE_BYTES:
        raise ValueError(f"{ranks} has more than {RANK_FILE_BYTES} bytes")
    return docs.sparkSession.sparkContext.broadcast(rank_file)


def _appended(docs: DataFrame, work, text: str | None, **columns: T.DataType) -> DataFrame:
    """``docs`` with new columns, which ``work`` makes for a slice of rows."""
    docs = docs.drop(*columns)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(*c) for c in columns.items())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = (batch.slice(at, SLICE) for at in range(0, len(batch), SLICE))
            for part in chain.from_iterable(slices(r, text, SLICE_BYTES) if text else [r] for r in rows):
                names = [*part.schema.names, *columns]
                yield pa.RecordBatch.from_arrays([*part.columns, *work(part)], names=names)

    return docs.mapInArrow(mapped, schema)


def _lists(rows: list[list[int]]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    values = np.fromiter(chain.from_iterable(rows), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(offsets, pa.array(values))


def encode(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    text: str = "text",
    out: str = "ids",
    decoded: str | None = None,
    apart: bool = False,
) -> DataFrame:
    """``docs`` with the ids of each text in the array column ``out``, and, where
    ``decoded`` names a column, what they decode to there, as ``decode`` would.

    ``apart`` says that the pattern never matches over the border before a single
    space, as those that allow a space only first in a match; it saves time.

    Other columns pass through, and a column of a new one's name is replaced. A
    null or empty text has an empty array, and repeated rows stay repeated.
    """
    sent = _sent(docs, ranks)
    columns = {out: T.ArrayType(T.IntegerType())}
    columns |= {decoded: T.BinaryType()} if decoded else {}

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        bpe = bpe_of(sent.value, pattern, apart)
        ids = [bpe.encode(t) if t else [] for t in part.column(text).to_pylist()]
        more = [pa.array(map(bpe.decode, ids), pa.binary())] if decoded else []
        return [_lists(ids), *more]

    return _appended(docs, work, text, **columns)


def decode(
    encoded: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """``encoded`` with the bytes its ids stand for in the binary column ``out``.

    The bytes need not be UTF-8 when the ids were cut. Null ids give no bytes, an
    unknown id fails, and a column named ``out`` is replaced.
    """
    sent = _sent(encoded, ranks)

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        token = _tokens(sent.value).__getitem__
        rows = part.column(ids).to_pylist()
        return [pa.array([b"".join(map(token, row or ())) for row in rows], pa.binary())]

    return _appended(encoded, work, None, **{out: T.BinaryType()})


@lru_cache(maxsize=2)
def _tokens(rank_file: bytes) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(rank_file).items()}
