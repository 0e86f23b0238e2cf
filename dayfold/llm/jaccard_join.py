"""Near-duplicate sets by PartEnum signatures.

A document's set are its distinct word shingles, as hashes. Two sets of which the
shared part is at least ``percent`` of all differ in at most a known number k of
elements, which grows with their size; sizes are cut into bands so narrow that
similar sets lie in the same band or in neighbouring ones. For each band the domain
of shingles is dealt into (k + 1) / 2 partitions and each of these into three. In one
partition at least the sets differ in one element or none, so that they agree on two
of its three parts: a set's signatures are its projections on every two parts of
every partition. Similar sets share one; no other threshold or cap applies.

Few elements make a signature, now and then none, so sets that are not alike share some
as well. Every set therefore has a sketch too: for each of its places, whether an odd
number of elements fall there. Sketches differ in no more places than sets in elements.
Sets that share a signature and whose sketches are near enough are linked; what links
connect is a candidate group, and within it every set is compared with every other
exactly. Equal sets are one throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.blocks import MESSAGE, firsts, messages, unpack, unpack_values
from dayfold.llm.components import connected, star
from dayfold.llm.shared import block_count, counted, cut, settled
from dayfold.llm.words import GOLDEN, grams, inside, mix, slices, words_of

SHINGLE = 3
PERCENT = 90

PARTS_OF = 3  # second-level parts; a signature leaves one out

# Sets compared in one task. A larger candidate group is compared in pairs of blocks.
BLOCK_SETS = 1_024

# Postings gone through at a time in a task.
STRIDE = 4 << 20

# Places of the smallest sketch; larger ones have two for each element, as a power of two.
SKETCH_BITS = 256

SETS = "doc_id bigint, size bigint, digest_high bigint, digest_low bigint, sketch binary"


class Sets:
    """The distinct shingles of each text, sorted by text and hash."""

    def __init__(self, texts: pa.Array, words: int = SHINGLE) -> None:
        found = words_of(texts, lower=True)
        text = found.text
        n = len(found.counts)
        own = inside(text, words)
        parts = [(grams(found.hashes, words)[own], text[: len(own)][own])]
        for few in range(1, words):  # a text with fewer words is one shingle of them all
            short = np.flatnonzero(found.counts == few)
            parts.append((grams(found.hashes, few)[found.offsets[short]], short))
        hashes, texts_of = (np.concatenate(column) for column in zip(*parts))
        order = np.lexsort((hashes, texts_of))
        hashes, texts_of = hashes[order], texts_of[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (texts_of[1:] != texts_of[:-1])
        self.hashes, self.text = hashes[new], texts_of[new]
        self.sizes = np.bincount(self.text, minlength=n)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that tell a set, as two numbers: sums over its elements."""
        sums = []
        for salt in (GOLDEN, ~GOLDEN):
            total = np.zeros(len(self.sizes), np.uint64)
            np.add.at(total, self.text, mix(self.hashes ^ salt))
            sums.append(mix(total).view(np.int64))
        return sums[0], sums[1]

    def sketches(self) -> list[bytes]:
        """A bit for each place: whether an odd number of elements fall there."""
        bits = np.full(len(self.sizes), SKETCH_BITS, np.int64)
        while (short := bits < 2 * self.sizes).any():
            bits[short] *= 2
        ends = np.cumsum(bits)
        begins = ends - bits
        place = mix(self.hashes + GOLDEN) & (bits[self.text] - 1).astype(np.uint64)
        counts = np.bincount(begins[self.text] + place.astype(np.int64), minlength=bits.sum())
        packed = np.packbits((counts & 1).astype(np.uint8)).tobytes()
        return [packed[a // 8 : b // 8] for a, b in zip(begins.tolist(), ends.tolist())]


def folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch of the same set with so many bytes, which are fewer or as many."""
    parts = np.frombuffer(sketch, np.uint64).reshape(-1, size // 8)
    return np.bitwise_xor.reduce(parts, axis=0)


def near(
    sizes: np.ndarray, sketches: list[bytes], block: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets that may be similar by their sketches: all there are in one block,
    or those across two."""
    least = min(map(len, sketches))
    rows = np.stack([folded(sketch, least) for sketch in sketches])
    across = block != block[0]
    a, b = [], []
    for i in np.flatnonzero(~across) if across.any() else range(len(rows)):
        others = np.flatnonzero(across) if across.any() else np.arange(i + 1, len(rows))
        differ = np.bitwise_count(rows[others] ^ rows[i]).sum(axis=1, dtype=np.int64)
        may = differ * (100 + percent) <= (sizes[others] + sizes[i]) * (100 - percent)
        b.append(others[may])
        a.append(np.full(len(b[-1]), i))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(none + a), np.concatenate(none + b)


@cache
def bands(percent: int, most: int) -> np.ndarray:
    """The last size of each band, up to one that holds ``most`` and one more. From one
    band to the next a size grows by no more than similar sets may differ in it."""
    last = [0]
    while last[-1] < most or len(last) < 2 or last[-2] < most:
        last.append((last[-1] + 1) * 100 // percent)
    return np.array(last[1:])


def signatures(sets: Sets, among: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of the chosen texts' sets, and the text of each.

    A set has those of its band and of the next, where similar larger sets are.
    """
    lasts = bands(percent, max(1, int(sets.sizes.max(initial=1))))
    chosen = np.zeros(len(sets.sizes), bool)
    chosen[among] = True
    band = np.searchsorted(lasts, sets.sizes)
    element = chosen[sets.text]
    hashes, text = sets.hashes[element], sets.text[element]
    out, texts = [], []
    for step in (0, 1):
        tag = band + step
        differ = 2 * lasts[np.minimum(tag, len(lasts) - 1)] * (100 - percent) // (100 + percent)
        # Where sets may not differ at all they are equal, which digests tell.
        partitions = np.where(chosen & (differ > 0), (differ + 2) // 2, 0)
        begins = np.concatenate([[0], np.cumsum(partitions)])
        split = mix(hashes ^ mix(tag[text].astype(np.uint64) + GOLDEN))
        held = partitions[text] > 0
        here, where = split[held], text[held]
        first = (here >> np.uint64(32)) % partitions[where].astype(np.uint64)
        cell = (begins[where] + first.astype(np.int64)) * PARTS_OF
        cell += ((here & np.uint64(0xFFFFFFFF)) % np.uint64(PARTS_OF)).astype(np.int64)
        sums = np.zeros(int(begins[-1]) * PARTS_OF, np.uint64)
        np.add.at(sums, cell, mix(hashes[held]))
        sums = sums.reshape(-1, PARTS_OF)
        owner = np.repeat(np.arange(len(partitions)), partitions)
        number = np.arange(int(begins[-1])) - begins[owner]
        salt = (tag[owner].astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64)
        rest = sums.sum(axis=1, dtype=np.uint64)[:, None] - sums
        left_out = np.arange(1, PARTS_OF + 1, dtype=np.uint64)
        out.append(mix(rest + mix(salt[:, None] * np.uint64(8) + left_out)).ravel())
        texts.append(np.repeat(owner, PARTS_OF))
    return np.concatenate(out), np.concatenate(texts)


def set_table(docs: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """Each document's id, the size of its set, and the set's digest."""

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, "text") for b in batches):
            sets = Sets(batch.column("text"), words)
            high, low = sets.digests()
            sketches = pa.array(sets.sketches(), pa.binary())
            columns = [batch.column("doc_id"), *map(pa.array, (sets.sizes, high, low)), sketches]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SETS.split(", ")])

    return _texts(docs, id, text).mapInArrow(sized, SETS)


def _texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(id).cast("bigint").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")
    )


BUCKETS = "bucket bigint, digest_high bigint"


def shared_signatures(
    docs: DataFrame, parts: int, id: str, text: str, words: int, percent: int
) -> DataFrame:
    """The sets that share a signature, as ``bucket`` and the half of their digests.

    A batch of documents sends each signature once for each of its sets, so that copies
    are few entries. Signatures that the same sets share are one bucket. Another set with
    the same half of its digest is compared in vain.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, "text") for b in batches):
            sets = Sets(batch.column("text"), words)
            high, low = sets.digests()
            order = np.lexsort((low, high))
            new = np.ones(len(order), bool)
            new[1:] = (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
            one = order[new]
            keys, owner = signatures(sets, one[sets.sizes[one] > 0], percent)
            order = np.argsort(keys, kind="stable")
            yield from messages(0, parts, keys[order], high[owner[order]]).to_batches()

    def answer(table: pa.Table) -> pa.Table:
        key = np.concatenate([unpack(k.as_py()) for k in table["keys"]])
        digest = np.concatenate([unpack_values(v.as_py(), 1)[0] for v in table["values"]])
        order = np.lexsort((digest, key))
        key, digest = key[order], digest[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])
        key, digest = key[new], digest[new]
        begins = firsts(key)
        sizes = np.diff(np.append(begins, len(key)))
        held = np.add.reduceat(mix(digest.view(np.uint64) ^ GOLDEN), begins)
        several = np.flatnonzero(sizes > 1)
        bucket, first = np.unique(mix(held[several]), return_index=True)
        chosen = several[first]
        begins, sizes = begins[chosen], sizes[chosen]
        at = np.arange(sizes.sum()) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)
        return pa.table({"bucket": np.repeat(bucket.view(np.int64), sizes), "digest_high": digest[at]})

    texts = _texts(docs, id, text).where("doc_id IS NOT NULL")
    sent = texts.mapInArrow(ask, MESSAGE)
    return sent.groupBy("part").applyInArrow(answer, BUCKETS).distinct()


def near_links(buckets: DataFrame, classes: DataFrame, parts: int, percent: int) -> DataFrame:
    """Links (a, b) that connect all classes which share a signature and have sketches
    near enough. A large bucket is compared in pairs of blocks, tasks of their own."""
    large = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("sets"))
    large = large.where(F.col("sets") > BLOCK_SETS)
    blocks = F.ceil(F.coalesce("sets", F.lit(1)) / BLOCK_SETS).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    one, two = F.least("block", "other"), F.greatest("block", "other")
    sketched = (
        buckets.join(counted(large), "bucket", "left")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("digest_high"), F.col("blocks")).cast("int"))
        .select("bucket", "digest_high", "block", other)
        .select("digest_high", "block", F.xxhash64("bucket", one, two).alias("group"))
        .join(classes.select("digest_high", "class_id", "size", "sketch"), "digest_high")
        .withColumn("task", F.pmod("group", F.lit(parts)))
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("group", "ascending"), ("block", "ascending")])
        group, ids = table["group"].to_numpy(), table["class_id"].to_numpy()
        sizes, block = table["size"].to_numpy(), table["block"].to_numpy()
        sketches = table["sketch"].to_pylist()
        begins = firsts(group).tolist()
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in zip(begins, [*begins[1:], len(group)]):
            one, two = near(sizes[i:j], sketches[i:j], block[i:j], percent)
            a.append(ids[i:j][one])
            b.append(ids[i:j][two])
            if len(a[-1]) > j - i:
                a[-1], b[-1] = star(a[-1], b[-1])
        a, b = star(np.concatenate(a), np.concatenate(b))
        return pa.table({"a": a, "b": b})

    return sketched.groupBy("task").applyInArrow(compare, "a bigint, b bigint")


def _compared(words: int, percent: int):
    """Compare the sets of one task: all of one block, or those of two with each other."""

    def compare(table: pa.Table) -> pa.Table:
        one = table["one"][0].as_py()
        sets = Sets(table["text"], words)
        # A repeated id may have come with another text than the one meant.
        high, low = sets.digests()
        meant = (high == table["digest_high"].to_numpy()) & (low == table["digest_low"].to_numpy())
        rows = np.flatnonzero(meant)
        ids = table["class_id"].to_numpy()
        _, first = np.unique(ids[rows], return_index=True)
        rows = rows[first]
        ids, copies = ids[rows], table["copies"].to_numpy()[rows]
        block = table["block"].to_numpy()[rows]
        across = bool((block != one).any())
        hashes = np.concatenate([sets.hashes[sets.offsets[r] : sets.offsets[r + 1]] for r in rows])
        sizes = sets.sizes[rows]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.repeat(np.arange(len(rows)), sizes)
        # Postings: the sets that have an element, side by side.
        order = np.argsort(hashes, kind="stable")
        begins = firsts(hashes[order])
        ends = np.append(begins[1:], len(hashes))
        element = np.empty(len(hashes), np.int64)
        element[order] = np.repeat(np.arange(len(begins)), ends - begins)
        posted = owner[order]
        links = np.zeros(len(rows), np.int64)
        a, b = [], []
        for i in range(len(rows)):
            if across and block[i] != one:
                continue
            common = np.zeros(len(rows), np.int64)
            mine = element[bounds[i] : bounds[i + 1]]
            long = ends[mine] - begins[mine]
            cuts = np.flatnonzero(np.diff(np.cumsum(long) // STRIDE)) + 1
            for chunk in np.split(np.arange(len(mine)), cuts):
                size, start = long[chunk], begins[mine[chunk]]
                at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
                common += np.bincount(posted[at], minlength=len(rows))
            similar = 100 * common >= percent * (sizes[i] + sizes - common)
            similar[i] = False
            if across:
                similar &= block != one
                links[similar] += copies[i]
            links[i] += copies[similar].sum()
            other = np.flatnonzero(similar)
            a.append(ids[other])
            b.append(np.full(len(other), ids[i]))
        a, b = star(np.concatenate(a), np.concatenate(b))
        linked = np.flatnonzero(links)
        return pa.table(
            {
                "class_id": pa.array([*ids[linked], *a], pa.int64()),
                "root": pa.array([*[None] * len(linked), *b], pa.int64()),
                "links": pa.array([*links[linked], *[0] * len(a)], pa.int64()),
            }
        )

    return compare


def jaccard_join(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, the least id
    that links lead to, and ``n_links``, the documents it is linked with.

    A set are the distinct shingles of so many words, A-Z as a-z; of fewer words, all
    in one. Documents link when the shared part of their sets is at least ``percent``
    of both together. Null texts and texts without words have no shingles and no
    links. A document without an id is linked with nothing and has no component.
    Rows with equal ids are documents of their own under one id. Other columns are
    not read.
    """
    parts = block_count(docs, text)
    sets = settled(set_table(docs, id, text, words))
    digest = ["digest_high", "digest_low"]
    some = sets.where(F.col("doc_id").isNotNull() & (F.col("size") > 0))
    head = F.min(F.struct("doc_id", "size", "sketch")).alias("head")
    classes = settled(
        some.groupBy(*digest)
        .agg(head, F.count(F.lit(1)).alias("copies"))
        .select(*digest, F.col("head.doc_id").alias("class_id"), "head.size", "head.sketch", "copies")
    )
    buckets = settled(shared_signatures(docs, parts, id, text, words, percent))
    links = near_links(buckets, classes, parts, percent)
    groups = connected(links)
    groups = cut(
        groups.unionAll(groups.select(F.col("root").alias("node"), "root").distinct())
    )
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("sets"))
    blocks = F.ceil(F.col("sets") / BLOCK_SETS).cast("int")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    # Every pair of a group's blocks is a task, and a set goes where its block is.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = (
        groups.join(sizes.select("root", blocks.alias("blocks")), "root")
        .withColumn("block", block)
        .select("node", "root", "block", other)
        .join(classes.select(F.col("class_id").alias("node"), "copies", *digest), "node")
        .select(
            F.col("node").alias("class_id"),
            "root",
            "block",
            F.least("block", "other").alias("one"),
            F.greatest("block", "other").alias("two"),
            "copies",
            *digest,
        )
    )
    compared = cut(
        _texts(docs, id, text)
        .join(counted(tasks), F.col("doc_id") == F.col("class_id"))
        .drop("doc_id")
        .groupBy("root", "one", "two")
        .applyInArrow(_compared(words, percent), "class_id bigint, root bigint, links bigint")
    )
    counts = compared.groupBy("class_id").agg(F.sum("links").alias("links"))
    roots = connected(
        compared.where("root IS NOT NULL").select(F.col("class_id").alias("a"), F.col("root").alias("b"))
    )
    found = (
        classes.drop("size", "sketch")
        .join(counts, "class_id", "left")
        .join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select(
            *digest,
            F.coalesce("root", "class_id").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    in_play = F.col("doc_id").isNotNull() & (F.col("size") > 0)
    return sets.join(found, digest, "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(in_play, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(in_play, F.col("n_links")).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
    )
