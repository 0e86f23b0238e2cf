"""Sharding by balanced label propagation: linked documents gather in one shard,
and shards differ by one document at most.

Documents are linked when they share a group key. Those that do start on hashed
shards, and in each round move towards the shard where most of their group is. A
quota for each pair of shards, made of what wants to move the other way and of the
room that is left, keeps every shard within its size. Documents without links
fill what remains, which makes the sizes exact.

Documents of a group on the same shard are alike, so rounds work on their counts:
a group is a few rows however many copies it has. Only built-in DataFrame
functions run. After ``ROUNDS`` rounds documents stay where they are, though some may
still want to move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold.llm.shared import cut

ROUNDS = 8

# Quotas are met by admitting whole buckets of groups; so many for a pair of shards.
BUCKETS = 1024

# A group over this part of a shard is moved in pieces of that size.
PIECES = 64

# Large groups go where more than this part of a shard is free.
ROOMY = 16

# Documents ranked together in one task.
RANKED_ROWS = 5_000


def _room(number: int, shards: int, shard: Column) -> Column:
    """The documents a shard gets: the first shards take one of the remainder each."""
    return F.lit(number // shards) + (shard < number % shards).cast("bigint")


def _ranked(rows: DataFrame, name: str, by: list[str], order: list[str], count: int) -> DataFrame:
    """``rows`` with their place, from 0, within the columns ``by``.

    Rows are ranked in buckets of hashed order, and a bucket begins where those
    before it end. Buckets grow in number with the rows, so that no task ranks more
    than some ``RANKED_ROWS``.
    """
    buckets = max(1, count // RANKED_ROWS)
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = rows.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = (
        Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    begins = sizes.select(
        *by, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_begin")
    )
    within = Window.partitionBy(*by, "_bucket").orderBy(*order)
    place = F.col("_begin") + F.row_number().over(within) - 1
    begins = begins.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_bucket").alias("_b"), "_begin")
    same = F.col("_bucket") == F.col("_b")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(begins, same).withColumn(name, place)


def _propagate(units: DataFrame, shards: int, number: int, rounds: int) -> DataFrame:
    """Move units (group, piece, home, shard, n), by rounds, until none wants to."""
    room = _room(number, shards, F.col("shard"))
    large = max(1, number // shards // PIECES)
    roomy = number // shards // ROOMY
    for _ in range(rounds):
        load = units.groupBy("shard").agg(F.sum("n").alias("load"))
        all_shards = units.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
        free = all_shards.join(load, "shard", "left").select(
            "shard", (room - F.coalesce("load", F.lit(0))).alias("free")
        )
        here = units.groupBy("group", "shard").agg(F.sum("n").alias("neighbours"))
        # Small groups change places pair by pair; one larger than a piece needs room,
        # and a shard about full has none.
        sizes = here.groupBy("group").agg(F.sum("neighbours").alias("size"))
        open_to = here.join(sizes, "group").join(F.broadcast(free), "shard")
        open_to = open_to.select(
            "group",
            F.struct("neighbours", F.xxhash64("group", "shard").alias("tie"), "shard").alias("pull"),
            ((F.col("size") <= large) | (F.col("free") > roomy)).alias("open"),
        )
        pulls = open_to.groupBy("group").agg(
            F.max(F.when(F.col("open"), F.col("pull"))).alias("best"),
            F.collect_list("pull").alias("pulls"),  # one for each shard at most
        )
        own = F.filter("pulls", lambda p: p["shard"] == F.col("shard"))[0]
        target = F.when(F.col("best") > own, F.col("best.shard")).otherwise(F.col("shard"))
        aims = units.join(pulls, "group").select(*units.columns, target.alias("target"))
        bucket = F.pmod(F.xxhash64("group", "piece"), F.lit(BUCKETS))
        moves = aims.where(F.col("target") != F.col("shard")).select(
            "group", "piece", "home", "n", "target", F.col("shard").alias("from"),
            bucket.alias("bucket"),
        )
        flows = moves.groupBy("from", "target", "bucket").agg(F.sum("n").alias("wish"))
        wishes = flows.groupBy("from", "target").agg(F.sum("wish").alias("wish"))
        back = wishes.select(
            F.col("from").alias("target"), F.col("target").alias("from"), F.col("wish").alias("back")
        )
        into = wishes.groupBy("target").agg(F.sum("wish").alias("into"))
        gains = F.greatest(F.col("free"), F.lit(0)) * F.col("wish") / F.col("into")
        quotas = (
            wishes.join(back, ["from", "target"], "left")
            .join(into, "target")
            .join(free.withColumnRenamed("shard", "target"), "target")
            .select(
                "from",
                "target",
                (F.least("wish", F.coalesce("back", F.lit(0))) + F.floor(gains)).alias("quota"),
            )
        )
        up_to = Window.partitionBy("from", "target").orderBy("bucket")
        admitted = (
            flows.withColumn("sum", F.sum("wish").over(up_to))
            .join(quotas, ["from", "target"])
            .where(F.col("sum") <= F.col("quota"))
            .select("from", "target", "bucket", F.lit(True).alias("admitted"))
        )
        moved = moves.join(admitted, ["from", "target", "bucket"]).select(
            "group", "piece", "home", "from", "target"
        )
        keys = ["group", "piece", "home"]
        moved = moved.withColumnRenamed("from", "shard")
        units = cut(
            units.join(moved, [*keys, "shard"], "left").select(
                *keys,
                F.coalesce("target", "shard").alias("shard"),
                "n",
                F.col("target").isNotNull().alias("moved"),
            )
        )
        any_moved = units.where("moved").limit(1).count()
        units = units.drop("moved")
        if not any_moved:
            break
    return units


def shard_rows(
    docs: DataFrame,
    group: Column,
    shards: int = 8,
    rounds: int = ROUNDS,
    id: str = "doc_id",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``doc_id``, the columns ``carry``, ``shard`` and ``slot``,
    its place there from 0.

    Shards differ by one document at most. Documents whose ``group`` is equal are
    linked; null groups are not. A group larger than a shard takes as few shards as
    are free. Repeated rows are documents of their own, a null id is an id like
    others, and an empty table gives an empty result. Other columns are not read.
    """
    carried = F.struct(*[F.col(c) for c in carry], F.lit(0).alias("_")).alias("carry")
    rows = docs.select(F.col(id).alias("doc_id"), group.alias("group"), carried)
    rows = rows.groupBy("doc_id", "group", "carry").agg(F.count(F.lit(1)).alias("copies"))
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")
    key = ["doc_id", "group", "carry", "copy"]
    rows = cut(rows.select("doc_id", "group", "carry", copy))
    number = rows.count()
    large = max(1, number // shards // PIECES)
    sizes = rows.where(F.col("group").isNotNull()).groupBy("group").agg(
        F.count(F.lit(1)).alias("size")
    )
    sizes = sizes.where(F.col("size") > 1)
    everyone = rows.join(sizes, "group", "left").select(
        *key,
        F.pmod(
            F.xxhash64("doc_id", "copy", F.lit(1)), F.ceil(F.col("size") / large)
        ).alias("piece"),
        F.pmod(F.xxhash64("doc_id", "copy"), F.lit(shards)).cast("int").alias("home"),
    )
    # Groups, not documents, and only those with links, which have a piece.
    units = (
        everyone.where(F.col("piece").isNotNull())
        .groupBy("group", "piece", "home")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("shard", F.col("home"))
    )
    units = _propagate(cut(units), shards, number, rounds)
    places = units.select("group", "piece", "home", "shard")
    placed = everyone.join(places, ["group", "piece", "home"], "left").select(*key, "shard")
    # Documents without a shard are ranked too, among themselves.
    placed = _ranked(placed, "slot", ["shard"], ["doc_id", "copy"], number)
    placed = cut(placed.select(*key, "shard", "slot"))
    fits = F.col("shard").isNotNull() & (F.col("slot") < _room(number, shards, F.col("shard")))
    loads = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("load")).collect()
    load = {r["shard"]: r["load"] for r in loads}
    taken = [
        min(load.get(s, 0), number // shards + (s < number % shards)) for s in range(shards)
    ]
    # What fits nowhere yet: first those without a shard, then each shard's surplus.
    begin, alone = load.get(None, 0), F.col("slot")
    for s in range(shards):
        alone = F.when(F.col("shard") == s, F.col("slot") - taken[s] + begin).otherwise(alone)
        begin += load.get(s, 0) - taken[s]
    shard, slot = _filled(alone, taken, number)
    return placed.select(
        "doc_id",
        *[F.col(f"carry.`{c}`").alias(c) for c in carry],
        F.when(fits, F.col("shard")).otherwise(shard).alias("shard"),
        F.when(fits, F.col("slot")).otherwise(slot).alias("slot"),
    )


def _filled(place: Column, taken: list[int], number: int) -> tuple[Column, Column]:
    """The shard and slot of each place among the documents that fill up the shards,
    from the number each shard has already."""
    shards, begin = len(taken), 0
    shard, slot = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for s, has in enumerate(taken):
        room = number // shards + (s < number % shards) - has
        here = (place >= begin) & (place < begin + room)
        shard = F.when(here, F.lit(s)).otherwise(shard)
        slot = F.when(here, place - begin + has).otherwise(slot)
        begin += room
    return shard, slot
