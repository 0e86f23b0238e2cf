"""Mixing sources to target weights by Poisson replication.

Each source has a mean number of repetitions that brings it to its target share.
A document's own number comes from inverting the Poisson distribution of that mean
at a point hashed from its id, so any run on any cluster draws the same. Documents
are unfolded into their copies, and the copies shuffled by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.llm.shared import settled
from dayfold.llm.spans import let

# A larger mean is drawn as a sum of equal ones, each no larger than this.
PART_MEAN = 16
# Terms of the distribution: with a mean of 16, what is beyond 96 is under 2^-100.
TERMS = 96

# Hexadecimal digits of the hash that a draw uses: 52 bits, which a double holds.
DRAW_DIGITS = 13

# Sources whose rates (some 800 bytes each) are sent to every task.
BROADCAST_SOURCES = 10_000


def document_size(text: Column) -> Column:
    """A document's weight in its source: its letters and one."""
    return F.coalesce(F.length(text), F.lit(0)) + 1


def tempered_weights(
    docs: DataFrame, power: float, source: str = "source", text: str = "text"
) -> DataFrame:
    """A weight for each source: its size to the ``power``; 1 keeps the mix, 0 evens it."""
    size = F.sum(document_size(F.col(text)))
    return docs.groupBy(F.col(source).alias("source")).agg(
        F.pow(size.cast("double"), F.lit(power)).alias("weight")
    )


def repetition_rates(
    docs: DataFrame, weights: DataFrame, source: str = "source", text: str = "text"
) -> DataFrame:
    """Each source's ``rate``: the mean repetitions that give it its share of ``weights``
    while the corpus keeps its size.

    Sizes are summed over all documents. A null source is a source like others. A
    source without a weight, or with one that is null or not above 0, has rate 0;
    of several weights the sum counts.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(document_size(F.col(text))).alias("size")
    )
    given = weights.groupBy(F.col("source").alias("_named")).agg(
        F.greatest(F.coalesce(F.sum("weight"), F.lit(0.0)).cast("double"), F.lit(0.0)).alias("weight")
    )
    both = sizes.join(given, F.col("source").eqNullSafe(F.col("_named")), "left").select(
        "source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight")
    )
    all_size, all_weight = (both.agg(F.sum(c)).scalar() for c in ("size", "weight"))
    share = F.when(all_weight > 0, F.col("weight") / all_weight).otherwise(0.0)
    return both.select("source", (share * all_size / F.col("size")).alias("rate"))


def _distribution(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of the Poisson distribution."""

    def term(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        whole = state["whole"] + p
        below = F.concat(state["below"], F.array(whole))
        return F.struct(p.alias("p"), whole.alias("whole"), below.alias("below"))

    none = F.exp(-mean)
    begin = F.struct(none.alias("p"), none.alias("whole"), F.array(none).alias("below"))
    steps = F.sequence(F.lit(1), F.lit(TERMS))
    return F.aggregate(steps, begin, term, lambda state: state["below"])


def _draw(id: Column, part: Column, seed: int) -> Column:
    """A number over 0 and under 1 from an id and the number of the part."""
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(id.cast("string"), F.lit("")), part)
    number = F.conv(F.substr(F.md5(name), F.lit(1), F.lit(DRAW_DIGITS)), 16, 10).cast("bigint")
    return (number + 0.5) / F.lit(float(16**DRAW_DIGITS))


def mix_sources(
    docs: DataFrame,
    weights: DataFrame,
    seed: int = 0,
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    copy: str = "copy",
) -> DataFrame:
    """The documents repeated to the target weights, in hashed order.

    All columns come back, with the number of the copy, from 1, in ``copy``; a
    column of that name is replaced. Documents drawn zero times are gone. Rows with
    the same id draw alike; a null id draws as an empty one. The order is by
    hash over partitions and within each.
    """
    docs = docs.drop(copy)
    rates = repetition_rates(docs, weights, source, text)
    parts = F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int")
    rates = settled(
        rates.select(F.col("source").alias("_mix_source"), "rate", parts.alias("_mix_parts"))
    )
    known = rates.count()
    plans = rates.select(
        "_mix_source",
        "_mix_parts",
        _distribution(F.col("rate") / F.col("_mix_parts")).alias("_mix_below"),
    )
    if known <= BROADCAST_SOURCES:
        plans = F.broadcast(plans)

    def drawn_in(part: Column) -> Column:
        return let(
            _draw(F.col(id), part, seed),
            lambda draw: F.size(F.filter("_mix_below", lambda below: below <= draw)),
        )

    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("_mix_parts")), F.lit(0), lambda n, part: n + drawn_in(part)
    )
    counted = docs.join(plans, F.col(source).eqNullSafe(F.col("_mix_source"))).select(
        *[F.col(c) for c in docs.columns], drawn.alias("_mix_n")
    )
    copies = counted.where(F.col("_mix_n") > 0).select(
        *docs.columns, F.explode(F.sequence(F.lit(1), F.col("_mix_n"))).alias(copy)
    )
    order = F.xxhash64(F.lit(seed), F.col(id), F.col(copy))
    return (
        copies.withColumn("_mix_order", order)
        .repartition("_mix_order")
        .sortWithinPartitions("_mix_order")
        .drop("_mix_order")
    )
