"""Places of a pattern's matches in texts, with built-in SQL functions alone.

Matches and the gaps between them come from the same search, so their lengths add up
to the places of the matches, in code points, end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Numbers added up in one fold. A fold copies what it has so far at every step, so
# long arrays are summed in chunks, and the chunks' sums in turn.
CHUNK = 64


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once. A column that a lambda refers to from
    outside may be computed again for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sums(start: Column, values: Column) -> Column:
    """``start`` and the running sums on top of it."""
    return F.aggregate(
        values, F.array(start), lambda done, v: F.concat(done, F.array(F.element_at(done, -1) + v))
    )


def running(values: Column) -> Column:
    """The running sums of an array of integers; null for an empty one."""

    def chunked(values: Column) -> Column:
        def chunk(k: Column) -> Column:
            places = F.sequence(k * CHUNK, F.least((k + 1) * CHUNK, F.size(values)) - 1)
            return F.transform(places, lambda i: F.get(values, i))

        numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int"))
        return F.transform(numbers, chunk)

    def summed(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, b: a + b))
        starts = F.slice(_sums(F.lit(0), totals), F.lit(1), F.size(chunks))
        sums = F.zip_with(chunks, starts, lambda c, s: F.slice(_sums(s, c), F.lit(2), F.size(c)))
        return F.flatten(sums)

    return F.when(F.size(values) > 0, let(let(values, chunked), summed))


def with_matches(
    df: DataFrame, text: str, patterns: Mapping[str, str], wanted: Mapping[str, Column]
) -> DataFrame:
    """Adds for each pattern ``_name``, its matches as (match, before, after, end), with
    the text since the match before and until the next; none where the pattern is not
    ``wanted``."""
    whole = F.col(text)
    none = F.lit([]).cast("array<string>")
    out = df.withColumns(
        {
            f"_{name}_matches": F.when(
                wanted[name], F.regexp_extract_all(whole, F.lit(pattern), F.lit(0))
            ).otherwise(none)
            for name, pattern in patterns.items()
        }
    )
    out = out.withColumns(
        {
            f"_{name}_gaps": F.when(F.size(f"_{name}_matches") > 0, F.split(whole, pattern, -1))
            for name, pattern in patterns.items()
        }
    )

    def around(name: str) -> Column:
        def each(matches: Column, gaps: Column) -> Column:
            steps = F.zip_with(matches, gaps, lambda m, g: F.length(m) + F.length(g))
            ends = running(F.slice(steps, F.lit(1), F.size(matches)))
            placed = F.zip_with(
                matches, ends, lambda m, e: F.struct(m.alias("match"), e.alias("end"))
            )
            after = F.slice(gaps, F.lit(2), F.size(matches))
            beside = F.zip_with(gaps, after, lambda b, a: F.struct(b.alias("before"), a.alias("after")))
            return F.zip_with(
                placed,
                F.slice(beside, F.lit(1), F.size(matches)),
                lambda p, b: F.struct(p["match"], b["before"], b["after"], p["end"]),
            )

        matches, gaps = F.col(f"_{name}_matches"), F.col(f"_{name}_gaps")
        return F.when(
            F.size(matches) > 0, let(matches, lambda m: let(gaps, lambda g: each(m, g)))
        )

    return out.withColumns({f"_{name}": around(name) for name in patterns})
