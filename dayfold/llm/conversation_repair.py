"""Conversations made to alternate, by the cheapest edits.

Rows of a conversation are kept, given another role, deleted, or joined by empty rows,
until their roles' initials read ``(s?(ua)+)?``: nothing, or user and assistant by
turns, perhaps after a system row. What has been read of such a sequence is one of four
states, so the least cost of all that follows a row is a vector of four numbers. These
vectors are computed from the end and kept at checkpoints only, as far apart as the
square root of the number of rows; walking forward, the rows between two checkpoints
are gone through once more, and the cheapest edits written down, the least in ASCII
where several are.

A long conversation is cut at checkpoints into segments that are tasks of their own.
What a segment does to a vector is a table of four by four costs, and once the vectors
at its ends are known, what it does to a state is a table of four states; only these are
gathered by conversation. Rows that repeat exactly are one row with a number of copies.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from dayfold.llm.shared import counted, cut, settled

REROLE = 3
DELETE = 4
INSERT = 3
TRUNCATED = 3

# Rows of a conversation that stay in one segment. Longer ones have segments of this
# many rows, or of the square root of their number where that is more.
SEGMENT = 4_096

# Rows of ``kind`` 0 must be deleted; others are 1 + twice the place of their initial
# here, and one more if they are truncated. The last place is that of other initials.
INITIALS = "sua"

# After nothing, a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
INFINITE = 1 << 60

# The state that a kept row leads to, by state and initial.
KEPT = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
# The state that a row inserted, or given another role, leads to; it has no choice.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}

Vector = Sequence[int]


def _choices(kind: int) -> list[list[tuple[str, int, int]]]:
    """For each state the edits of a row, in ASCII order, their costs and next states."""
    if kind == 0:
        return [[("D", DELETE, state)] for state in STATES]
    initial = (*INITIALS, "")[(kind - 1) // 2]
    more = TRUNCATED * ((kind - 1) % 2)
    out = []
    for state in STATES:
        edits = [("D", DELETE, state)]
        if (state, initial) in KEPT:
            edits.append(("K", more, KEPT[state, initial]))
        out.append([*edits, ("R", more + REROLE, NEXT[state])])
    return out


CHOICES = [_choices(kind) for kind in range(2 * (len(INITIALS) + 1) + 1)]


def with_inserts(costs: Vector) -> list[int]:
    """What states cost if rows may be inserted first; two at most are of use."""
    once = [INSERT + costs[NEXT[state]] for state in STATES]
    return [min(costs[s], once[s], INSERT + once[NEXT[s]]) for s in STATES]


# The least costs at the end of a conversation.
END = with_inserts([0, INFINITE, INFINITE, 0])


def before(kind: int, copies: int, after: Vector) -> list[int]:
    """The least costs before a row, by those after it. Copies are deleted."""
    more = DELETE * (copies - 1)
    return with_inserts(
        [min(cost + after[to] for _, cost, to in edits) + more for edits in CHOICES[kind]]
    )


def walk(
    kinds: Sequence[int], copies: Sequence[int], end: Vector, state: int, last: bool
) -> tuple[list[tuple[int, str, int]], int]:
    """The cheapest edits of rows as (row, edit, state after it) and the last state, by
    the costs that follow them; after the last row of all, more may be inserted.

    Costs are kept at checkpoints, and those between them computed again.
    """
    n = len(kinds)
    step = math.isqrt(n) + 1
    checkpoints = {n: list(end)}
    costs = checkpoints[n]
    for i in range(n - 1, -1, -1):
        costs = before(kinds[i], copies[i], costs)
        if i % step == 0:
            checkpoints[i] = costs
    edits = []
    for begin in range(0, n, step):
        to = min(begin + step, n)
        block = [checkpoints[to]]
        for i in range(to - 1, begin - 1, -1):
            block.append(before(kinds[i], copies[i], block[-1]))
        block.reverse()
        for i in range(begin, to):
            here, after = block[i - begin], block[i - begin + 1]
            while True:
                rest = here[state] - DELETE * (copies[i] - 1)
                fits = [c for c in CHOICES[kinds[i]][state] if c[1] + after[c[2]] == rest]
                insert = INSERT + here[NEXT[state]] == here[state]
                if fits and not (insert and fits[0][0] > "I"):
                    break
                state = NEXT[state]
                edits.append((i, "I", state))
            edit, _, state = fits[0]
            edits.append((i, edit, state))
    while last and state not in (START, ASSISTANT):
        state = NEXT[state]
        edits.append((n, "I", state))
    return edits, state


def whole_groups(
    batches: Iterable[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[tuple[pa.Table, list[int]]]:
    """Rows sorted by key as tables of whole groups, with the bounds of these."""

    def bounds_of(table: pa.Table) -> list[int]:
        new = np.zeros(len(table), bool)
        new[:1] = True
        for key in keys:
            column = table[key]
            known = column.is_valid().to_numpy()
            value = column.fill_null(0).to_numpy()
            new[1:] |= (value[1:] != value[:-1]) | (known[1:] != known[:-1])
        return [*np.flatnonzero(new).tolist(), len(table)]

    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if not len(table):
            continue
        bounds = bounds_of(table)
        rest = table.slice(bounds[-2])
        if len(bounds) > 2:
            yield table.slice(0, bounds[-2]), bounds[:-1]
    if rest is not None and len(rest):
        yield rest, [0, len(rest)]


def spoken(column: str) -> Column:
    return F.coalesce(column, F.lit(" "))


def faulty_rows(rows: DataFrame, id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text``, ``copies`` of each row, ``initial``, its
    first fault as ``blank``, ``later``, an earlier row's copy, or ``truncated``, and
    ``kind``."""
    plain = rows.select(
        F.col(id).cast("bigint").alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        spoken(role).alias("role"),
        spoken(text).alias("text"),
    )
    digest = F.unhex(F.sha2("text", 256))
    # The first turn of what stands on several.
    several = (
        plain.groupBy("conv", "role", digest.alias("digest"))
        .agg(
            F.min("turn").alias("least"),
            F.max("turn").alias("most"),
            (F.count(F.lit(1)) - F.count("turn")).alias("unplaced"),
        )
        .where("least < most OR (unplaced > 0 AND least IS NOT NULL)")
        .select(
            F.col("conv").alias("of_conv"),
            F.col("role").alias("of_role"),
            "digest",
            F.when(F.col("unplaced") == 0, F.col("least")).alias("first"),
        )
    )
    same = (
        F.col("conv").eqNullSafe(F.col("of_conv"))
        & (F.col("role") == F.col("of_role"))
        & (digest == F.col("digest"))
    )
    left = F.regexp_replace("text", r"(?<![\x20\x09-\x0D])[\x20\x09-\x0D]++\z", "")
    runs = plain.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    place = F.lit(len(INITIALS))
    for i, letter in enumerate(INITIALS):
        place = F.when(F.col("initial") == letter, i).otherwise(place)
    blank, cut_off = F.col("left") == "", ~F.right("left", F.lit(1)).isin(".", "!", "?")
    later = F.col("digest").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    out = runs.join(counted(several), same, "left").withColumn("left", left)
    out = out.select("conv", "turn", "role", "text", "copies",
        F.left("role", F.lit(1)).alias("initial"),
        blank.alias("blank"),
        (later & ~blank).alias("later"),
        (cut_off & ~later & ~blank).alias("truncated"),
    )
    kind = 1 + 2 * place + F.col("truncated").cast("int")
    return out.withColumn("kind", F.when(F.col("blank") | F.col("later"), 0).otherwise(kind))


def in_segments(faulty: DataFrame, segment_rows: int = SEGMENT) -> DataFrame:
    """The rows with ``row``, which rises in a conversation's order, by turn, then role
    and text, unplaced rows first, and their ``segment`` and the number of ``segments``.

    Rows are sorted by range, so a conversation may lie in many tasks. How many of its
    rows lie before a task's is known from the counts of conversations in tasks.
    """
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "text")]
    placed = settled(
        faulty.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("row"))
    )
    counts = placed.groupBy("conv", "task").agg(
        F.min("row").alias("first"), F.count(F.lit(1)).alias("rows")
    )
    long = counts.groupBy("conv").agg(F.sum("rows").alias("all")).where(F.col("all") > segment_rows)
    long = counted(long.withColumnRenamed("conv", "of"))
    tasks_before = Window.partitionBy("conv").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    length = F.greatest(F.lit(segment_rows), F.ceil(F.sqrt("all")))
    offsets = counts.join(long, F.col("conv").eqNullSafe(F.col("of"))).select(
        F.col("conv").alias("of"),
        F.col("task").alias("of_task"),
        (F.coalesce(F.sum("rows").over(tasks_before), F.lit(0)) - F.col("first")).alias("offset"),
        length.alias("length"),
        F.ceil(F.col("all") / length).cast("int").alias("parts"),
    )
    here = F.col("conv").eqNullSafe(F.col("of")) & (F.col("task") == F.col("of_task"))
    segment = F.floor((F.col("row") + F.col("offset")) / F.col("length")).cast("int")
    return placed.join(counted(offsets), here, "left").select(
        *[c for c in placed.columns if c != "task"],
        F.coalesce(segment, F.lit(0)).alias("segment"),
        F.coalesce("parts", F.lit(1)).alias("segments"),
    )


def _sorted(rows: DataFrame, *order: str) -> DataFrame:
    """Whole groups in a task, in order: rows go by all of ``order`` but the last."""
    return rows.repartition(*order[:-1]).sortWithinPartitions(*order)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _by_segment(columns: Sequence[str], of: Callable[[list[int], list[int], dict], dict], ddl: str):
    """A row for each segment, from its rows' kinds and copies, and from ``columns``."""
    schema = arrow_schema(ddl)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ("conv", "segment")):
            kinds, copies = table["kind"].to_pylist(), table["copies"].to_pylist()
            first = table.select(columns).take(pa.array(bounds[:-1])).to_pylist()
            out = [
                of(kinds[a:b], copies[a:b], key) for a, b, key in zip(bounds, bounds[1:], first)
            ]
            yield pa.RecordBatch.from_pylist(out, schema)

    return each


def segment_ends(rows: DataFrame) -> DataFrame:
    """``conv``, ``segment``, ``state`` before each segment of the conversations that
    have several, and ``costs`` after it."""
    keys = ["conv", "segment"]
    narrow = settled(rows.where("segments > 1").select(*keys, "row", "kind", "copies"))

    def table_of(kinds: list[int], copies: list[int], key: dict) -> dict:
        columns = []
        for end in STATES:
            costs: Vector = [0 if s == end else INFINITE for s in STATES]
            for kind, n in zip(reversed(kinds), reversed(copies)):
                costs = before(kind, n, costs)
            columns.append([min(c, INFINITE) for c in costs])
        return key | {"costs": [columns[end][s] for s in STATES for end in STATES]}

    schema = "conv bigint, segment int, costs array<bigint>"
    costs = _sorted(narrow, *keys, "row").mapInArrow(_by_segment(keys, table_of, schema), schema)

    def backward(table: pa.Table) -> pa.Table:
        table = table.sort_by([("segment", "descending")])
        costs, out = list(END), []
        for own in table["costs"].to_pylist():
            out.append(costs)
            costs = [min(own[4 * s + e] + costs[e] for e in STATES) for s in STATES]
        return table.set_column(2, "costs", pa.array(out, pa.list_(pa.int64())))

    ends = cut(costs.groupBy("conv").applyInArrow(backward, schema))
    of = ends.withColumnsRenamed({"conv": "of", "segment": "of_segment"})
    here = F.col("conv").eqNullSafe(F.col("of")) & (F.col("segment") == F.col("of_segment"))
    known = narrow.join(of, here).select(*keys, "row", "kind", "copies", "costs")

    def moves_of(kinds: list[int], copies: list[int], key: dict) -> dict:
        return key | {"moves": [walk(kinds, copies, key["costs"], s, False)[1] for s in STATES]}

    moves_schema = schema + ", moves array<bigint>"
    moves = _sorted(known, *keys, "row").mapInArrow(
        _by_segment([*keys, "costs"], moves_of, moves_schema), moves_schema
    )

    def forward(table: pa.Table) -> pa.Table:
        table = table.sort_by("segment")
        state, out = START, []
        for own in table["moves"].to_pylist():
            out.append(state)
            state = own[state]
        return table.set_column(3, "state", pa.array(out, pa.int32()))

    return cut(moves.groupBy("conv").applyInArrow(forward, schema + ", state int"))


EDITS = (
    "conv bigint, segment int, step int, edit string, times bigint, cost bigint, "
    "role string, text string"
)


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest edits of all conversations, in order of ``segment`` and ``step``:
    ``edit``, by its initial, how many ``times``, at what ``cost``, and the ``role`` and
    ``text`` that then stand there; those of deleted rows are null.

    ``rows`` are those of ``in_segments``.
    """
    long = rows.where("segments > 1")
    ends = segment_ends(rows) if not long.isEmpty() else None
    if ends is None:
        known = rows.withColumns(
            {"state": F.lit(START), "costs": F.array(*[F.lit(c) for c in END]).cast("array<bigint>")}
        )
    else:
        of = counted(ends.withColumnsRenamed({"conv": "of", "segment": "of_segment"}))
        here = F.col("conv").eqNullSafe(F.col("of")) & (F.col("segment") == F.col("of_segment"))
        at_end = F.array(*[F.lit(c) for c in END]).cast("array<bigint>")
        known = rows.join(of, here, "left").withColumns(
            {"state": F.coalesce("state", F.lit(START)), "costs": F.coalesce("costs", at_end)}
        )
    known = known.select(
        "conv", "segment", "row", "segments", "kind", "copies", "state", "costs", "role", "text"
    )

    schema = arrow_schema(EDITS)

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ("conv", "segment")):
            data = table.drop_columns(["row", "costs"]).to_pydict()
            out: list[tuple] = []
            for a, b in zip(bounds, bounds[1:]):
                own = slice(a, b)
                kinds, copies = data["kind"][own], data["copies"][own]
                key = data["conv"][a], data["segment"][a]
                last = data["segment"][a] == data["segments"][a] - 1
                costs = table["costs"][a].as_py()
                steps, _ = walk(kinds, copies, costs, data["state"][a], last)
                group: list[tuple] = []
                for i, edit, state in steps:
                    role = text = None
                    cost = {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[edit]
                    if edit == "I":
                        role, text = ROLE[state], ""
                    elif edit != "D":
                        role, text = data["role"][a + i], data["text"][a + i]
                        role = ROLE[state] if edit == "R" else role
                        cost += TRUNCATED * ((kinds[i] - 1) % 2)
                    group.append((edit, 1, cost, role, text))
                    more = copies[i] - 1 if edit != "I" else 0
                    if more:
                        group.append(("D", more, DELETE * more, None, None))
                out.extend((*key, n, *row) for n, row in enumerate(group))
            columns = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

    return _sorted(known, "conv", "segment", "row").mapInArrow(edited, EDITS)


TRANSCRIPTS = "conv bigint, cost bigint, audit string, sha256 string"


def legal(one: Column, two: Column) -> Column:
    return F.concat(one, two).isin("su", "ua", "au")


def report(rows: DataFrame) -> DataFrame:
    """``conv`` and what is wrong with it, by the rows of ``in_segments``: ``gaps`` in
    its turns, rows that are ``blank``, ``duplicate`` or ``truncated``, by their first
    fault, and ``illegal`` neighbours by their initials."""
    one = F.lit(1)
    own = Window.partitionBy("conv", "segment").orderBy("row")
    previous = F.lag("initial").over(own)
    pairs = F.when(previous.isNotNull() & ~legal(previous, F.col("initial")), 1).otherwise(0)
    faults = rows.select(
        "conv", "turn", "copies", "blank", "later", "truncated", pairs.alias("pair")
    )

    def total(c: Column) -> Column:
        return F.sum(c).cast("bigint")

    spanned = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    summed = faults.groupBy("conv").agg(
        F.coalesce(spanned, F.lit(0)).cast("bigint").alias("gaps"),
        total(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        total(
            F.when(F.col("blank"), 0).otherwise(F.col("copies") - one + F.col("later").cast("int"))
        ).alias("duplicate"),
        total(F.col("truncated").cast("int")).alias("truncated"),
        # Copies are neighbours of one initial, which no legal pair has.
        total(F.col("copies") - one + F.col("pair")).alias("illegal"),
    )
    borders = (
        rows.where("segments > 1")
        .groupBy("conv", "segment")
        .agg(F.min_by("initial", "row").alias("first"), F.max_by("initial", "row").alias("last"))
    )
    before_it = F.lag("last").over(Window.partitionBy("conv").orderBy("segment"))
    borders = borders.withColumn("previous", before_it).groupBy(F.col("conv").alias("of")).agg(
        F.count_if(F.col("previous").isNotNull() & ~legal(F.col("previous"), F.col("first"))).alias("more")
    )
    return summed.join(borders, F.col("conv").eqNullSafe(F.col("of")), "left").select(
        "conv", "gaps", "blank", "duplicate", "truncated",
        (F.col("illegal") + F.coalesce("more", F.lit(0))).alias("illegal"),
    )


def transcripts(edits: DataFrame) -> DataFrame:
    """``conv``, the total ``cost``, the edits' initials as ``audit``, and the SHA-256 of
    the lines ``role:text`` that stand in the end. Lines are read in order, one batch
    at a time, and not gathered."""

    schema = arrow_schema(TRANSCRIPTS)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv, cost, audit, lines, digest = False, None, 0, [], 0, hashlib.sha256()

        def row() -> dict:
            return {"conv": conv, "cost": cost, "audit": "".join(audit), "sha256": digest.hexdigest()}

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if not begun or r["conv"] != conv:
                    if begun:
                        out.append(row())
                    begun, conv, cost, audit = True, r["conv"], 0, []
                    lines, digest = 0, hashlib.sha256()
                cost += r["cost"]
                audit.append(r["edit"] * r["times"])
                if r["role"] is not None:
                    line = f"{r['role']}:{r['text']}"
                    digest.update((("\n" if lines else "") + line).encode())
                    lines += 1
            yield pa.RecordBatch.from_pylist(out, schema)
        if begun:
            yield pa.RecordBatch.from_pylist([row()], schema)

    placed = edits.repartition("conv").sortWithinPartitions("conv", "segment", "step")
    return placed.mapInArrow(told, TRANSCRIPTS)


def repair_conversations(
    rows: DataFrame,
    id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    segment_rows: int = SEGMENT,
) -> tuple[DataFrame, DataFrame]:
    """What is wrong with each conversation, as ``report`` says, and the cheapest edits
    that mend it, as ``repair`` says.

    Rows stand in order of their turn, those without a turn first, then of role and text.
    A null role or text counts as one space. Rows without a conversation's id are one
    conversation. An empty table has no conversations; other columns are not read.
    """
    placed = in_segments(faulty_rows(rows, id, turn, role, text), segment_rows)
    return report(placed), repair(placed)


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults, by a checksum of their id and turn: rows dropped,
    emptied, without full stops, repeated, or spoken by the user."""

    def name(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    return (
        rows.select(
            "conv_id",
            "turn",
            spoken("role").alias("role"),
            spoken("text").alias("text"),
            fault.alias("fault"),
        )
        .where(F.col("fault") != 0)
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("fault") == 1, F.lit(""))
            .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))),
        )
        .drop("col")
    )
