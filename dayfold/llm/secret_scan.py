"""Secrets in texts, by a ledger of blobs that have been scanned.

Texts are addressed by their content: paths that hold the same text, now or in an
earlier version, hold one blob. The ledger says which versions of which rules have
been run over a blob and what they found. A scan looks only at pairs of blob and rule
version that the ledger lacks, adds them to it, and joins findings back to all paths.
Only built-in SQL functions run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.llm.shared import BROADCAST_ROWS, copies_folder, cut
from dayfold.llm.spans import with_matches

LEDGER = "blob binary, rules array<string>, spans array<struct<rule:string,start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern, and what its match must fulfil; a match that fails is dropped and
    nothing tried in its place. A rule that changes gets another version, under which
    every blob is scanned again."""

    name: str
    pattern: str
    check: Callable[[Column], Column] | None = None
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# What stands before the value of an assignment.
ASSIGNED = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""

# Where a check asks for a length, the pattern does; each so finds what its plain form,
# given beside it, would.
BASE_RULES = (
    # (password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)
    Rule(
        "assign",
        ASSIGNED + r"[A-Za-z0-9+/_.=-]+",
        lambda m: F.length(F.regexp_replace(m, "^" + ASSIGNED, "")) >= 8,
    ),
    # AKIA[A-Z0-9]+, 16 characters or more; a shorter one has no other within it
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    # [0-9a-f]+, 32 characters or more
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}"),
)

MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

RULES = BASE_RULES + MORE_RULES


def blob(text: str) -> Column:
    """The address of a text: the SHA-256 of its UTF-8 bytes. A null text is empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a ledger; none where nothing has been written yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def unseen(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob`` and ``todo``, the rule versions that have not been run over it, for
    each distinct blob that has some."""
    all_rules = F.array(*[F.lit(rule.key) for rule in rules])
    done = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("done"))
    none = F.lit([]).cast("array<string>")
    return (
        blobs.select("blob")
        .distinct()
        .join(done, "blob", "left")
        .select("blob", F.array_except(all_rules, F.coalesce("done", none)).alias("todo"))
        .where(F.size("todo") > 0)
    )


def _spans(rule: Rule) -> Column:
    """The spans of one rule, from its matches and their ends."""
    matches = F.col(f"_{rule.name}")
    if rule.check:
        matches = F.filter(matches, lambda m: rule.check(m["match"]))
    spans = F.transform(
        matches,
        lambda m: F.struct(
            F.lit(rule.name).alias("rule"),
            (m["end"] - F.length(m["match"])).alias("start"),
            m["end"].alias("end"),
        ),
    )
    return F.coalesce(spans, F.lit([]).cast("array<struct<rule:string,start:int,end:int>>"))


def scanned(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows for ``blob``, ``text`` and ``todo``."""
    todo = {rule.name: F.array_contains("todo", rule.key) for rule in rules}
    found = with_matches(texts, "text", {rule.name: rule.pattern for rule in rules}, todo)
    return found.select(
        "blob", F.col("todo").alias("rules"), F.concat(*map(_spans, rules)).alias("spans")
    )


def update_ledger(
    docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, text: str = "text"
) -> None:
    """Run over each blob the rule versions that its ledger lacks, and add the outcome,
    findings or none, to the ledger in folder ``path``.

    One text of each blob is read by the rules, however many paths hold it. Blobs are
    matched with what is to do by broadcast where that is little, as in a daily run;
    else texts are shuffled by blob, after copies have been reduced in each task. Rows
    of a run that broke off are findings like any other; what it left is made up for.
    """
    held = docs.select(blob(text).alias("blob"), F.coalesce(text, F.lit("")).alias("text"))
    todo = cut(unseen(held, read_ledger(docs.sparkSession, path), rules))
    if todo.count() <= BROADCAST_ROWS:
        todo = F.broadcast(todo)
        held = held.join(todo.select("blob"), "blob", "left_semi")
    one = held.groupBy("blob").agg(F.first("text").alias("text"))
    scanned(one.join(todo, "blob"), rules).write.mode("append").parquet(path)


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob`` and ``spans`` of these rule versions, by start, then rule as listed, for
    each blob that has some."""
    keys = F.create_map(*[F.lit(x) for rule in rules for x in (rule.name, rule.key)])
    order = F.create_map(*[F.lit(x) for i, rule in enumerate(rules) for x in (rule.name, i)])
    names = [rule.name for rule in rules]
    current = F.filter(
        "spans",
        lambda s: s["rule"].isin(names) & F.array_contains(F.col("rules"), keys[s["rule"]]),
    )
    ordered = F.transform(
        current, lambda s: F.struct(s["start"], order[s["rule"]].alias("order"), s["rule"], s["end"])
    )
    each = ledger.select("blob", ordered.alias("spans")).where(F.size("spans") > 0)
    found = each.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    # A run that broke off may have found the same before.
    once = F.filter("spans", lambda s, i: (i == 0) | (s != F.get("spans", i - 1)))
    plain = F.transform("once", lambda s: F.struct(s["rule"], s["start"], s["end"]))
    return found.withColumn("once", once).select("blob", plain.alias("spans"))


def scan_secrets(
    docs: DataFrame,
    ledger: str | None = None,
    rules: tuple[Rule, ...] = RULES,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: its id as ``doc_id`` and ``spans``, an array of (rule,
    start, end) in code points, by start, then by rule as listed.

    The ledger in folder ``ledger`` is brought up to date first; without one a new one
    is begun among this application's copies in the shared folder. Null and empty texts are one blob without spans.
    Repeated rows and null ids give rows as any other; other columns are not read.
    """
    spark = docs.sparkSession
    path = ledger or f"{copies_folder(spark)}/ledger-{uuid.uuid4().hex}"
    update_ledger(docs, path, rules, text)
    found = findings(read_ledger(spark, path), rules)
    none = F.lit([]).cast("array<struct<rule:string,start:int,end:int>>")
    paths = docs.select(F.col(id).alias("doc_id"), blob(text).alias("blob"))
    return paths.join(found, "blob", "left").select(
        "doc_id", F.coalesce("spans", none).alias("spans")
    )


def written(spans: Column) -> Column:
    """Spans as ``rule:start:end``, joined by commas."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"]))
    return F.array_join(one, ",")
