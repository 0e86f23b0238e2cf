"""Personal data in texts: patterns propose spans, checks confirm them, words
nearby raise their score.

Only built-in SQL functions run. Matches of one kind do not overlap; a match that
its check refuses is dropped and nothing is tried in its place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.llm.spans import with_matches

# Letters before and after a span, as far as the next match of its kind, that are
# searched for context words.
BEFORE = 40
AFTER = 20

# Parts of a score: a pattern matched, its check passed, a context word is near.
MATCHED = 0.4
CHECKED = 0.4
CONTEXT = 0.2


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def has_digits(match: Column, least: int, most: int) -> Column:
    return F.length(digits(match)).between(least, most)


def _places(text: Column) -> Column:
    return F.sequence(F.lit(1), F.length(text))


def luhn(number: Column) -> Column:
    """Whether digits pass the Luhn check: every second one, from the right,
    doubled and its digits summed, the total divides by 10."""
    backwards = F.reverse(number)

    def add(total: Column, place: Column) -> Column:
        digit = F.ascii(F.substr(backwards, place, F.lit(1))) - F.ascii(F.lit("0"))
        double = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, double).otherwise(digit)

    return F.aggregate(_places(number), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an IBAN without spaces leaves 1 modulo 97: its first four letters
    moved to the end, and A to Z read as 10 to 35."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def append(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substr(turned, place, F.lit(1)))
        letter = code >= F.ascii(F.lit("A"))
        return F.when(letter, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(_places(turned), F.lit(0), append) == 1


@dataclass(frozen=True)
class Kind:
    """``needs`` is text without which the pattern cannot match; spans scoring
    under ``least`` are dropped."""

    name: str
    pattern: str
    context: tuple[str, ...]
    check: Callable[[Column], Column] | None = None
    needs: str = ""
    least: float = 0.0


# Runs that a match must take whole are possessive, and a match begins where such
# a run or the search does. Each pattern so finds what its plain form, given beside
# it, would, in time proportional to the text, and without deep recursion.
BASE_KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        ("mail", "e-mail", "email", "contact", "write"),
        needs="@",
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), no part over 255
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        ("ip", "host", "server", "address", "login"),
        lambda m: m.rlike(r"^0*+((25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])?(\.0*+|$)){4}$"),
        needs=".",
    ),
    # [0-9]([\x20-]?[0-9])+, 13 to 19 digits; shorter runs never count
    Kind(
        "card",
        r"[0-9](?:[\x20-]?+[0-9]){12,}+",
        ("card", "visa", "mastercard", "credit", "debit", "payment", "pay"),
        lambda m: has_digits(m, 13, 19) & luhn(digits(m)),
    ),
    # \+[0-9][\x20().0-9-]+[0-9], 9 to 15 digits
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        ("phone", "tel", "call", "mobile", "cell", "fax"),
        lambda m: has_digits(m, 9, 15),
        needs="+",
    ),
)

MORE_KINDS = (
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
        ("iban", "account", "bank", "konto", "compte", "cuenta"),
        lambda m: mod97(F.regexp_replace(m, " ", "")),
    ),
    # Digits in this shape are common, so only a context word makes them count.
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        ("ssn", "social security", "social-security"),
        needs="-",
        least=MATCHED + CONTEXT,
    ),
)

KINDS = BASE_KINDS + MORE_KINDS


def _near(words: tuple[str, ...], before: Column, after: Column) -> Column:
    pattern = r"(?i)(?<![a-z])(?:" + "|".join(words) + r")(?![a-z])"
    return F.right(before, F.lit(BEFORE)).rlike(pattern) | F.left(after, F.lit(AFTER)).rlike(pattern)


def _spans(kind: Kind) -> Column:
    """The spans of one kind, from its matches and what is around them."""
    matches = F.col(f"_{kind.name}")
    if kind.check:
        matches = F.filter(matches, lambda m: kind.check(m["match"]))

    def span(m: Column) -> Column:
        near = _near(kind.context, m["before"], m["after"])
        score = F.lit(MATCHED + (CHECKED if kind.check else 0.0)) + F.when(near, CONTEXT).otherwise(0.0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            (m["end"] - F.length(m["match"])).alias("start"),
            m["end"].alias("end"),
            score.alias("score"),
        )

    spans = F.transform(matches, span)
    if kind.least:
        spans = F.filter(spans, lambda s: s["score"] >= kind.least)
    none = F.lit([]).cast("array<struct<kind:string,start:int,end:int,score:double>>")
    return F.coalesce(spans, none)


def find_pii(
    docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: its id as ``doc_id`` and ``spans``, an array of
    (kind, start, end, score) by kind as listed, then by start.

    A null or empty text has no spans. Repeated rows and null ids give rows as
    any other; other columns are not read.
    """
    out = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    wanted = {kind.name: F.contains(F.col("_text"), F.lit(kind.needs)) for kind in kinds}
    out = with_matches(out, "_text", {kind.name: kind.pattern for kind in kinds}, wanted)
    return out.select("doc_id", F.concat(*map(_spans, kinds)).alias("spans"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(one, ",")
