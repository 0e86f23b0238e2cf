"""Awkward documents, and plain-Python answers to compare with."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

CLASHING = (
    "score copy block part digest ids decoded group shard slot size place label keys values "
    "root one two carry training spans keep_id kept weight rate copies doc class_id home piece"
).split()

COMMON = "one line that very many documents have in common with all the others here today"


def texts(seed: int = 5, many: int = 60) -> list[tuple[int | None, str | None]]:
    """Ids and texts: nulls, empty and very long ones, copies, near copies, shared
    passages, few words, odd white space, ties and repeated rows."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    out: list[tuple[int | None, str | None]] = []
    base = [" ".join(rng.choices(words, k=rng.choice([20, 40, 120]))) for _ in range(12)]
    for i in range(many):
        kind = rng.randrange(6)
        text = rng.choice(base)
        if kind == 1:  # a near copy
            tokens = text.split()
            tokens[rng.randrange(len(tokens))] = "changed"
            text = " ".join(tokens)
        elif kind == 2:  # a shared passage
            text = " ".join(rng.choices(words, k=10)) + "\n" + COMMON + " " + rng.choice(words)
        elif kind == 3:
            text = " ".join(rng.choices(words, k=rng.randint(0, 30)))
        elif kind == 4:
            text = text.upper().replace(" ", "\t\x0b ", 3)
        out.append((i, text))
    long = " ".join(rng.choices(words, k=20_000))
    out += [
        (100, None), (101, ""), (102, None), (103, " \n\t "), (104, "one"), (105, "ONE"),
        (106, "two words"), (107, "two words"), (108, "x" * 30_000), (109, long), (110, long + " end"),
        (111, "a b   c\x1c d\x85e"), (112, "éß 中文 \U0001f600 مرحبا"),
        (113, "same " * 500), (114, "same " * 501), (None, base[0]), (None, None), (3, out[3][1]),
        (3, out[3][1]), (5, "another text under the same id"), (115, "\x00 nul \x01"),
    ]
    return out


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    data = [(i, t, "en", f"src{(i or 0) % 3}" if i != 7 else None, len(t or "")) for i, t in rows]
    docs = spark.createDataFrame(
        data, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )
    return docs.select("*", *[F.lit("other").alias(c) for c in CLASHING]).repartition(3)


def split(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return re.findall("[^\x20\x09-\x0d]+", text)


def shingles(text: str | None, n: int) -> set:
    words = split(text, lower=True)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def collected(df) -> list[tuple]:
    def key(row):
        return [(v is None, str(type(v)), v if v is not None else 0) for v in row]

    return sorted((tuple(r) for r in df.collect()), key=key)
