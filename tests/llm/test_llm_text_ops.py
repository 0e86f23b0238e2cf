"""Operators on documents against plain Python, with awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from llm_cases import collected, documents, shingles, split, texts
from pyspark.sql import functions as F

from dayfold.llm import lm_score
from dayfold.llm.exact_dedup import CuckooIndex, exact_dedup
from dayfold.llm.jaccard_join import bands, jaccard_join
from dayfold.llm.lm_score import score_texts
from dayfold.llm.pii import BASE_KINDS, find_pii, luhn, mod97, written
from dayfold.llm.shared import cut
from dayfold.llm.substring_dedup import WINDOW, substring_dedup


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark).limit(0)


# Substring dedup


def removed(rows):
    first = {}
    split_rows = [(i, split(t)) for i, t in rows]
    for i, words in sorted((r for r in split_rows if r[0] is not None), key=lambda r: r[0]):
        for k in range(len(words) - WINDOW + 1):
            first.setdefault(tuple(words[k : k + WINDOW]), i)
    out = []
    for i, words in split_rows:
        gone = [False] * len(words)
        for k in range(len(words) - WINDOW + 1):
            if i is not None and first[tuple(words[k : k + WINDOW])] < i:
                gone[k : k + WINDOW] = [True] * WINDOW
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def test_substring_dedup(docs):
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    found = [tuple(r)[:4] for r in substring_dedup(docs).collect()]
    assert sorted(found, key=order) == sorted(removed(texts()), key=order)


def test_factors_are_equal_stretches_of_their_sources(docs):
    rows = collections.defaultdict(list)
    for i, t in texts():
        rows[i].append(split(t))
    seen = 0
    for r in substring_dedup(docs).collect():
        covered = set()
        for f in r["factors"]:
            seen += 1
            assert f["source_id"] < r["doc_id"] and f["length"] >= WINDOW
            stretches = [w[f["start"] : f["start"] + f["length"]] for w in rows[r["doc_id"]]]
            sources = [
                w[f["source_start"] : f["source_start"] + f["length"]] for w in rows[f["source_id"]]
            ]
            assert any(s in sources for s in stretches)
            covered |= set(range(f["start"], f["start"] + f["length"]))
        assert len(covered) == r["n_removed"]
    assert seen


# Exact dedup


def test_exact_dedup(docs):
    groups = collections.defaultdict(list)
    for i, t in texts():
        groups[t or ""].append(i)
    expected = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = True
        for i in sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True):
            kept = i == keep and left
            left &= not kept
            expected.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).digest()))
    found = exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "digest")
    order = lambda r: (r[4], r[0] is None, r[0] or 0, r[3])
    assert sorted(map(tuple, found.collect()), key=order) == sorted(expected, key=order)


def test_removed_texts_have_no_copy_that_stays(spark, docs):
    gone = spark.createDataFrame([("two words",), ("not there",)], "text string")
    rows = {r["doc_id"]: r for r in exact_dedup(docs, gone).collect()}
    assert not rows[106]["kept"] and not rows[107]["kept"] and rows[107]["keep_id"] is None
    assert rows[104]["kept"] and rows[102]["keep_id"] == 102


def test_cuckoo_index_inserts_deletes_and_grows():
    rng, index, live = random.Random(1), CuckooIndex(buckets=1), {}
    for _ in range(20_000):
        digest = hashlib.sha256(str(rng.randrange(3_000)).encode()).digest()
        if rng.random() < 0.4:
            assert index.delete(digest) == live.pop(digest, None)
        else:
            row = index.insert(digest)
            assert live.setdefault(digest, row) == row
        assert index.row(digest) == live.get(digest)
    assert len(index) == len(live) and len(set(live.values())) == len(live)
    assert all(index.row(d) == row for d, row in live.items())


def test_cuckoo_index_tells_apart_equal_fingerprints():
    index = CuckooIndex()
    a, b = b"\x01" * 10 + b"a" * 22, b"\x01" * 10 + b"b" * 22
    index.insert(a)
    assert index.row(b) is None and index.insert(b) != index.insert(a)
    index.delete(a)
    assert index.row(a) is None and index.row(b) is not None


# Jaccard join


def linked(rows, words, percent):
    sets = [(i, shingles(t, words)) for i, t in rows]
    links, parent = [0] * len(sets), list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for b, (j, y) in enumerate(sets[:a]):
            if i is None or j is None or not x:
                continue
            if 100 * len(x & y) >= percent * len(x | y):
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = {}
    for a, (i, x) in enumerate(sets):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return sorted(
        ((i, len(x), least.get(find(a)), links[a]) for a, (i, x) in enumerate(sets)),
        key=lambda r: tuple((v is None, v or 0) for v in r),
    )


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (1, 60)])
def test_jaccard_join(docs, words, percent):
    assert collected(jaccard_join(docs, words=words, percent=percent)) == linked(
        texts(), words, percent
    )


def test_large_candidate_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr("dayfold.llm.jaccard_join.BLOCK_SETS", 7)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"x{rng.randrange(99)}"
        rows.append((i, " ".join(words)))
    assert collected(jaccard_join(documents(spark, rows))) == linked(rows, 3, 90)


def test_similar_sizes_are_in_one_band_or_in_neighbours():
    for percent in (50, 80, 90, 97):
        last = bands(percent, 3_000).tolist()
        band = lambda size: next(i for i, u in enumerate(last) if size <= u)
        for size in range(1, 1_500):
            assert band(min(3_000, size * 100 // percent)) - band(size) in (0, 1)


# Language model


def test_lm_score(docs):
    training = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 != 2
    rows = [(i, [*split(t, lower=True), None]) for i, t in texts()]
    learns = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 != 2
    counts = collections.Counter(w for i, words in rows for w in words if learns(i))
    n, v = sum(counts.values()), len(counts)
    expected = collections.defaultdict(list)
    for i, words in rows:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        expected[i].append((learns(i), len(words), sum(counts[w] > 0 for w in words), n, base))
    found = collections.defaultdict(list)
    for r in score_texts(docs, training).collect():
        found[r[0]].append(tuple(r)[1:6])
        assert r["score"] <= 0.0 and math.isfinite(r["score"])
    assert found.keys() == expected.keys()
    for i in found:
        for ours, theirs in zip(sorted(found[i]), sorted(expected[i])):
            assert ours[:4] == theirs[:4] and ours[4] == pytest.approx(theirs[4], rel=1e-9)


def corpus(seed=3, many=240):
    """Texts of words that follow each other unevenly."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)]
    out = []
    for i in range(many):
        text = [rng.choice(words)]
        while len(text) < rng.choice([3, 20, 60]):
            own = int(text[-1][1:])
            text.append(words[(own * 7 + rng.choice([1, 1, 1, 2, 3, rng.randrange(120)])) % 120])
        out.append((i, " ".join(text)))
    return out


def counted_tokens(rows, learns):
    """Tokens of each text, an end last, and counts of tokens and of pairs in training; a
    text's first token follows an end."""
    tokens = {i: [*split(t, lower=True), None] for i, t in rows}
    words = collections.Counter(w for i in tokens if learns(i) for w in tokens[i])
    pairs = collections.Counter(
        p for i in tokens if learns(i) for p in zip([None, *tokens[i]], tokens[i])
    )
    return tokens, words, pairs


def learned_weights(tokens, words, pairs, learns):
    """Expectation-maximisation over every training token, which takes itself off the
    counts, by classes of contexts."""
    total, distinct = sum(words.values()), len(words)
    estimates = collections.defaultdict(list)
    for i, text in tokens.items():
        for before, word in zip([None, *text], text) if learns(i) else ():
            context = words[before] - 1
            estimates[context.bit_length()].append((
                (pairs[before, word] - 1) / max(context, 1),
                (words[word] - 1) / max(total - 1, 1),
                1 / (distinct + 1),
            ))
    weights = {}
    for c, rows in estimates.items():
        rows = np.array(rows)
        own = np.array([1, 1, 1]) / 3 if c else np.array([0, 0.5, 0.5])
        for _ in range(lm_score.ROUNDS):
            shares = rows * own
            own = (shares / shares.sum(axis=1, keepdims=True)).mean(axis=0)
        weights[c] = own
    return weights


def test_lm_scores_are_those_of_the_interpolated_model(spark):
    rows = corpus()
    learns = lambda i: i % 5 != 0
    docs, training = documents(spark, rows), F.col("doc_id") % 5 != 0
    tokens, words, pairs = counted_tokens(rows, learns)
    total, distinct = sum(words.values()), len(words)
    model = lm_score.learn(cut(lm_score.token_counts(docs, training)))
    assert (model.tokens, model.distinct) == (total, distinct)

    def scored(weights, text):
        out = 0.0
        for before, word in zip([None, *text], text):
            bigram, unigram, even = weights[words[before].bit_length()]
            p = bigram * pairs[before, word] / max(words[before], 1)
            out += math.log10(p + unigram * words[word] / total + even / (distinct + 1))
        return out

    exact = learned_weights(tokens, words, pairs, learns)
    for r in score_texts(docs, training).collect():
        assert r["score"] == pytest.approx(scored(model.weights, tokens[r["doc_id"]]), rel=1e-9)
        if all(words[w].bit_length() in exact for w in [None, *tokens[r["doc_id"]]]):
            # Weights are learned from rounded estimates; what it changes is small.
            assert r["score"] == pytest.approx(scored(exact, tokens[r["doc_id"]]), rel=0.01)
    # The next tokens that there can be, an unknown one among them, share all of 1.
    for before in words:
        bigram, unigram, even = model.weights[words[before].bit_length()]
        follow = sum(n for (b, _), n in pairs.items() if b == before)
        assert bigram * follow / words[before] + unigram + even == pytest.approx(1.0, abs=1e-12)


def test_lm_held_out_texts_score_above_the_base(spark):
    rng = random.Random(4)
    follow = {f"w{i}": [f"w{(i * 7 + k) % 50}" for k in range(3)] for i in range(50)}

    def text():
        word, out = "w0", []
        for _ in range(80):
            word = rng.choice(follow[word])
            out.append(word)
        return " ".join(out)

    docs = documents(spark, [(i, text()) for i in range(80)])
    rows = score_texts(docs, F.col("doc_id") % 4 != 0).where("NOT training").collect()
    assert len(rows) == 20
    assert all(r["score"] > 0.5 * r["base_score"] for r in rows)


def test_lm_without_training_documents(docs):
    rows = score_texts(docs, F.lit(False)).collect()
    assert len(rows) == len(texts())
    assert all(r["base_score"] == r["score"] == 0.0 and r["n_known"] == 0 for r in rows)


# Personal data

SAMPLES = [
    "mail a.b+c@mail-1.example.com, or x@y or @z or q@@w.com p@q.r@s.t",
    "%@a.b_c@d.e ip 1.2.3.4 and 256.1.1.1 and 001.02.3.255 1.2.3.4.5.6.7.8 1.2.3",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 79927398713 4111111111111111 9" + "0" * 30,
    "call +1 (017) 555-7713 or +49.30.123456 or +12 or +1 ((((((( or +1 2 3 4 5 6 7 8 9 +",
    "é\U0001f600 中 x@y.de \U0001f600 +1 222 333 4444 iban DE89 3704 0044 0532 0130 00 ok",
    "GB82WEST12345698765432 GB82WEST12345698765431 ssn 123-45-6789 and 123-45-6789",
    "a" * 40_000, "1 " * 20_000, "a@b" + ".c" * 20_000, "+1" * 5_000, "1." * 20_000, "@" * 5_000, None, "",
]


def luhn_holds(number):
    digits = [int(c) for c in reversed(number)]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def base_spans(text):
    checks = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
        "ip": (
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            lambda m, d: all(int(x) <= 255 for x in m.split(".")),
        ),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m, d: 13 <= len(d) <= 19 and luhn_holds(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 9 <= len(d) <= 15),
    }
    return ",".join(
        f"{kind}:{m.start()}:{m.end()}"
        for kind, (pattern, check) in checks.items()
        for m in re.finditer(pattern, text)
        if check(m.group(), re.sub("[^0-9]", "", m.group()))
    )


def test_base_spans(spark):
    rng = random.Random(6)
    alphabet = "0123456789..--  ()+@ab%_é"
    rows = list(enumerate(SAMPLES))
    rows += [(100 + i, "".join(rng.choices(alphabet, k=rng.randint(0, 80)))) for i in range(400)]
    found = find_pii(documents(spark, rows), BASE_KINDS).select("doc_id", written(F.col("spans")))
    expected = {i: base_spans(t or "") for i, t in rows}
    assert dict(map(tuple, found.collect())) == expected
    assert sum(map(bool, expected.values())) > 30


def test_added_spans_and_scores(spark):
    rows = list(enumerate(SAMPLES))
    spans = {r["doc_id"]: r["spans"] for r in find_pii(documents(spark, rows)).collect()}
    text = SAMPLES[5]
    found = [(s["kind"], text[s["start"] : s["end"]]) for s in spans[5] if s["kind"] in ("iban", "ssn")]
    assert found == [("iban", "GB82WEST12345698765432"), ("ssn", "123-45-6789")]
    iban = next(s for s in spans[4] if s["kind"] == "iban")
    assert SAMPLES[4][iban["start"] : iban["end"]].startswith("DE89")
    mail = [s for s in spans[0] if s["kind"] == "email"]
    assert mail[0]["score"] > mail[-1]["score"]


def test_checksums(spark):
    rows = spark.createDataFrame([("79927398713", "GB82WEST12345698765432")], "n string, i string")
    bad = spark.createDataFrame([("79927398710", "GB83WEST12345698765432")], "n string, i string")
    both = rows.union(bad).select(luhn(F.col("n")), mod97(F.col("i"))).collect()
    assert [tuple(r) for r in both] == [(True, True), (False, False)]


def test_empty_tables(empty):
    assert substring_dedup(empty).collect() == []
    assert exact_dedup(empty).collect() == []
    assert jaccard_join(empty).collect() == []
    assert score_texts(empty, F.lit(True)).collect() == []
    assert find_pii(empty).collect() == []
