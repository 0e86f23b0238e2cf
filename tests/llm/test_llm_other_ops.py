"""Mixing, quality, sharding, encoding, search, the pipeline and the SQL oracles."""

import collections
import hashlib
import math
import random
import re
import time

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import TESTDATA
from llm_cases import collected, documents, shingles, texts
from pyspark.sql import functions as F

import corpus_pipeline
from dayfold.llm.byte_bpe import ByteBpe, decode, encode, read_ranks
from dayfold.llm.exact_dedup import exact_dedup
from dayfold.llm.mixing import PART_MEAN, mix_sources, tempered_weights
from dayfold.llm.oracle import ORACLE
from dayfold.llm.quality import Settings, features, learned, probability, score, train
from dayfold.llm.queries import QUERIES, RANKS
from dayfold.llm.sharding import shard_rows
from dayfold.llm.shared import clear_copies, copies_folder, settled
from dayfold.llm.topk import top_k
from dayfold.llm.words import words_of

SF = f"{TESTDATA}/sf0.01"


# Mixing


def poisson_draw(mean, id, seed):
    parts = max(1, math.ceil(mean / PART_MEAN))
    n = 0
    for part in range(1, parts + 1):
        name = f"{seed}:{'' if id is None else id}:{part}"
        u = (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        p = whole = math.exp(-mean / parts)
        k = 0
        while whole <= u and k < 96:
            k += 1
            p *= mean / parts / k
            whole += p
            n += 1
        n += whole <= u
    return n


def test_mix_sources(spark):
    docs = documents(spark)
    weights = spark.createDataFrame(
        [("src0", 1.0), ("src0", 2.0), ("src1", None), (None, 40.0), ("absent", 9.0)],
        "source string, weight double",
    )
    rows = [(i, t, None if i == 7 else f"src{(i or 0) % 3}") for i, t in texts()]
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len(t or "") + 1
    weight = {"src0": 3.0, None: 40.0}
    rate = {s: weight.get(s, 0.0) / 43.0 * sum(size.values()) / size[s] for s in size}
    expected = collections.Counter()
    for i, t, s in rows:
        for c in range(1, poisson_draw(rate[s], i, 11) + 1):
            expected[i, t, s, c] += 1
    mixed = mix_sources(docs, weights, seed=11)
    assert mixed.columns == [c for c in docs.columns if c != "copy"] + ["copy"]
    found = collections.Counter(map(tuple, mixed.select("doc_id", "text", "source", "copy").collect()))
    assert found == expected
    assert rate[None] > PART_MEAN  # drawn in parts


def test_mixed_sources_meet_their_weights(spark):
    rows = [(i, "x" * 9) for i in range(6_000)]
    docs = documents(spark, rows).withColumn(
        "source", F.when(F.col("doc_id") % 10 == 0, "rare").otherwise("common")
    )
    mixed = mix_sources(docs, tempered_weights(docs, 0.0))
    counts = dict(map(tuple, mixed.groupBy("source").count().collect()))
    assert counts["rare"] == pytest.approx(3_000, rel=0.08)
    assert counts["common"] == pytest.approx(3_000, rel=0.08)
    assert mix_sources(docs.limit(0), tempered_weights(docs, 0.0)).collect() == []


# Quality


def labelled(spark, n=400):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefg", k=rng.randint(2, 8))) for _ in range(5_000)]
    rows, labels = [], []
    for i in range(n):
        text, bad = rng.choices(words, k=rng.randint(8, 60)), i % 4 == 0
        rows.append((i, " ".join(w + "%%%" if bad else w for w in text)))
        labels.append((i, 0 if bad else 1))
    return rows, spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_quality_of_held_out_documents(spark):
    rows, labels = labelled(spark)
    docs = documents(spark, rows)
    model = learned(docs, labels.where("doc_id % 3 <> 1"))
    scored = score(docs, model)
    assert scored.columns == [c for c in docs.columns if c != "score"] + ["score"]
    for r in scored.where("doc_id % 3 = 1").collect():
        assert (r["score"] >= 0.5) == (r["doc_id"] % 4 != 0)


def test_score_is_a_sparse_dot_product_of_the_text_alone(spark):
    docs = documents(spark)
    labels = spark.createDataFrame(
        [(0, 1), (1, 0), (2, 1), (2, 0), (9, None), (None, 1), (999, 0)], "doc_id bigint, quality int"
    )
    model = learned(docs, labels)
    rows = score(docs, model).collect()
    by_text = collections.defaultdict(set)
    for r in rows:
        by_text[r["text"] or ""].add(r["score"])
    assert len(rows) == len(texts()) and all(len(s) == 1 for s in by_text.values())
    assert by_text[""] == by_text[" \n\t "] == {probability(np.array([model[1]]))[0]}
    assert all(0 <= s <= 1 for (s,) in by_text.values())


def test_training_is_follow_the_regularised_leader():
    """Against the updates written out for one weight after another."""
    rng = random.Random(4)
    words = ["good", "Bad", "x1", "so-so", "été", "ok!"]
    rows = [" ".join(rng.choices(words, k=rng.randrange(9))) for _ in range(40)]
    labels = np.array([int("good" in t) for t in rows])
    own = Settings(bits=8, epochs=3, l1=0.01, l2=0.1, alpha=0.5)
    z, n = collections.defaultdict(float), collections.defaultdict(float)
    bias = math.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))

    def weight(i):
        if abs(z[i]) <= own.l1:
            return 0.0
        rest = z[i] - math.copysign(own.l1, z[i])
        return -rest / ((own.beta + math.sqrt(n[i])) / own.alpha + own.l2)

    for _ in range(own.epochs):
        for text, label in zip(rows, labels):
            x = collections.defaultdict(float)
            for _, places in features(words_of(pa.array([text])), own):
                for place in places.tolist():
                    x[place] += 1 / len(places)
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-(bias + sum(w[i] * x[i] for i in x))))
            for i in x:
                g = (p - label) * x[i]
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / own.alpha * w[i]
                n[i] += g * g
    weights, found = train(pa.array(rows), labels, own)
    assert found == pytest.approx(bias)
    assert weights == pytest.approx(np.array([weight(i) for i in range(1 << own.bits)]), abs=1e-6)
    assert np.count_nonzero(weights) > 20


def test_held_out_labels_of_the_driver_table_are_told(spark):
    """Of held-out documents most labels are told; the larger class alone gives 0.85."""
    rows = QUERIES["op3_quality"](spark, SF).where("held_out")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    pairs = rows.join(labels, "doc_id").select("predicted", "quality").collect()
    assert len(pairs) > 50 and sum(p == q for p, q in pairs) > 0.95 * len(pairs)


def test_no_labels(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    weights, bias = learned(docs, none)
    assert not weights.any() and bias == 0.0
    assert {r["score"] for r in score(docs, (weights, bias)).collect()} == {0.5}
    assert score(docs.limit(0), (weights, bias)).collect() == []


def test_sample_is_bounded(spark):
    rows, labels = labelled(spark, 100)
    few = Settings(sample=10)
    weights, bias = learned(documents(spark, rows), labels, few)
    kept = (
        labels.withColumn("place", F.xxhash64("doc_id")).orderBy("place").limit(10).collect()
    )
    text = dict(rows)
    expected, same = train(
        pa.array([text[r["doc_id"]] for r in kept]), np.array([r["quality"] for r in kept]), few
    )
    assert bias == same and np.array_equal(weights, expected)


# Sharding


def shards_of(df, groups):
    placed = collections.defaultdict(list)
    spread = collections.defaultdict(collections.Counter)
    for r in df.collect():
        placed[r["shard"]].append(r["slot"])
        spread[groups[r["doc_id"]]][r["shard"]] += 1
    for slots in placed.values():
        assert sorted(slots) == list(range(len(slots)))
    sizes = [len(placed[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    return spread


def test_shards_are_even_and_keep_small_groups_whole(spark):
    rng = random.Random(9)
    groups = {i: rng.randrange(300) if i % 3 else 1_000 + i for i in range(2_400)}
    docs = spark.createDataFrame(list(groups.items()), "doc_id bigint, g bigint")
    spread = shards_of(shard_rows(docs, F.col("g")), groups)
    whole = sum(len(c) == 1 for c in spread.values())
    assert whole > 0.97 * len(spread)


def test_hot_group_takes_few_shards(spark):
    groups = {i: 0 if i % 3 == 0 else i for i in range(3_000)}
    docs = spark.createDataFrame(list(groups.items()), "doc_id bigint, g bigint")
    spread = shards_of(shard_rows(docs, F.col("g")), groups)
    assert len(spread[0]) <= 4  # a third of all needs three shards of eight


def test_all_documents_linked(spark):
    groups = {i: i // 2 for i in range(1_600)}
    docs = spark.createDataFrame(list(groups.items()), "doc_id bigint, g bigint")
    spread = shards_of(shard_rows(docs, F.col("g")), groups)
    assert sum(len(c) == 1 for c in spread.values()) > 0.6 * len(spread)


def test_sharding_awkward_documents(spark):
    docs = documents(spark)
    rows = shard_rows(docs, F.col("text"), carry=("lang", "source"))
    assert rows.columns == ["doc_id", "lang", "source", "shard", "slot"]
    found = rows.collect()
    assert len(found) == len(texts())
    assert collections.Counter(r["doc_id"] for r in found) == collections.Counter(
        i for i, _ in texts()
    )
    sizes = collections.Counter(r["shard"] for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 8
    assert shard_rows(docs.limit(0), F.col("text")).collect() == []
    assert len(shard_rows(docs.limit(3), F.col("text")).collect()) == 3


# Encoding


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = read_ranks(file.read())
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.mark.parametrize("apart", [True, False])
def test_encoding_awkward_documents(spark, reference, apart):
    docs = documents(spark)
    out = encode(docs, RANKS, public_tokenizers.PATTERN, decoded="decoded", apart=apart)
    assert out.columns == [c for c in docs.columns if c not in ("ids", "decoded")] + ["ids", "decoded"]
    rows = decode(out, RANKS, out="again").collect()
    assert len(rows) == len(texts())
    for r in rows:
        text = r["text"] or ""
        assert r["ids"] == reference.encode_ordinary(text)
        assert bytes(r["decoded"]) == bytes(r["again"]) == text.encode()
    assert encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_random_texts_encode_as_by_merging(reference):
    with open(RANKS, "rb") as file:
        rank_file = file.read()
    rng = random.Random(10)
    for apart in (True, False):
        bpe = ByteBpe(rank_file, public_tokenizers.PATTERN, apart)
        for letters in ("ab", "a  b\n", "aA \n\t'sre", "éñ\U0001f600 a\x85\x1c\xa0 ٣", "aaab"):
            for _ in range(300):
                text = "".join(rng.choices(letters, k=rng.randint(0, 80)))
                ids = bpe.encode(text)
                assert ids == reference.encode_ordinary(text)
                assert bpe.decode(ids) == text.encode()


def test_long_matches_take_time_in_proportion(reference):
    with open(RANKS, "rb") as file:
        bpe = ByteBpe(file.read(), public_tokenizers.PATTERN)
    rng = random.Random(3)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=160_000))
    assert bpe.encode(text[:20_000]) == reference.encode_ordinary(text[:20_000])

    def seconds(n):
        begun = time.perf_counter()
        ids = bpe.encode(text[:n])
        assert bpe.decode(ids) == text[:n].encode()
        return time.perf_counter() - begun

    few, many = seconds(40_000), seconds(160_000)
    assert many < 8 * few + 0.5


# Search


def nearest(rows, k):
    coded = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            coded[i, tuple(math.floor(256 * float(np.float32(x))) for x in v)] = None
    out = []
    for q, x in coded:
        if q % 3 == 0:
            scores = [
                (-sum(a * b for a, b in zip(x, y)), c) for c, y in coded if c != q and len(x) == len(y)
            ]
            out += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("segment, candidates", [(1_024, 8_192), (16, 64)])
def test_top_k(spark, monkeypatch, segment, candidates):
    monkeypatch.setattr("dayfold.llm.topk.SEGMENT", segment)
    monkeypatch.setattr("dayfold.llm.topk.BLOCK_CANDIDATES", candidates)
    monkeypatch.setattr("dayfold.llm.topk.BLOCK_QUERIES", candidates)
    rng = random.Random(12)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(60)]  # very many copies
    rows += [(500 + i, [float(rng.randint(-1, 1)) for _ in range(8)]) for i in range(60)]  # ties
    rows += [(600, None), (601, []), (602, [None] * 8), (603, [math.nan] * 8), (604, [math.inf] * 8)]
    rows += [(None, rows[1][1]), (3, rows[3][1]), (606, [1.0, 2.0]), (609, [-1.0, 2.0]), (612, [0.5])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    vectors = vectors.select("*", *[F.lit(1).alias(c) for c in ("score", "rank", "width", "c", "q", "asks")])
    found = top_k(vectors.repartition(3), F.col("vec_id") % 3 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert collected(found) == nearest(rows, 5)
    assert top_k(vectors.limit(0), F.lit(True)).collect() == []


# The pipeline, the oracles, and all queries


def similar(rows, words, percent):
    """For each text the least id that links of similar sets lead to."""
    sets = {i: shingles(t, words) for i, t in rows.items()}
    holders = collections.defaultdict(list)
    for i, s in sorted(sets.items()):
        for x in s:
            holders[x].append(i)
    common = collections.Counter(
        (a, b) for ids in holders.values() for n, a in enumerate(ids) for b in ids[n + 1 :]
    )
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return {i: top(i) for i in sets}


def test_pipeline_against_its_operators_in_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    table = {r["doc_id"]: r for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == [
        "quality classifier", "exact dedup", "n-gram Jaccard join", "mixing sources", "byte-level BPE",
    ]
    columns = docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = docs
    good = steps["quality classifier"](spark, kept, SF)
    assert good.columns == columns
    ids = {r["doc_id"] for r in good.collect()}
    assert all((i in ids) == (q == 1) for i, q in labels.items())
    distinct = steps["exact dedup"](spark, good, SF)
    newest = {}
    for i in ids:
        newest[table[i]["text"] or ""] = max(i, newest.get(table[i]["text"] or "", i))
    assert sorted(r["doc_id"] for r in distinct.collect()) == sorted(newest.values())
    unlike = steps["n-gram Jaccard join"](spark, distinct, SF)
    least = similar({i: table[i]["text"] for i in newest.values()}, 5, 80)
    left = sorted(r["doc_id"] for r in unlike.collect())
    assert left == sorted(i for i, root in least.items() if i == root) and len(left) < len(newest)
    mixed = steps["mixing sources"](spark, unlike, SF)
    assert distinct.columns == unlike.columns == mixed.columns == columns
    copies = collections.Counter(r["doc_id"] for r in mixed.collect())
    out = corpus_pipeline.run(spark, SF).collect()
    assert collections.Counter(r["doc_id"] for r in out) == copies
    assert all(r["text"] == (table[r["doc_id"]]["text"] or "") for r in out)
    assert all(r["n_tokens"] == len(r["ids"]) for r in out)


def test_pipeline_stages_take_awkward_and_empty_documents(spark, tmp_path):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, None)], "doc_id bigint, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents(spark).select(*columns)
    for table in (docs, docs.limit(0)):
        table.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path)).collect()
        assert bool(out) == (table is docs)
    one = corpus_pipeline.distinct(spark, docs, "")
    sizes = exact_dedup(docs).where("kept").count()
    assert one.count() == sizes


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    result = con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert collected(df.select(*columns)) == sorted(
        map(tuple, result), key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r]
    )


NATIVE = ["op4_sharding", "op7_pii", "op13_secret_scan"]


@pytest.mark.parametrize("name", NATIVE)
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_each_dealt_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))


def test_copies_are_cleared(spark):
    docs = documents(spark)
    copy = settled(docs)
    assert copy.count() == len(texts())
    clear_copies(spark)
    with pytest.raises(Exception, match="(?i)does not exist|no such file|not found"):
        spark.read.parquet(copies_folder(spark)).count()


def test_exact_dedup_in_many_shares(spark, monkeypatch):
    docs = documents(spark)
    expected = collected(exact_dedup(docs))
    monkeypatch.setattr("dayfold.llm.exact_dedup.SHARE_ROWS", 3)
    found = exact_dedup(docs)
    assert collected(found) == expected
    assert re.search(r"hashpartitioning\(digest#\d+, (\d+)\), REPARTITION_BY_NUM",
                     found._jdf.queryExecution().executedPlan().toString())
