"""A training corpus from raw documents, in five stages.

Each stage is given the table its predecessor wrote and returns the next one; all but
the last return the columns of ``documents``. ``run`` writes every stage's table to the
shared folder before the next begins, so that a lost executor costs one stage's work
at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayfold.llm.byte_bpe import encode
from dayfold.llm.exact_dedup import exact_dedup
from dayfold.llm.jaccard_join import jaccard_join
from dayfold.llm.mixing import mix_sources, tempered_weights
from dayfold.llm.quality import held_out, learned, score
from dayfold.llm.shared import counted, cut, settled

# Near duplicates: shingles of five words, four fifths of them shared.
SHINGLE = 5
PERCENT = 80

# Sources are weighted by the square root of their size.
MIX_POWER = 0.5
MIX_SEED = 7

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

QUALITY = "_quality"


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. Labels of held-out documents are
    not learned from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    scored = score(docs, learned(docs, labels), out=QUALITY)
    return scored.where(F.col(QUALITY) >= 0.5).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id; of repeated rows one."""
    key = ["_null", "_id", "_digest"]
    keys = {
        "_null": F.col("doc_id").isNull(),
        "_id": F.coalesce("doc_id", F.lit(0).cast("bigint")),
    }
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    verdicts = exact_dedup(docs).withColumns(keys | {"_digest": F.col("digest")})
    verdicts = cut(
        verdicts.groupBy(*key).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    )
    gone = counted(verdicts.where("NOT kept").select(*key))
    left = docs.withColumns(keys | {"_digest": digest}).join(gone, key, "left_anti")
    again = verdicts.where("kept AND rows > 1").select(*key)
    if not again.isEmpty():
        again = counted(again)
        order = Window.partitionBy(*key).orderBy("lang", "source", "n_chars")
        one = left.join(again, key, "left_semi").withColumn("_row", F.row_number().over(order))
        one = one.where(F.col("_row") == 1).drop("_row")
        left = left.join(again, key, "left_anti").select(*one.columns).unionByName(one)
    return left.select(*docs.columns)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id; those without an id stay."""
    groups = jaccard_join(docs, words=SHINGLE, percent=PERCENT)
    repeats = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(counted(repeats), "doc_id", "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their weights, shuffled."""
    weights = tempered_weights(docs, MIX_POWER)
    return mix_sources(docs, weights, MIX_SEED, copy="_copy").select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the text they decode to."""
    out = encode(docs, RANKS, public_tokenizers.PATTERN, decoded="decoded", apart=True)
    return out.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.col("decoded").cast("string").alias("text"),
    )


STAGES = [
    ("quality classifier", good),
    ("exact dedup", distinct),
    ("n-gram Jaccard join", unlike),
    ("mixing sources", mixed),
    ("byte-level BPE", encoded),
]

# SQL cannot express the classifier, nor the encoder; tests/llm hold brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *stages, (_, last) = STAGES
    for _, stage in stages:
        docs = settled(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
