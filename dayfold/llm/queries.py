"""The registered queries: each operator on its whole table, as production would
run it, with digests in place of long texts and lists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.llm.byte_bpe import encode
from dayfold.llm.conversation_repair import damage, repair_conversations, transcripts
from dayfold.llm.exact_dedup import exact_dedup
from dayfold.llm.jaccard_join import jaccard_join
from dayfold.llm.lexical_search import search
from dayfold.llm.lm_score import score_texts
from dayfold.llm.mixing import mix_sources, tempered_weights
from dayfold.llm.pii import BASE_KINDS, find_pii, written
from dayfold.llm.quality import held_out, learned, score
from dayfold.llm.secret_scan import BASE_RULES, scan_secrets
from dayfold.llm.secret_scan import written as written_secrets
from dayfold.llm.sharding import shard_rows
from dayfold.llm.substring_dedup import substring_dedup
from dayfold.llm.topk import top_k

MIX_POWER = 0.5
MIX_SEED = 7

SHARDS = 8

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mix_sources(docs, tempered_weights(docs, MIX_POWER), MIX_SEED)
    return mixed.select("doc_id", "source", "copy", F.sha2("text", 256).alias("text_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    return score(docs, learned(docs, labels)).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("same_text"),
    )
    placed = shard_rows(docs, F.col("same_text"), SHARDS, carry=("size", "text_crc32"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = encode(docs, RANKS, public_tokenizers.PATTERN, decoded="decoded", apart=True)
    return ids.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    training = F.crc32(id_text) % 7 != 2
    return score_texts(table(spark, sf_dir, "documents"), training).select(
        "doc_id",
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [kind.name for kind in BASE_KINDS]
    spans = F.col("spans")

    def count(name: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == name)).cast("bigint")

    base = F.filter(spans, lambda s: s["kind"].isin(names))
    return find_pii(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[count(name).alias(f"n_{name}") for name in names],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(spans).alias("spans"),
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    faults, edits = repair_conversations(damage(conversations))
    mended = transcripts(edits).withColumnRenamed("conv", "mended")
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (
        ids.join(faults, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
        .join(mended, F.col("conv_id").eqNullSafe(F.col("mended")), "left")
        .select(
            "conv_id",
            *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [rule.name for rule in BASE_RULES]
    spans = F.col("spans")

    def count(name: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["rule"] == name)).cast("bigint")

    base = F.filter(spans, lambda s: s["rule"].isin(names))
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[count(name).alias(f"n_{name}") for name in names],
        F.sha2(written_secrets(base), 256).alias("base_sha256"),
        written_secrets(spans).alias("spans"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_mixing": op2_mixing,
    "op3_quality": op3_quality,
    "op4_sharding": op4_sharding,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_lm_score": op6_lm_score,
    "op7_pii": op7_pii,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_topk": op10_topk,
    "op11_lexical_search": op11_lexical_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_secret_scan": op13_secret_scan,
}
