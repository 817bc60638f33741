"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlens.llm import chat, decontaminate, hard_negatives, near_dup, quality_rules, rule_ensemble, sentencepiece_bpe, sharding, substring_dedup, suffix_dedup, suffix_tree_lm, token_counts, vector_codes
from shiftlens.llm.text import stored
from shiftlens.operators.joins import sized_join

SHARDS = 24
#: A conversation whose texts hold template strings.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def id_checksum() -> Column:
    """The fold of a document: CRC-32 of its id as text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({c}L, {t}L, '{r}', '{x}')" for c, t, r, x in PROBE) + " AS probe(conv_id, turn, role, text)")
    messages = chat.fold_events(chat.table_events(logs.union(probe)))
    return chat.digest(chat.parse(chat.render(messages)))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"), length=400)
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept"),  # characters of which a part stays are shown as U+FFFD
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("distance")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_checksum() % 3 == 1
    scored, _ = rule_ensemble.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out)
    return scored


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_bpe.encode_and_decode(table(spark, sf_dir, "documents"), piece_model(), packed=True)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "agrees",
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_checksum() % 5 == 1
    return suffix_tree_lm.score_texts(table(spark, sf_dir, "documents"), held_out)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), SHARDS)
    return placed.selectExpr("doc_id", "size", "text_crc32", "'rows' AS law", "shard", "slot", "CAST(NULL AS INT) AS grown_shard", "moved")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("broken")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), piece_model())


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), near_dup.Scheme(shingle_words=2))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.first_copies(table(spark, sf_dir, "documents"), window=50)
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["after"] - s["first"])
    return left.select("doc_id", "n_words", removed.cast("long").alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"), "kept")


def op12_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    coded = stored(coded)
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    components = ",".join(map(str, codebooks.ravel().tolist()))
    return sized_join(coded, by_label, "label", null_safe=True).select(
        F.col("key").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(hashlib.sha256(components.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_formatting": op1_chat_formatting,
        "op2_suffix_array_dedup": op2_suffix_array_dedup,
        "op3_decontamination": op3_decontamination,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_lm_scoring": op6_lm_scoring,
        "op7_sharding": op7_sharding,
        "op8_quality_rules": op8_quality_rules,
        "op9_token_counts": op9_token_counts,
        "op10_minhash_near_dedup": op10_minhash_near_dedup,
        "op11_substring_dedup": op11_substring_dedup,
        "op12_vector_code_compression": op12_vector_code_compression,
        "op13_hard_negatives": op13_hard_negatives,
    }
