"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlens.llm import decontaminate, near_dup, quality_rules, sentencepiece_bpe, suffix_dedup
from shiftlens.llm.queries import piece_model
from shiftlens.llm.text import shared_folder

#: Bytes that make a repeated passage: below those of fifty words of four letters.
PASSAGE_BYTES = 200


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 80 %)."""
    return near_dup.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occur elsewhere; ``n_chars`` counts what is left."""
    left = suffix_dedup.without_repeats(docs, PASSAGE_BYTES)
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``ids`` and ``n_tokens``, and ``round_trip``: whether decoding gives the text again.

    Columns of these names that the documents had are replaced.
    """
    coded = sentencepiece_bpe.encode_and_decode(docs, piece_model(), keep_row=True)
    own = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in ("ids", "n_tokens", "round_trip")]
    return coded.select(
        *own, "ids", F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("row.text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("decontamination", benchmark_leaks),
    ("sentencepiece", encoded),
]
#: SQL can't express the encoder. Tests hold the operators against brute force one by one, and three stages in a row, not the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
