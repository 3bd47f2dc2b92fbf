"""From documents to packed training sequences: language, near-duplicates, secrets, source mix, packing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import language, mixing, near_dedup, packing, queries, secrets
from tidemark.llm.common import remainder, table
from tidemark.session import run_folder

PLACE = "mix_place"


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a determined language (null, or no letter) go."""
    return language.accepted(docs, remainder(F.col("doc_id"), 4) == 2)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group within 2 of 64 bits over shingles of 3 words."""
    return near_dedup.unique(docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are masked; every document stays."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture.

    Target weights are the sources' shares of the bytes to the power mixing.TEMPER. A source that runs out leaves its
    turns to the others, so what a hot source has beyond its weight comes last and nothing is dropped.
    """
    return mixing.in_order(docs)


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with PLACE, a number that grows in the order their rows were written in: by part, file of it and row."""
    try:
        named = docs.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:  # not read from files
        return docs.withColumn(PLACE, F.monotonically_increasing_id())
    part, nth = (F.coalesce(F.try_to_number(F.regexp_extract("_file", p, 1), F.lit("9" * 9)).cast("long"), F.lit(0)) for p in (r"^part-(\d+)", r"c(\d+)\."))
    return named.withColumn(PLACE, F.shiftleft(F.shiftleft(part, 12) + nth, 32) + F.col("_row")).drop("_file", "_row")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their place in a sequence; the sequences are numbered in the order of the mixture."""
    return queries.packed(placed(docs), PLACE).drop(PLACE)


STAGES = [
    ("language_id", identified),
    ("simhash_near_dedup", deduplicated),
    ("secret_scan", redacted),
    ("mix_sources", mixed),
    ("best_fit_packing", packed),
]

ORACLE_SQL = None  # suffix automata, XXH64 votes and byte-pair merges are beyond SQL; tests/llm checks each stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = run_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
