"""Label maps: index -> label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated file; lines without a label are skipped."""
    return spark.read.csv(path, sep="\t", schema=schemas.LABEL_MAP).where(F.col("label").isNotNull())


def label_map(spark: SparkSession, labels: Sequence[str]) -> DataFrame:
    """A built-in map as a table of (id, label)."""
    rows = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(label).alias("label")) for i, label in enumerate(labels)])
    return spark.range(1).select(F.inline(rows))
