"""Table access by name, and the logical views built from the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.functions import ids
from tidemark.session import spread


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazy scan of a stored table; an unknown name raises KeyError."""
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{root}/{name}.parquet")


def load_external(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """Table at another endpoint (jdbc, mongodb, ...) through its Spark connector.

    Addresses and credentials come from the caller's configuration only.
    """
    return spark.read.format(fmt).options(**options).load()


def post_times(spark: SparkSession, root: str, before: Column | None = None) -> DataFrame:
    """(id, created_utc): ten events belong to a post, and the first of them tells when it was made.

    ``before``: only posts made before it; later events cannot be their first, so the scan skips them.
    """
    events = load_table(spark, root, "events")
    if before is not None:
        events = events.where(F.col("ts") < before)
    return events.groupBy(F.expr("event_id DIV 10").alias("id")).agg(F.min("ts").alias("created_utc"))


def posts(spark: SparkSession, root: str) -> DataFrame:
    """posts(id, body, author, subreddit, created_utc)."""
    documents = spread(load_table(spark, root, "documents"), "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("body"),
        F.col("source").alias("author"),
        F.col("lang").alias("subreddit"),
    )
    return documents.join(post_times(spark, root), "id")


def comments(spark: SparkSession, root: str) -> DataFrame:
    """comments(id, link_id, parent_id, author, body, turn); a first turn answers the post."""
    c = load_table(spark, root, "conversations")
    link = F.concat(F.lit(ids.SUBMISSION_PREFIX), F.col("conv_id"))
    return c.select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        link.alias("link_id"),
        F.when(F.col("turn") > 0, F.concat_ws("-", "conv_id", F.col("turn") - 1)).otherwise(link).alias("parent_id"),
        F.col("role").alias("author"),
        F.col("text").alias("body"),
        "conv_id",
        "turn",
    )
