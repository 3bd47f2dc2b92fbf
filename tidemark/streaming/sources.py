"""Stream sources. Everything downstream takes a DataFrame, so it does not matter which one feeds it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas


def topic_options(servers: str, topic: str, partition: int | None = None, starting: str = "latest") -> dict[str, str]:
    """Options of the Kafka source: one partition is assigned, or the whole topic subscribed."""
    chosen = {"subscribe": topic} if partition is None else {"assign": json.dumps({topic: [partition]})}
    return {"kafka.bootstrap.servers": servers, "startingOffsets": starting, **chosen}


def topic_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Topic rows with key and value as text; needs Spark's Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**options).load()
    texts = [F.col(c).cast("string").alias(c) for c in ("key", "value")]
    return raw.select(*texts, "topic", "partition", "offset", "timestamp")


def landed_stream(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Files landed in a folder, oldest first, ``max_files`` per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def parse_records(envelope: DataFrame) -> DataFrame:
    """Envelope -> stream records. Replayed messages name their text ``message``."""
    parsed = envelope.select(F.from_json("value", schemas.STREAM_RECORD).alias("record")).select("record.*")
    return parsed.withColumn("raw_text", F.coalesce("raw_text", "message")).drop("message")


def subreddit_stream(records: DataFrame, subreddit: str) -> DataFrame:
    return records.where(F.col("subreddit") == subreddit)
