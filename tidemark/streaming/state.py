"""Stateful stream operators: running counts, windowed company sentiment, deduplication."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import company as co, words as wd

DELAY = "1 day"  # rows later than this are dropped, and state older than this is released
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep large state on disk instead of the executor heap; for sessions the caller owns."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """The same for the streams started in the block; the caller's setting comes back after it."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    use_rocksdb(spark)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def running_word_count(stream: DataFrame, text: Column) -> DataFrame:
    """(word, count) over everything seen. State grows with the vocabulary, not with the records."""
    return wd.word_count(stream, text)


def dedup(stream: DataFrame, key: str, ts: str, delay: str = DELAY) -> DataFrame:
    """One row per key; a repeat is recognised within the delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def company_windows(pairs: DataFrame, ts: str, width: str = "1 minute", slide: str | None = None, delay: str = DELAY) -> DataFrame:
    """Mean scores per company and event-time window, labelled by the window's end."""
    return _rolled(pairs.withWatermark(ts, delay), ts, width, slide)


def _rolled(pairs: DataFrame, ts: str, width: str, slide: str | None) -> DataFrame:
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    sums = [F.sum(c).alias(c) for c in co.LABELS] + [F.count(F.lit(1)).alias("count")]
    rolled = pairs.groupBy(window.alias("window"), "company").agg(*sums)
    means = [(F.col(c) / F.col("count")).alias(c) for c in co.LABELS]
    return rolled.select("company", F.col("window.end").alias("window_end"), *means, "count")


def write_updates(
    changed: DataFrame, folder: str, checkpoint: str, mode: str = "update", every: str | None = None
) -> StreamingQuery:
    """Write the changed keys of every micro-batch to its own sub-folder (overwritten on a repeat)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        changed.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def latest(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """The last written value of every key, as an aggregate (no sort per key)."""
    updates = spark.read.parquet(folder)
    values = [c for c in updates.columns if c not in (*keys, "batch_id")]
    newest = updates.groupBy(*keys).agg(F.max(F.struct("batch_id", *values)).alias("newest"))
    return newest.select(*keys, *[F.col(f"newest.{v}").alias(v) for v in values])
