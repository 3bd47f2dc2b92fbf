"""Micro-batch layers: words, raw records, sentiment and companies from the same batch.

Every layer writes batch N to the sub-folder ``batch_id=N`` and overwrites it, so a batch that
is repeated after a failure leaves the same rows once.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import company as co, entities as en, ingest as ing, sentiment as st, words as wd

SERIES, DELTAS, BASE, RAW, SENTIMENT, COMPANY, FIRST = (
    "time_series", "word_deltas", "word_base", "raw", "sentiment", "company", "first"
)


def write_batch(df: DataFrame, folder: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def word_layer(batch: DataFrame, now: float, folder: str, batch_id: int) -> None:
    """Word counts per record as a time series, and their sum as the batch's change to the totals."""
    series = wd.word_time_series(batch, F.col("raw_text"), "comment_id").withColumn("timestamp", F.lit(now))
    write_batch(series, f"{folder}/{SERIES}", batch_id)
    # Summed from what was just written, so the texts are not taken apart a second time.
    written = batch.sparkSession.read.parquet(f"{folder}/{SERIES}/batch_id={batch_id}")
    totals = written.groupBy("word").agg(F.sum("count").alias("count"), F.max("timestamp").alias("timestamp"))
    write_batch(totals, f"{folder}/{DELTAS}", batch_id)


def raw_layer(batch: DataFrame, now: float, folder: str, batch_id: int) -> None:
    write_batch(batch.withColumn("insert_time", F.lit(now)), f"{folder}/{RAW}", batch_id)


def sentiment_layer(batch: DataFrame, now: float, folder: str, batch_id: int) -> None:
    scored = st.score_sentiment(batch, F.col("raw_text")).withColumn("inserted_at", F.lit(now))
    write_batch(scored, f"{folder}/{SENTIMENT}", batch_id)


def company_layer(batch: DataFrame, now: float, folder: str, batch_id: int) -> None:
    scored = st.score_sentiment(batch, F.col("raw_text"))
    write_batch(co.company_sentiment_batch(scored, en.orgs(F.col("raw_text"))), f"{folder}/{COMPANY}", batch_id)


LAYERS = (word_layer, raw_layer, sentiment_layer, company_layer)


def run_layers(
    records: DataFrame,
    folder: str,
    checkpoint: str,
    layers: tuple = LAYERS,
    every: str | None = "60 seconds",
    clock: Callable[[], float] = time.time,
) -> StreamingQuery:
    """Feed every micro-batch to all layers. ``every=None`` processes what is there and stops.

    The batch is read once and kept while the layers use it; an empty batch is skipped. All rows
    of a batch carry the same time.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                now = clock()
                for layer in layers:
                    layer(batch, now, folder, batch_id)
        finally:
            batch.unpersist()

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return records.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def word_frequency(spark: SparkSession, folder: str) -> DataFrame:
    """(word, count, timestamp): the running totals, as the last base plus the changes after it."""
    deltas = spark.read.parquet(f"{folder}/{DELTAS}")
    newest = _last_base(spark, folder)
    if newest is None:
        return wd.upsert_counts(deltas.drop("batch_id").limit(0), deltas.drop("batch_id"))
    base = spark.read.parquet(f"{folder}/{BASE}").where(F.col("up_to") == newest).drop("up_to")
    return wd.upsert_counts(base, deltas.where(F.col("batch_id") > newest).drop("batch_id"))


def compact_word_frequency(spark: SparkSession, folder: str, up_to: int) -> None:
    """Fold all changes up to a batch into a new base, so that reading stays cheap.

    The old base and the folded changes stay until an operator removes them; readers pick the
    newest complete base, so a failed compaction changes nothing.
    """
    deltas = spark.read.parquet(f"{folder}/{DELTAS}").where(F.col("batch_id") <= up_to)
    newest = _last_base(spark, folder)
    if newest is not None and newest >= up_to:
        return
    state = deltas.drop("batch_id")
    if newest is not None:
        base = spark.read.parquet(f"{folder}/{BASE}").where(F.col("up_to") == newest).drop("up_to")
        state = base.unionByName(deltas.where(F.col("batch_id") > newest).drop("batch_id"))
    merged = wd.upsert_counts(state.limit(0), state)
    merged.write.mode("overwrite").parquet(f"{folder}/{BASE}/up_to={up_to}")


def _last_base(spark: SparkSession, folder: str) -> int | None:
    try:
        return spark.read.parquet(f"{folder}/{BASE}").agg(F.max("up_to")).first()[0]
    except Exception as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise


def first_records(envelope: DataFrame, folder: str, checkpoint: str, every: str | None = "60 seconds") -> StreamingQuery:
    """The first record of every topic partition in each micro-batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            first = ing.first_per_partition(batch, ["topic", "partition"], ["offset"], ["key", "value"])
            write_batch(first, f"{folder}/{FIRST}", batch_id)

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return envelope.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger).start()
