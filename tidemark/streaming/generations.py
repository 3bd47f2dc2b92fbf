"""Keyed results of a stream as generations: a base with every key, and the updates of a few batches after it.

Layout of a folder: ``tail/gen=G/batch_id=N`` holds the changed keys of batch N, G being N // ``span``; ``base/gen=G`` holds
the last value of every key before generation G; ``manifest`` gets one row for every complete base. A base is
written when the first batch of its generation arrives and before that batch is, so a reader needs the newest base of the
manifest and at most ``span`` batches beside it, however long the stream has run. Whatever fails between two steps leaves
the manifest as it was: readers go on with the generation before, and the repeated batch writes the base anew.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

SPAN = 16
MANIFEST = "gen BIGINT"


def _optional(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def newest_generation(spark: SparkSession, folder: str) -> int:
    """The generation whose base was completed last; 0, which needs no base, if there is none."""
    listed = _optional(spark, f"{folder}/manifest", MANIFEST)
    return 0 if listed is None else listed.agg(F.max("gen")).first()[0] or 0


def _parts(spark: SparkSession, folder: str, gen: int) -> list[DataFrame]:
    base = spark.read.parquet(f"{folder}/base/gen={gen}") if gen else None
    tail = _optional(spark, f"{folder}/tail/gen={gen}")
    return [part.withColumn("batch_id", F.col("batch_id").cast("bigint")) for part in (base, tail) if part is not None]


def _newest(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    last = rows.groupBy(*keys).agg(F.max(F.struct("batch_id", *values)).alias("_last"))
    return last.select(*keys, *[F.col("_last")[v].alias(v) for v in values], F.col("_last")["batch_id"].alias("batch_id"))


def latest(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """The last written value of every key, from one base and the batches of one generation."""
    parts = _parts(spark, folder, newest_generation(spark, folder))
    if not parts:
        raise ValueError(f"no batch has been written to {folder}")
    return _newest(parts, keys).drop("batch_id")


def compact(spark: SparkSession, folder: str, keys: list[str], gen: int) -> None:
    """Write the base of generation ``gen`` and name it in the manifest, unless that is done already."""
    before = newest_generation(spark, folder)
    if before >= gen:
        return
    parts = _parts(spark, folder, before)
    if not parts:  # nothing was written yet, so there is no state to keep
        return
    _newest(parts, keys).write.mode("overwrite").parquet(f"{folder}/base/gen={gen}")
    spark.createDataFrame([(gen,)], MANIFEST).coalesce(1).write.mode("append").parquet(f"{folder}/manifest")


def write(
    changed: DataFrame, folder: str, checkpoint: str, keys: list[str], span: int = SPAN, every: str | None = None
) -> StreamingQuery:
    """Write the changed ``keys`` of every micro-batch; ``every=None`` processes what is there and stops.

    A repeated batch overwrites its own folder. ``span`` belongs to the folder and must stay the same over restarts.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        gen = batch_id // span
        if gen:
            compact(batch.sparkSession, folder, keys, gen)
        current = newest_generation(batch.sparkSession, folder)
        batch.write.mode("overwrite").parquet(f"{folder}/tail/gen={current}/batch_id={batch_id}")

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        changed.writeStream.outputMode("update")
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
