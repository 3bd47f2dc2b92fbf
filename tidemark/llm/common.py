"""Helpers that several of the training-data operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

WHITE = " \t\n\x0b\x0c\r"
TEXTS_PER_BATCH = 100
ROWS_PER_BUCKET = 2_000
LOW = 0xFFFFFFFF


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker holds at once: rows are whole texts, and Spark's usual 10,000 of them are too many."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > TEXTS_PER_BATCH:
        spark.conf.set(name, TEXTS_PER_BATCH)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def words(text: Column) -> Column:
    """Runs of characters other than blank and U+0009..U+000D; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed != "", F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; other letters stay. Pure ASCII texts take the short way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def remainder(doc_id: Column, base: int) -> Column:
    """crc32 of the id's decimal text modulo ``base``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % base


def shingle_rows(size: int, columns: Sequence[str], array: str) -> list[Column]:
    """``columns`` and one row per run of ``size`` words as w0, w1, ...

    A shorter sequence gives one row with nulls at its end, an empty one a row of nulls.
    """
    n = F.greatest(F.size(array) - (size - 1), F.lit(1))
    shifted = [F.slice(array, k + 1, n).alias(f"w{k}") for k in range(size)]
    return [*map(F.col, columns), F.inline_outer(F.arrays_zip(*shifted))]


def vote_sums(hashed: Column, prefix: str, weight: Column | None = None) -> list[Column]:
    """32 sums that hold the number of set bits at each of 64 places, two places to a sum.

    A half has 32 bits, more than the words a single string can have, so none overflows.
    """
    lanes = [F.shiftrightunsigned(hashed, j).bitwiseAND(F.lit(0x0000000100000001)) for j in range(32)]
    return [F.sum(x if weight is None else x * weight).alias(f"{prefix}{j}") for j, x in enumerate(lanes)]


def majority(prefix: str, total: Column) -> Column:
    """64 bits, each set where over half of ``total`` votes were; zero without votes."""
    bits = None
    for j in range(64):
        s = F.col(f"{prefix}{j % 32}")
        votes = s.bitwiseAND(F.lit(LOW)) if j < 32 else F.shiftrightunsigned(s, 32)
        value = (1 << j) if j < 63 else -(1 << 63)
        bit = F.when(votes * 2 > total, F.lit(value).cast("long")).otherwise(F.lit(0).cast("long"))
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return bits


def hex64(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def ranked(df: DataFrame, group: str, unit: Column, order: Sequence[Column], out: str, small_groups: bool) -> DataFrame:
    """``df`` with ``out``: the gapless position (from 0) of each row in its group, by ``unit`` and then ``order``.

    ``unit`` is a hash in [0, 1). Each group is cut into as many ranges of it as its rows ask for, so a
    group with a third of all rows is ranked by many tasks; only counts per range are added up in one place.
    ``small_groups``: the number of groups has a fixed bound, so the table of counts is broadcast.
    """
    hint = F.broadcast if small_groups else (lambda x: x)
    named = df.withColumn("_g", F.col(group)).withColumn("_u", unit)
    parts = named.groupBy("_g").agg(F.ceil(F.count("*") / ROWS_PER_BUCKET).alias("_n"))
    cut = named.join(hint(parts.withColumnRenamed("_g", "_gp")), F.col("_g").eqNullSafe(F.col("_gp"))).drop("_gp")
    cut = cut.withColumn("_b", F.floor(F.col("_u") * F.col("_n"))).drop("_n")
    before = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy("_g", "_b").agg(F.count("*").alias("_c"))
    offsets = offsets.select(
        F.col("_g").alias("_go"), F.col("_b").alias("_bo"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_g", "_b").orderBy("_u", *order)
    numbered = cut.withColumn("_r", F.row_number().over(inside) - 1)
    joined = numbered.join(offsets, F.col("_g").eqNullSafe(F.col("_go")) & (F.col("_b") == F.col("_bo")))
    return joined.withColumn(out, (F.col("_before") + F.col("_r")).cast("long")).drop(
        "_g", "_u", "_b", "_r", "_go", "_bo", "_before"
    )


def unit_hash(*columns: Column) -> Column:
    """A number in [0, 1) from the 52 upper bits of a hash."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 12) / F.lit(float(1 << 52))
