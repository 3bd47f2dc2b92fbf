"""Scores and organisation lists computed once per record and stored; reports read the stored rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.ingest import new_rows
from tidemark.session import run_folder
from tidemark.sources.writers import write_bucketed


def stored(
    spark: SparkSession, table: str, key: str, source: DataFrame, enrich: Callable[[DataFrame], DataFrame], buckets: int
) -> DataFrame:
    """Table ``table`` with the enriched row of every key of ``source``; only keys it lacks are enriched.

    The rows are stored hashed and sorted by ``key`` in ``buckets`` files a run, so tables with equally many buckets
    join without a shuffle. Which keys are new is found from the keys alone; other columns, such as whole texts, are
    only read for these. Keys are unique and not null. Spark commits an append as a whole, so after a failure the next
    call finds the same keys missing. The files lie in the shared folder.
    """
    if not spark.catalog.tableExists(table):
        write_bucketed(enrich(source), table, key, buckets, run_folder(spark, table))
        return spark.table(table)
    fresh = new_rows(source.select(key), spark.table(table), key)
    if not fresh.isEmpty():
        write_bucketed(enrich(source.join(fresh, key, "left_semi")), table, key, buckets, mode="append")
        spark.catalog.refreshTable(table)
    return spark.table(table)
