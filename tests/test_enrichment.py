"""Stored enrichment: each record once, later runs only the new ones."""

from pyspark.sql import functions as F

from tidemark.operators import enrichment as er


def test_only_new_keys_are_enriched(spark):
    seen = []

    def enrich(df):
        rows = [r["id"] for r in df.select("id").collect()]
        seen.append(sorted(rows))
        return df.select("id", F.upper("text").alias("loud"), F.lit(len(seen)).alias("run"))

    landed = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "id long, text string")
    first = er.stored(spark, "enriched_test", "id", landed.where("id < 12"), enrich, 4)
    assert first.count() == 12
    assert er.stored(spark, "enriched_test", "id", landed.where("id < 12"), enrich, 4).count() == 12
    rows = er.stored(spark, "enriched_test", "id", landed, enrich, 4).collect()
    assert sorted((r["id"], r["loud"], r["run"]) for r in rows) == [(i, f"T{i}", 1 if i < 12 else 2) for i in range(20)]
    assert seen == [list(range(12)), list(range(12, 20))]
    spark.sql("DROP TABLE enriched_test")
