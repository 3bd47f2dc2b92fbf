"""Plans that have to hold at scale."""

import pytest
from conftest import optimized, plan_of
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.operators import entities as en, ingest as ing, vectors as ve, words as wd
from tidemark.plans import registry
from tidemark.session import estimated_bytes, shared_folder, spread
from tidemark.sources import tables, writers

registry.load_all()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


# Queries that only return a plan; the others run jobs or streams while they are built.
LAZY = sorted(q for q in registry.SQL if not q.startswith("stream_") and q not in ("incremental_copy", "thread_flatten"))


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, data, name):
    plan = plan_of(registry.QUERIES[name](spark, data))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "ArrowEvalPython"):
        assert operator not in plan, operator


@pytest.mark.parametrize("name", [q for q in LAZY if q not in ("replay_order",)])
def test_no_window_over_the_whole_table(spark, data, name):
    for line in plan_of(registry.QUERIES[name](spark, data)).splitlines():
        if "Window [" in line:
            assert line.count("], [") >= 2, line  # functions, partition keys, order


def test_time_range_reaches_the_scan(spark, data):
    plan = plan_of(registry.QUERIES["range_scan"](spark, data))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


@pytest.mark.parametrize("name", ["company_sentiment_daily", "company_sentiment_sliding", "post_sentiment_orgs"])
def test_reports_read_stored_rows(spark, data, name):
    """The range reaches the scan of the stored times; no text is read, and no row is shuffled by its id."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(registry.QUERIES[name](spark, data))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "GreaterThanOrEqual(created_utc" in plan and "LessThan(created_utc" in plan
    assert "text:string" not in plan and "documents.parquet" not in plan
    assert "hashpartitioning(id" not in plan and "SortMergeJoin" in plan


def test_rollup_moves_no_text(spark, data, no_broadcast):
    """Texts are scored before the join: at scale (no spreading) no exchange carries them."""
    docs = tables.load_table(spark, data, "documents").select("doc_id", "text")
    pairs = docs.select("doc_id", F.explode(en.orgs(F.col("text"))).alias("company"))
    joined = pairs.join(tables.post_times(spark, data).withColumnRenamed("id", "doc_id"), "doc_id")
    plan = plan_of(joined)
    assert plan.index("Exchange") < plan.index("Generate")
    assert plan.count("split(lower(") == 1


def test_large_input_is_not_spread(spark, data):
    docs = tables.load_table(spark, data, "documents")
    assert "Repartition" in optimized(spread(docs, "doc_id"))
    big = spark.range(10**10).withColumn("doc_id", F.col("id"))
    assert "Repartition" not in optimized(spread(big, "doc_id"))
    assert estimated_bytes(docs) > 0


def test_texts_are_tokenized_once(spark, data):
    docs = tables.load_table(spark, data, "documents")
    for df in (wd.word_count(docs, F.col("text")), en.docs_with_orgs(docs, "doc_id", F.col("text"))):
        assert plan_of(df).count("split(lower(") == 1


def test_word_count_has_one_shuffle_after_partial_counts(spark, data):
    plan = plan_of(wd.word_count(tables.load_table(spark, data, "documents"), F.col("text")))
    assert plan.count("Exchange") == 1 and "partial_count" in plan


def test_time_series_adds_no_shuffle_to_a_table_hashed_by_id(spark, data):
    docs = tables.load_table(spark, data, "documents").select("doc_id", "text").repartition(8, "doc_id")
    assert plan_of(wd.word_time_series(docs, F.col("text"), "doc_id")).count("Exchange") == 1


def test_time_series_moves_texts_once_and_no_words(spark, data, no_broadcast):
    plan = plan_of(registry.QUERIES["word_time_series"](spark, data))
    assert plan.count("Exchange hashpartitioning") == 2 and "word#" not in "".join(line for line in plan.split("\n") if "Exchange" in line)


@pytest.mark.parametrize("name", ["related_words_topk", "cluster_top_words"])
def test_top_k_is_cut_before_the_shuffle(spark, data, name):
    plan = plan_of(registry.QUERIES[name](spark, data))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_words_do_not_sort_everything(spark, data):
    assert "TakeOrderedAndProject" in plan_of(registry.QUERIES["top_words"](spark, data))


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, no_broadcast):
    for name in ("b_posts", "b_scores"):
        writers.write_bucketed(spark.range(1000).withColumn(name, F.col("id")), name, "id", 4, str(tmp_path / name))
    joined = spark.table("b_posts").join(spark.table("b_scores"), "id")
    assert "Exchange" not in plan_of(joined) and joined.count() == 1000
    for name in ("b_posts", "b_scores"):
        spark.sql(f"DROP TABLE {name}")


def test_incremental_copy_is_an_anti_join(spark, data):
    docs = tables.load_table(spark, data, "documents").select("doc_id")
    assert "LeftAnti" in plan_of(ing.new_rows(docs, tables.load_table(spark, data, "labels"), "doc_id"))


def test_counts_are_taken_before_the_join(spark, data, no_broadcast):
    plan = plan_of(registry.QUERIES["post_comments"](spark, data))
    assert "partial_count" in plan


def test_too_many_keywords_are_refused(spark, data):
    with pytest.raises(ValueError):
        ve.query_vectors(tables.load_table(spark, data, "embeddings"), "vec_id", "embedding", list(range(1000)))


def test_shared_folder_is_the_sessions(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (configured or spark.sparkContext.getCheckpointDir())


def test_cleaning_stays_in_generated_code(spark, data):
    plan = plan_of(tables.load_table(spark, data, "documents").select(tx.clean_text(F.col("text"))))
    assert "regexp_replace" in plan and "Python" not in plan
