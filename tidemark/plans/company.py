"""Company sentiment queries."""

from __future__ import annotations

import hashlib
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import ids
from tidemark.operators import company as co, enrichment as er, entities as en, ingest as ing, sentiment as st
from tidemark.plans import snippets as sq
from tidemark.plans.registry import query
from tidemark.plans.words import _documents
from tidemark.sources import tables

START, END = datetime(2024, 1, 1), datetime(2024, 2, 1)


def _rounded(df: DataFrame) -> DataFrame:
    scores = [c for c in (*co.LABELS, "normalize_score") if c in df.columns]
    return df.withColumns({c: F.round(c, 6) for c in scores})


def _scored(spark: SparkSession, root: str) -> DataFrame:
    return st.score_sentiment(_documents(spark, root, "text"), F.col("text"))


@query("company_sentiment", f"SELECT company, {sq.ROLLUP} FROM ({sq.PAIRS}) GROUP BY company")
def company_sentiment(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(co.company_sentiment(_scored(spark, root), en.orgs(F.col("text"))))


@query(
    "company_sentiment_batch",
    f"""SELECT company, round(avg(positive), 6) AS positive, round(avg(negative), 6) AS negative,
    round(avg(neutral), 6) AS neutral FROM ({sq.PAIRS}) GROUP BY company""",
)
def company_sentiment_batch(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(co.company_sentiment_batch(_scored(spark, root), en.orgs(F.col("text"))))


def _table(kind: str, root: str) -> str:
    return f"tidemark_{kind}_{hashlib.sha256(root.encode()).hexdigest()[:16]}"


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored_scores(spark: SparkSession, root: str) -> DataFrame:
    """(id, negative, neutral, positive, orgs, text_md5) of every document: each text is read once, when it is new."""

    def enrich(documents: DataFrame) -> DataFrame:
        scored = st.score_sentiment(documents, F.col("text"))
        return scored.select("id", *co.LABELS, en.orgs(F.col("text")).alias("orgs"), F.md5("text").alias("text_md5"))

    documents = _documents(spark, root, "text").withColumnRenamed("doc_id", "id")
    return er.stored(spark, _table("scores", root), "id", documents, enrich, _buckets(spark))


def stored_times(spark: SparkSession, root: str) -> DataFrame:
    """(id, created_utc) of every post."""
    return er.stored(spark, _table("times", root), "id", tables.post_times(spark, root), lambda new: new, _buckets(spark))


def org_pairs(spark: SparkSession, root: str, start: datetime, end: datetime) -> DataFrame:
    """(company, scores, created_utc) of the posts in [start, end): stored rows, joined bucket by bucket."""
    times = ing.time_range(stored_times(spark, root), "created_utc", ids.moment(start), ids.moment(end))
    return stored_scores(spark, root).join(times, "id").select(F.explode("orgs").alias("company"), *co.LABELS, "created_utc")


def _interval_sql(days: int) -> str:
    return f"""
    SELECT company, {sq.ROLLUP}, label AS utc_interval_date, epoch(label)::DOUBLE AS utc_timestamp
    FROM (
      SELECT p.*, unnest([date_trunc('day', t.created_utc) + to_days(i) FOR i IN range(1, {days} + 1)])::TIMESTAMP AS label
      FROM ({sq.PAIRS}) p JOIN ({sq.POST_TIMES}) t ON p.doc_id = t.doc_id)
    WHERE label >= TIMESTAMP '2024-01-01' AND label < TIMESTAMP '2024-02-01'
    GROUP BY company, label"""


@query("company_sentiment_daily", _interval_sql(1))
def company_sentiment_daily(spark: SparkSession, root: str) -> DataFrame:
    pairs = org_pairs(spark, root, START - timedelta(days=1), END)
    return _rounded(co.company_sentiment_by_interval(pairs, "created_utc", START, END))


@query("company_sentiment_sliding", _interval_sql(3))
def company_sentiment_sliding(spark: SparkSession, root: str) -> DataFrame:
    pairs = org_pairs(spark, root, START - timedelta(days=3), END)
    return _rounded(co.company_sentiment_by_interval(pairs, "created_utc", START, END, days=3))


@query(
    "post_sentiment_orgs",
    f"""SELECT d.doc_id AS id, t.created_utc, md5(d.text) AS text_md5, round(s.negative, 6) AS negative,
      round(s.neutral, 6) AS neutral, round(s.positive, 6) AS positive, coalesce(o.orgs, '') AS orgs
    FROM documents d JOIN ({sq.POST_TIMES}) t ON d.doc_id = t.doc_id JOIN ({sq.SCORES}) s ON s.doc_id = d.doc_id
    LEFT JOIN (SELECT doc_id, string_agg(DISTINCT org, ',' ORDER BY org) AS orgs FROM ({sq.MENTIONS}) GROUP BY doc_id) o
      ON o.doc_id = d.doc_id
    WHERE t.created_utc >= TIMESTAMP '2024-01-01' AND t.created_utc < TIMESTAMP '2024-02-01'""",
)
def post_sentiment_orgs(spark: SparkSession, root: str) -> DataFrame:
    """Posts of a time range, their score record and their organisation record, joined by id."""
    posts = ing.time_range(stored_times(spark, root), "created_utc", ids.moment(START), ids.moment(END))
    found = F.array_join(F.array_sort("orgs"), ",").alias("orgs")
    scores = stored_scores(spark, root).select("id", "text_md5", *[F.round(c, 6).alias(c) for c in co.LABELS], found)
    return posts.join(scores, "id")
