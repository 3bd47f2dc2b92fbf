"""Sentiment rolled up per company, over everything or over day intervals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import ids
from tidemark.functions.scores import normalized_score

LABELS = ("positive", "negative", "neutral")


def join_posts_scores_orgs(posts: DataFrame, scores: DataFrame, orgs: DataFrame, key: str = "id") -> DataFrame:
    """Posts that have both a score and an organisation list, joined by id.

    Ids are unique in all three tables. Tables written bucketed by id join without a shuffle.
    """
    return posts.join(scores, key).join(orgs, key)


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in LABELS] + [F.count(F.lit(1)).alias("count")]


def _averages(sums: DataFrame, *keys: str) -> DataFrame:
    means = {c: F.col(c) / F.col("count") for c in LABELS}
    score = normalized_score(means["positive"], means["negative"])
    return sums.select(*keys, *[m.alias(c) for c, m in means.items()], score.alias("normalize_score"), "count")


def company_sentiment(scored: DataFrame, orgs: Column) -> DataFrame:
    """Mean scores, normalised score and count per company; a (text, company) pair counts once."""
    pairs = scored.select(F.explode(orgs).alias("company"), *LABELS)
    return _averages(pairs.groupBy("company").agg(*_sums()), "company")


def company_sentiment_batch(scored: DataFrame, orgs: Column) -> DataFrame:
    """Mean scores per company only, as used on a micro-batch."""
    return company_sentiment(scored, orgs).select("company", *LABELS)


def in_label_range(ts: Column, start: datetime, end: datetime, days: int) -> Column:
    """Rows that can fall under a label in [start, end); compares the bare column, so it is pushed down."""
    low = ids.moment(start) - F.expr(f"INTERVAL {int(days)} DAYS")
    high = ids.moment(end) - F.expr("INTERVAL 1 DAYS")
    return (ts >= low) & (ts < high)


def company_sentiment_by_interval(
    pairs: DataFrame, ts: str, start: datetime, end: datetime, days: int = 1
) -> DataFrame:
    """Roll up (company, scores, ts) rows over [d - days, d) for every day d in [start, end).

    All intervals are computed in one job. Rows are summed per day first; only the daily
    sums are copied to the ``days`` labels they belong to, so a long interval does not
    multiply the input rows. Empty intervals give no row.
    """
    daily = (
        pairs.where(in_label_range(F.col(ts), start, end, days))
        .groupBy("company", F.date_add(F.col(ts).cast("date"), 1).alias("label"))
        .agg(*_sums())
    )
    if days > 1:
        spread = F.explode(F.sequence(F.col("label"), F.date_add("label", days - 1)))
        daily = (
            daily.select("company", spread.alias("label"), *LABELS, "count")
            .groupBy("company", "label")
            .agg(*[F.sum(c).alias(c) for c in LABELS], F.sum("count").alias("count"))
        )
    wanted = (F.col("label") >= ids.moment(start).cast("date")) & (F.col("label") < ids.moment(end).cast("date"))
    rolled = _averages(daily.where(wanted), "company", "label")
    stamp = F.col("label").cast("timestamp_ntz")
    return rolled.withColumn("utc_interval_date", stamp).withColumn("utc_timestamp", ids.epoch_seconds(stamp)).drop("label")
