from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import company as co

PAIRS = "company string, positive double, negative double, neutral double, at string"


def pairs(spark, rows):
    return spark.createDataFrame(rows, PAIRS).withColumn("ts", F.col("at").cast("timestamp_ntz")).drop("at")


def test_one_count_per_text_and_company(spark):
    df = spark.createDataFrame([(["x", "y"], 0.6, 0.2, 0.2), (["x"], 0.2, 0.2, 0.6), ([], 1.0, 0.0, 0.0)], "orgs array<string>, positive double, negative double, neutral double")
    got = {r["company"]: r for r in co.company_sentiment(df, F.col("orgs")).collect()}
    assert got["x"]["count"] == 2 and got["y"]["count"] == 1
    assert got["x"]["positive"] == pytest.approx(0.4) and got["x"]["normalize_score"] == pytest.approx(0.6)
    assert "count" not in co.company_sentiment_batch(df, F.col("orgs")).columns


ROWS = [
    ("x", 0.5, 0.1, 0.4, "2024-01-01 00:00:00"),
    ("x", 0.1, 0.3, 0.6, "2024-01-01 23:59:59.999999"),
    ("x", 0.2, 0.2, 0.6, "2024-01-02 00:00:00"),
    ("y", 0.9, 0.0, 0.1, "2024-01-05 12:00:00"),
    ("y", 0.7, 0.0, 0.3, "2023-12-30 12:00:00"),
]


def brute(days, start, end):
    from datetime import timedelta

    out, d = {}, start
    while d < end:
        for company in "xy":
            hit = [r for r in ROWS if r[0] == company and d - timedelta(days=days) <= datetime.fromisoformat(r[4]) < d]
            if hit:
                out[(company, d)] = (len(hit), round(sum(r[1] for r in hit) / len(hit), 9))
        d += timedelta(days=1)
    return out


@pytest.mark.parametrize("days", [1, 2, 3, 7])
def test_intervals_equal_brute_force(spark, days):
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 7)
    got = co.company_sentiment_by_interval(pairs(spark, ROWS), "ts", start, end, days).collect()
    assert {(r["company"], r["utc_interval_date"]): (r["count"], round(r["positive"], 9)) for r in got} == brute(days, start, end)
    assert all(r["utc_timestamp"] == (r["utc_interval_date"] - datetime(1970, 1, 1)).total_seconds() for r in got)


def test_no_rows_in_range_gives_no_rows(spark):
    got = co.company_sentiment_by_interval(pairs(spark, ROWS), "ts", datetime(2030, 1, 1), datetime(2030, 2, 1))
    assert got.count() == 0


def test_other_session_zone_changes_nothing(spark):
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 7)
    want = sorted(map(tuple, co.company_sentiment_by_interval(pairs(spark, ROWS), "ts", start, end).collect()))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert sorted(map(tuple, co.company_sentiment_by_interval(pairs(spark, ROWS), "ts", start, end).collect())) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_three_way_join_needs_all_sides(spark):
    posts = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    scores = spark.createDataFrame([(1, 0.1), (2, 0.2), (9, 0.9)], "id int, s double")
    orgs = spark.createDataFrame([(1, ["x"]), (3, ["y"])], "id int, orgs array<string>")
    assert [tuple(r) for r in co.join_posts_scores_orgs(posts, scores, orgs).collect()] == [(1, 0.1, ["x"])]
