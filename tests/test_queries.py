"""Every registered query against its SQL on the same tables."""

import oracle
import pytest

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    con = oracle.connection(data)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, data, name):
    columns, rows = oracle.spark_rows(QUERIES[name](spark, data))
    expected_columns, expected = oracle.duck_rows(duck, SQL[name])
    assert columns == expected_columns
    assert rows == expected


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_spam_scores_cover_every_document(spark, data):
    rows = QUERIES["spam_scores"](spark, data).collect()
    assert len({r["doc_id"] for r in rows}) == 200
    assert all(abs(r["ham"] + r["spam"] - 1) < 1e-5 for r in rows)


@pytest.mark.parametrize("name", ["kmeans_sizes", "agglomerative_sizes"])
def test_cluster_sizes_sum_to_all(spark, data, name):
    assert sum(r["size"] for r in QUERIES[name](spark, data).collect()) == 500


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "company" and df.count() == 126
