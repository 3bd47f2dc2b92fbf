"""Named queries: a Spark plan over the stored tables and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def register(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = plan
        if sql is not None:
            SQL[name] = sql
        return plan

    return register


def load_all() -> None:
    from tidemark.plans import company, entities, ingest, sentiment, streams, vectors, words  # noqa: F401
