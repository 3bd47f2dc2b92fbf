"""Classifier queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import scores as sc
from tidemark.operators import sentiment as st
from tidemark.plans import snippets as sq
from tidemark.plans.registry import query
from tidemark.plans.words import _documents
from tidemark.session import cut_lineage
from tidemark.sources import tables
from tidemark.sources.label_maps import label_map


def _rounded(labels) -> list:
    return [F.round(label, 6).alias(label) for label in labels]


def _sql_rounded(labels) -> str:
    return ", ".join(f"round({label}, 6) AS {label}" for label in labels)


@query("sentiment_scores", f"SELECT doc_id, {_sql_rounded(sc.SENTIMENT_LABELS)} FROM ({sq.SCORES})")
def sentiment_scores(spark: SparkSession, root: str) -> DataFrame:
    scored = st.score_sentiment(_documents(spark, root, "text"), F.col("text"))
    return scored.select("doc_id", *_rounded(sc.SENTIMENT_LABELS))


_TOTAL = " + ".join(f"exp({e} - m)" for e in sc.EMOTION_LABELS)


@query(
    "emotion_scores",
    f"""SELECT doc_id, {', '.join(f'round(exp({e} - m) / ({_TOTAL}), 6) AS {e}' for e in sc.EMOTION_LABELS)}
    FROM (SELECT *, greatest({', '.join(sc.EMOTION_LABELS)}) AS m FROM ({sq.EMOTION_COUNTS}))""",
)
def emotion_scores(spark: SparkSession, root: str) -> DataFrame:
    scored = st.score_emotion(_documents(spark, root, "text"), F.col("text"))
    return scored.select("doc_id", *_rounded(sc.EMOTION_LABELS))


@query(
    "label_map",
    " UNION ALL ".join(
        f"SELECT doc_id, {i} AS label_id, '{label}' AS label, round({label}, 6) AS score FROM ({sq.SCORES})"
        for i, label in enumerate(sc.SENTIMENT_LABELS)
    ),
)
def label_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Score vectors as rows, the label looked up by index."""
    scored = st.score_sentiment(_documents(spark, root, "text"), F.col("text"))
    rows = st.score_rows(scored, sc.SENTIMENT_LABELS, label_map(spark, sc.SENTIMENT_LABELS), "doc_id")
    return rows.select("doc_id", "label_id", "label", F.round("score", 6).alias("score"))


@query(
    "avg_by_key",
    " UNION ALL ".join(
        f"SELECT '{e}' AS key, round(avg({e}), 6) AS value FROM ({sq.EMOTION_COUNTS}) WHERE {e} > 0 HAVING count(*) > 0"
        for e in sc.EMOTION_LABELS
    ),
)
def avg_by_key(spark: SparkSession, root: str) -> DataFrame:
    """Mean hits per emotion over the documents that show it at all."""
    counted = st.emotion_counts(_documents(spark, root, "text"), F.col("text"))
    pairs = [x for e in sc.EMOTION_LABELS for x in (F.lit(e), F.col(e))]
    sparse = F.map_filter(F.create_map(*pairs), lambda _, hits: hits > 0)
    return st.average_by_key(sparse, counted).withColumn("value", F.round("value", 6))


@query("spam_scores")
def spam_scores(spark: SparkSession, root: str) -> DataFrame:
    """Trained on all labelled documents, then applied to every document; texts are read once, as term counts."""
    counted = cut_lineage(st.term_counts(_documents(spark, root, "text"), "text", "doc_id"))
    labels = tables.load_table(spark, root, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = st.fit_spam_model(counted.join(labels, "doc_id"))
    return st.spam_probabilities(model, counted, "doc_id").select("doc_id", *_rounded(("ham", "spam")))
