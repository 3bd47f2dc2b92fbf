import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scores as sc
from tidemark.operators import sentiment as st
from tidemark.sources.label_maps import label_map, read_label_map


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def test_softmax(spark):
    row = spark.range(1).select(
        F.array(*sc.softmax([F.lit(1.0), F.lit(2.0), F.lit(3.0)])).alias("a"),
        sc.softmax_array(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))).alias("b"),
        sc.softmax_array(F.array(F.lit(1000.0), F.lit(1000.0))).alias("c"),
    ).first()
    assert [round(x, 6) for x in row["a"]] == [0.090031, 0.244728, 0.665241]
    assert row["a"] == pytest.approx(row["b"]) and row["c"] == [0.5, 0.5]


def test_normalized_score(spark):
    row = spark.range(1).select(
        sc.normalized_score(F.lit(1.2) / 3, F.lit(0.6) / 3).alias("a"), sc.normalized_score(F.lit(0.3), F.lit(0.3)).alias("b")
    ).first()
    assert round(row["a"], 9) == 0.6 and row["b"] == 0.5


def test_sentiment_reads_the_whole_text(spark):
    long = "word " * 600 + "erble"
    rows = st.score_sentiment(frame(spark, ["thtion x erble ertion", "", long]), F.col("text")).collect()
    e = [math.exp(1), math.exp(1), math.exp(2)]
    assert [rows[0][c] for c in sc.SENTIMENT_LABELS] == pytest.approx([x / sum(e) for x in e])
    assert rows[2]["negative"] == pytest.approx(rows[2]["neutral"])
    cut = st.score_sentiment(frame(spark, [long]), F.col("text"), max_tokens=512).first()
    assert cut["negative"] < cut["neutral"]
    assert all(sum(r[c] for c in sc.SENTIMENT_LABELS) == pytest.approx(1) for r in rows)


def test_emotion(spark):
    row = st.score_emotion(frame(spark, ["thanea reing heing"]), F.col("text")).first()
    e = {"anger": 2, "joy": 0, "optimism": 0, "sadness": 1}
    total = sum(math.exp(x) for x in e.values())
    assert {k: row[k] for k in e} == pytest.approx({k: math.exp(x) / total for k, x in e.items()})


def test_struct_and_rows_form(spark):
    scored = st.score_sentiment(frame(spark, ["thtion"]), F.col("text"))
    assert st.as_struct(scored).select("sentiment.positive").first()[0] == scored.first()["positive"]
    rows = st.score_rows(scored, sc.SENTIMENT_LABELS, label_map(spark, sc.SENTIMENT_LABELS), "id").collect()
    assert {r["label"]: r["score"] for r in rows} == {c: scored.first()[c] for c in sc.SENTIMENT_LABELS}
    vector = F.array(F.lit(0.1), F.lit(0.2), F.lit(0.7))
    assert spark.range(1).select(sc.labelled(vector, sc.SENTIMENT_LABELS).alias("s")).first()["s"]["positive"] == 0.7


def test_average_by_key(spark):
    df = spark.createDataFrame([({"a": 1.0, "b": 2.0},), ({"a": 3.0},)], "m map<string,double>")
    assert dict(tuple(r) for r in st.average_by_key(F.col("m"), df).collect()) == {"a": 2.0, "b": 2.0}


def test_label_file(spark, tmp_path):
    path = tmp_path / "map.tsv"
    path.write_text("0\tham\n1\tspam\n2\n")
    assert sorted(tuple(r) for r in read_label_map(spark, str(path)).collect()) == [(0, "ham"), (1, "spam")]


def test_own_model(spark):
    def load():
        return lambda texts: [[float(len(t)), 0.0] for t in texts]

    rows = st.score_with_model(frame(spark, ["", "@bob", "aé"]), "id", "text", ["a", "b"], load, batch_size=2).collect()
    got = {r["id"]: r["a"] for r in rows}
    want = {0: 0, 1: 5, 2: 2}  # the model sees the cleaned text
    assert got == pytest.approx({i: math.exp(n) / (math.exp(n) + 1) for i, n in want.items()})


def test_spam_model_learns(spark):
    texts = [f"win money now {i}" if i % 2 else f"lunch at noon {i}" for i in range(40)]
    df = frame(spark, texts).withColumn("y", F.col("id") % 2)
    model = st.train_spam_model(df, "text", "y", features=256)
    scored = st.spam_scores(model, df, "id", "text").collect()
    assert all((r["spam"] > 0.5) == (r["id"] % 2 == 1) for r in scored)
