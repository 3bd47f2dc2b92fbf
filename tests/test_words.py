import random
from collections import Counter

from pyspark.sql import functions as F

from tidemark.operators import words as wd


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def test_split_count_keeps_empty_tokens(spark):
    assert rows(wd.word_count_split(frame(spark, ["A a  b"]), F.col("text"))) == [("", 1), ("a", 2), ("b", 1)]


def test_word_count_drops_stop_words_and_non_letters(spark):
    df = frame(spark, ["The cat's 1st hat\nhat. 'tis été n't", "the CAT"])
    assert rows(wd.word_count(df, F.col("text"))) == [("cat", 1), ("cat's", 1), ("hathat", 1), ("n't", 1)]


def test_stop_words_from_a_table_equal_a_list(spark):
    df = frame(spark, ["a b c d the of", "b c"])
    table = spark.createDataFrame([("b",), ("the",)], "word string")
    assert rows(wd.word_count(df, F.col("text"), table)) == rows(wd.word_count(df, F.col("text"), ["b", "the"]))


def test_total_of_counts_equals_tokens(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab cd the ef".split()) for _ in range(rng.randint(0, 30))) for _ in range(40)]
    want = Counter(w for t in texts for w in t.split() if w != "the")
    assert dict(rows(wd.word_count(frame(spark, texts), F.col("text")))) == want
    series = wd.word_time_series(frame(spark, texts), F.col("text"), "id")
    assert sum(r["count"] for r in series.collect()) == sum(want.values())


def test_upsert(spark):
    schema = "word string, count bigint, timestamp double"
    state = spark.createDataFrame([("x", 2, 1.0)], schema)
    delta = spark.createDataFrame([("x", 3, 2.0), ("y", 1, 2.0)], schema)
    assert rows(wd.upsert_counts(state, delta)) == [("x", 5, 2.0), ("y", 1, 2.0)]


def test_top_words_and_ties(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("d", 1)], "word string, count bigint")
    assert [r["word"] for r in wd.top_words(counts, 3).collect()] == ["c", "a", "b"]
    assert wd.top_words(counts, None).count() == 4


def test_top_per_group_honours_k(spark):
    counts = spark.createDataFrame([(g, w, n) for g in "pq" for n, w in enumerate("abcdef")], "g string, word string, count bigint")
    top = wd.top_per_group(counts, "g", 2)
    assert rows(top.select("g", "word", "rank")) == [("p", "e", 2), ("p", "f", 1), ("q", "e", 2), ("q", "f", 1)]


def test_tags(spark):
    words = spark.createDataFrame([("nation",), ("running",), ("red",), ("dog",), ("KINDNESS",)], "word string")
    plain = dict(rows(words.select("word", wd.pos_tag(F.col("word")))))
    assert plain == {"nation": "N", "running": "V", "red": "V", "dog": "X", "KINDNESS": "N"}
    known = {"dog": "N", "red": "J"}
    lexicon = spark.createDataFrame(list(known.items()), "word string, tag string")
    by_list = rows(words.select("word", wd.pos_tag(F.col("word"), known).alias("tag")))
    assert by_list == rows(wd.tag_words(words, lexicon).select("word", "tag"))
    assert dict(by_list)["dog"] == "N" and dict(by_list)["red"] == "J"


def test_clean_token_text(spark):
    df = frame(spark, ["The nation is RUNNING 4ation été-ment don't"])
    assert df.select(wd.clean_token_text(F.col("text"))).first()[0] == "nation running ment"


def test_default_stop_words(spark):
    assert len(wd.default_stop_words()) == 181
