"""Word counting, running frequencies and word time series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from tidemark.functions import text as tx

# Short English stop list used where a result has to be reproducible in SQL.
STOP_WORDS = ("the", "of", "and", "a", "in", "to", "is", "that", "it", "on", "for", "with", "as", "at", "by")


def default_stop_words() -> list[str]:
    """Spark ML's English list, for callers who do not bring their own."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")


def words_of(
    df: DataFrame, text: Column, *keep: str, stop_words: Sequence[str] | DataFrame = STOP_WORDS
) -> DataFrame:
    """One row per counted word of the cleaned, lower-cased text, with the ``keep`` columns.

    A stop list given as a DataFrame (column ``word``) is anti-joined, so it may be of any size.
    """
    # The tokens are exploded where they are computed: behind a named array column the
    # optimizer would infer size(array) > 0 and tokenize every text a second time.
    words = df.select(*keep, F.explode(tx.tokens(tx.clean_text(text))).alias("word"))
    words = words.where(tx.starts_with_letter(F.col("word")))
    if isinstance(stop_words, DataFrame):
        return words.join(stop_words.select("word"), "word", "left_anti")
    return words.where(~F.col("word").isin(list(stop_words))) if stop_words else words


def word_count(df: DataFrame, text: Column, stop_words: Sequence[str] | DataFrame = STOP_WORDS) -> DataFrame:
    """(word, count). Counting starts before the shuffle, so a very common word is no hot spot."""
    return words_of(df, text, stop_words=stop_words).groupBy("word").count()


def word_count_split(df: DataFrame, text: Column) -> DataFrame:
    """Plain map/reduce count: split at single spaces, lower-case, keep empties and punctuation."""
    return (
        df.select(F.explode(F.split(text, " ", -1)).alias("raw"))
        .select(F.lower("raw").alias("word"))
        .groupBy("word")
        .count()
    )


def word_time_series(df: DataFrame, text: Column, *keys: str) -> DataFrame:
    """One row per (keys, word) with its count; ``keys`` identify the text and its time.

    When ``df`` is already partitioned by one of the keys no further shuffle is needed.
    """
    return words_of(df, text, *keys).groupBy(*keys, "word").count()


def upsert_counts(state: DataFrame, delta: DataFrame) -> DataFrame:
    """Add the counts of ``delta`` to ``state`` (word, count, timestamp); the newest timestamp stays."""
    return summed_counts(state.unionByName(delta))


def summed_counts(rows: DataFrame) -> DataFrame:
    """One row per word of (word, count, timestamp) rows: the sum of the counts and the newest timestamp."""
    return rows.groupBy("word").agg(F.sum("count").alias("count"), F.max("timestamp").alias("timestamp"))


def top_words(counts: DataFrame, k: int | None = 10) -> DataFrame:
    """Most frequent words first, equal counts in word order; ``k=None`` keeps all."""
    ordered = counts.select("word", "count").orderBy(F.desc("count"), "word")
    return ordered if k is None else ordered.limit(k)


def top_per_group(counts: DataFrame, group: str, k: int) -> DataFrame:
    """The ``k`` most frequent words of every group, with their rank.

    Spark cuts each task's rows to ``k`` per group before the shuffle (window group limit),
    so a group that holds most words does not land in one task.
    """
    order = W.partitionBy(group).orderBy(F.desc("count"), "word")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def group_words(df: DataFrame, text: Column, group: str, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """(group, word, count) over the noun and verb tokens of the texts in each group."""
    kept = df.select(group, F.explode(tx.tokens(text)).alias("word")).where(kept_token(F.col("word"), stop_words))
    return kept.groupBy(group, "word").count()


# --- part of speech -----------------------------------------------------------------------

# Endings that decide the tag of a word the lexicon does not know.
NOUN_ENDINGS = ("tion", "ness", "ment", "ity")
VERB_ENDINGS = ("ing", "ed")


def pos_tag(word: Column, known: dict[str, str] | None = None) -> Column:
    """Tag by lexicon, else by ending: N noun, V verb, X other. An approximation of a tagger."""
    w = F.lower(word)
    tag = F.when(w.rlike(f"({'|'.join(NOUN_ENDINGS)})$"), "N").when(w.rlike(f"({'|'.join(VERB_ENDINGS)})$"), "V")
    tag = tag.otherwise("X")
    if not known:
        return tag
    by_tag: dict[str, list[str]] = {}
    for entry, entry_tag in known.items():
        by_tag.setdefault(entry_tag, []).append(entry)
    for entry_tag, entries in by_tag.items():
        tag = F.when(w.isin(entries), entry_tag).otherwise(tag)
    return tag


def tag_words(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Tag a word table from a lexicon table (word, tag) of any size; unknown words by ending."""
    known = words.join(lexicon.select("word", F.col("tag").alias("known")), "word", "left")
    return known.withColumn("tag", F.coalesce("known", pos_tag(F.col("word")))).drop("known")


def noun_words(counts: DataFrame) -> DataFrame:
    """Words of a frequency table that are tagged as nouns.

    The tag depends on the word alone, so the noun set need not be built and joined back.
    """
    return counts.where(pos_tag(F.col("word")).startswith("N"))


# --- token cleaning -----------------------------------------------------------------------


def kept_token(word: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """ASCII letters only, no stop word in any case, noun or verb."""
    return (
        tx.ascii_letters_or_empty(word)
        & ~F.lower(word).isin(list(stop_words))
        & pos_tag(word).rlike("^[NV]")
    )


def clean_tokens(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """The kept tokens of a text, in order."""
    return F.filter(tx.tokens(text), lambda t: kept_token(t, stop_words))


def clean_token_text(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return F.array_join(clean_tokens(text, stop_words), " ")
