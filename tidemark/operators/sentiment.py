"""Text classifiers: lexicon scores as columns, a trained model, or a caller's own model."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import scores as sc, text as tx

# Lexicons of the built-in scorers.
POSITIVE = ("thtion", "ertion", "antion", "retion")
NEGATIVE = ("erble", "onble", "anble", "inble")
EMOTIONS = {
    "anger": ("thanea", "reing"),
    "joy": ("ining", "aning"),
    "optimism": ("ontion", "heble"),
    "sadness": ("heing", "hation"),
}
NEUTRAL_LOGIT = 1.0


def lexicon_hits(text: Column, words: Iterable[str], max_tokens: int | None = None) -> Column:
    """Tokens of the cleaned text that are in a lexicon. ``max_tokens`` only where a model needs a bound."""
    toks = tx.tokens(tx.clean_text(text))
    if max_tokens is not None:
        toks = F.slice(toks, 1, max_tokens)
    return F.filter(toks, lambda t: t.isin(sorted(set(words))))


def _count(hits: Column, words: Sequence[str]) -> Column:
    return F.size(F.filter(hits, lambda t: t.isin(list(words)))).cast("double")


def score_sentiment(df: DataFrame, text: Column, max_tokens: int | None = None) -> DataFrame:
    """Append ``negative, neutral, positive``: softmax over lexicon hits of the whole text.

    The text is walked once; the class counts are taken from the few tokens that hit.
    """
    hit = df.withColumn("_hits", lexicon_hits(text, POSITIVE + NEGATIVE, max_tokens))
    logits = hit.withColumns({"_neg": _count(F.col("_hits"), NEGATIVE), "_pos": _count(F.col("_hits"), POSITIVE)})
    probs = sc.softmax([F.col("_neg"), F.lit(NEUTRAL_LOGIT), F.col("_pos")])
    return logits.withColumns(dict(zip(sc.SENTIMENT_LABELS, probs))).drop("_hits", "_neg", "_pos")


def emotion_counts(df: DataFrame, text: Column, max_tokens: int | None = None) -> DataFrame:
    """Append one hit count per emotion label."""
    everything = [w for words in EMOTIONS.values() for w in words]
    hit = df.withColumn("_hits", lexicon_hits(text, everything, max_tokens))
    return hit.withColumns({e: _count(F.col("_hits"), EMOTIONS[e]) for e in sc.EMOTION_LABELS}).drop("_hits")


def score_emotion(df: DataFrame, text: Column, max_tokens: int | None = None) -> DataFrame:
    """Append one softmax score per emotion label."""
    counted = emotion_counts(df, text, max_tokens)
    probs = sc.softmax([F.col(e) for e in sc.EMOTION_LABELS])
    return counted.withColumns(dict(zip(sc.EMOTION_LABELS, probs)))


def as_struct(df: DataFrame, labels: Sequence[str] = sc.SENTIMENT_LABELS, name: str = "sentiment") -> DataFrame:
    """Flat label columns -> one struct column, the stored form of a score."""
    return df.withColumn(name, F.struct(*labels)).drop(*labels)


def score_rows(df: DataFrame, labels: Sequence[str], label_map: DataFrame, *keys: str) -> DataFrame:
    """Score vector -> one row per label, the name looked up in the label map by index."""
    vector = F.array(*[F.col(label) for label in labels])
    rows = df.select(*keys, F.posexplode(vector).alias("label_id", "score"))
    return rows.join(label_map.withColumnRenamed("id", "label_id"), "label_id")


def average_by_key(maps: Column, df: DataFrame) -> DataFrame:
    """Mean value per key over a map column; a key missing from a map does not count there."""
    return df.select(F.explode(maps).alias("key", "value")).groupBy("key").agg(F.avg("value").alias("value"))


# --- user models --------------------------------------------------------------------------


def score_with_model(
    df: DataFrame,
    id_col: str,
    text_col: str,
    labels: Sequence[str],
    load_model: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]],
    batch_size: int = 64,
) -> DataFrame:
    """Score the cleaned text with a caller's model: logits per text in, softmax scores out.

    ``load_model`` runs once per task and returns ``texts -> logits``.
    """
    import numpy as np
    import pandas as pd

    names = list(labels)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                part = pdf.iloc[start : start + batch_size]
                logits = np.asarray(model(part["text"].tolist()), dtype="float64")
                exps = np.exp(logits - logits.max(axis=1, keepdims=True))
                out = pd.DataFrame(exps / exps.sum(axis=1, keepdims=True), columns=names, index=part.index)
                out.insert(0, id_col, part[id_col])
                yield out

    cleaned = df.select(id_col, tx.clean_text(F.col(text_col)).alias("text"))
    schema = f"{id_col} {df.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{n} double" for n in names)
    return cleaned.mapInPandas(run, schema)


def term_counts(df: DataFrame, text_col: str, *keep: str, features: int = 1 << 14) -> DataFrame:
    """``keep`` and tf: hashed term counts of the cleaned text, a sparse vector much smaller than the text."""
    from pyspark.ml.feature import HashingTF

    tokens = df.select(*keep, tx.tokens(tx.clean_text(F.col(text_col))).alias("tokens"))
    return HashingTF(inputCol="tokens", outputCol="tf", numFeatures=features).transform(tokens).select(*keep, "tf")


def fit_spam_model(counted: DataFrame, max_iter: int = 100):
    """IDF -> logistic regression on (tf, label) rows; returns the fitted pipeline, which reads ``tf``.

    The regression runs until it converges; ``max_iter`` only bounds a fit that does not. The rows are kept while both
    pass over them.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF

    counted = counted.select("tf", F.col("label").cast("double").alias("label")).persist()
    try:
        idf = IDF(inputCol="tf", outputCol="features").fit(counted)
        weighted = idf.transform(counted).select("features", "label").persist()
        try:
            regression = LogisticRegression(maxIter=max_iter, regParam=0.01).fit(weighted)
        finally:
            weighted.unpersist()
    finally:
        counted.unpersist()
    return PipelineModel([idf, regression])


def spam_probabilities(model, counted: DataFrame, id_col: str) -> DataFrame:
    """(id, ham, spam) probabilities of (id, tf) rows from :func:`fit_spam_model`."""
    from pyspark.ml.functions import vector_to_array

    p = vector_to_array("probability")
    return model.transform(counted).select(id_col, p[0].alias("ham"), p[1].alias("spam"))


def train_spam_model(labelled: DataFrame, text_col: str, label_col: str, features: int = 1 << 14, max_iter: int = 100):
    """HashingTF -> IDF -> logistic regression on the cleaned texts; returns the fitted pipeline, which reads ``tokens``."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import HashingTF

    counted = term_counts(labelled, text_col, label_col, features=features).withColumnRenamed(label_col, "label")
    hashing = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=features)
    return PipelineModel([hashing, *fit_spam_model(counted, max_iter).stages])


def spam_scores(model, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, ham, spam) probabilities of texts from :func:`train_spam_model`."""
    data = df.select(id_col, tx.tokens(tx.clean_text(F.col(text_col))).alias("tokens"))
    return spam_probabilities(model, data, id_col)
