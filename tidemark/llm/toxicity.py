"""Toxicity by weak supervision: a label model over lexicon and pattern voters, and a linear classifier on its posteriors."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import common
from tidemark.session import cut_lineage

MAX_LABELLED = 20_000
MAX_TERMS = 2_000
LISTS = 4
STEMS = (4, 5, 6)
VOTERS = (*(f"words{k}" for k in range(LISTS)), *(f"stems{k}" for k in range(LISTS)), "shout", "mark")
LANE = 24
CACHED = 400_000
CAP = 4


def learn_terms(docs: DataFrame, labels: DataFrame, held_out: Column, max_labelled: int = MAX_LABELLED) -> tuple[list[str], list[str], float]:
    """(words, stems, share of toxic rows) from labelled rows that are not held out.

    Bounded sample, a documented parameter: at most about ``max_labelled`` labelled rows, by a hash of the id, whole
    texts. A word (or the first 4 to 6 letters of longer words) is a term if its rows are toxic far more often than
    all rows: the likelihood ratio must exceed what the best of all candidates reaches by chance, and
    nine in ten of its rows must be toxic. The same is asked of its distinct surroundings (the words before and
    after), so that the words of one much copied toxic text are no terms. At most MAX_TERMS of each kind.
    """
    usable = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out)
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    n = usable.count()
    sample = usable.where(common.unit_hash("doc_id", F.lit(4)) < max_labelled / max(n, 1))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # bounded by max_labelled
    letters = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    rows = cut_lineage(rows.select("_toxic", letters.alias("_words")))
    size, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("_toxic"), F.lit(0))).first()
    if not toxic or toxic == size:
        return [], [], 0.0
    prior = toxic / size
    distinct = rows.select("_toxic", F.array_distinct("_words").alias("_words"))
    stems = [F.array_distinct(_stems(k)) for k in STEMS]
    terms = F.concat(_tagged("w", F.col("_words")), *[_tagged("s", x) for x in stems])
    counts = cut_lineage(distinct.select("_toxic", F.explode(terms).alias("term")).groupBy("term").agg(F.sum("_toxic").alias("t"), F.count("*").alias("n")))
    least = math.log(max(counts.count(), 2)) + 2
    strong = _strong(counts, prior, least).limit(4 * MAX_TERMS)
    places = F.arrays_zip(F.col("_words").alias("w"), _shifted(-1).alias("b"), _shifted(1).alias("a"))
    near = rows.select("_toxic", F.inline(places)).select("_toxic", "w", F.xxhash64("b", "a").alias("_place"))
    keys = [F.concat(F.lit("w:"), "w"), *[F.when(F.char_length("w") > k, F.concat(F.lit("s:"), F.substring("w", 1, k))) for k in STEMS]]
    near = near.select("_toxic", "_place", F.explode(F.array(*keys)).alias("term"))
    near = near.join(F.broadcast(strong.select("term")), "term").groupBy("term", "_place").agg(F.max("_toxic").alias("_t"))
    counts = near.groupBy("term").agg(F.sum("_t").alias("t"), F.count("*").alias("n"))
    found = _strong(counts, prior, least).collect()
    kinds = {k: [r["term"][2:] for r in found if r["term"][0] == k][:MAX_TERMS] for k in "ws"}
    return kinds["w"], kinds["s"], prior


def _strong(counts: DataFrame, prior: float, least: float) -> DataFrame:
    """Terms seen ``t`` times in toxic rows of ``n`` times that pass the test, the strongest first."""
    share = F.col("t") / F.col("n")
    rest = F.when(share < 1, (F.col("n") - F.col("t")) * F.log((1 - share) / (1 - prior))).otherwise(0.0)
    ratio = F.col("t") * F.log(share / prior) + rest
    kept = counts.where((F.col("t") >= 3) & (share >= 0.9)).withColumn("r", ratio).where(F.col("r") >= least)
    return kept.orderBy(F.desc("r"), "term")


def _shifted(by: int) -> Column:
    """The words one place before or after each word, null at the end."""
    none = F.array(F.lit(None).cast("string"))
    n = F.size("_words")
    return F.concat(none, F.slice("_words", 1, F.greatest(n - 1, F.lit(0)))) if by < 0 else F.concat(F.slice("_words", 2, n), none)


def _stems(k: int) -> Column:
    return F.transform(F.filter("_words", lambda w: F.char_length(w) > k), lambda w: F.substring(w, 1, k))


def _tagged(kind: str, words: Column) -> Column:
    return F.transform(words, lambda w: F.concat(F.lit(f"{kind}:"), w))


def voter_hits(text: Column, words: list[str], stems: list[str]) -> Column:
    """struct of n_words and, per voter, how many words speak for toxicity.

    Lexicon voters: LISTS parts of the learned words. Pattern voters: LISTS parts of the learned stems (a longer
    word that begins with one), words in capitals, and words with an exclamation mark. Every distinct token is
    looked at once a task.
    """
    lexicon = {w: crc32(w.encode()) % LISTS for w in words}
    patterns = {s: LISTS + crc32(s.encode()) % LISTS for s in stems}

    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        runs = re.compile(r"[^\W\d_]+")
        mask = (1 << LANE) - 1
        known: dict[str, int] = {}

        def lanes(token: str) -> int:
            hits = set()
            for word in runs.findall(token.lower()):
                if word in lexicon:
                    hits.add(lexicon[word])
                hits.update(patterns[word[:k]] for k in STEMS if len(word) > k and word[:k] in patterns)
            if len(token) > 3 and token.isupper():
                hits.add(2 * LISTS)
            if "!" in token:
                hits.add(2 * LISTS + 1)
            return sum(1 << (LANE * h) for h in hits)

        for batch in batches:
            out = []
            for text in batch:
                tokens = text.split() if text else []
                if len(known) > CACHED:
                    known.clear()
                for token in set(tokens):
                    if token not in known:
                        known[token] = lanes(token)
                counts = [0] * len(VOTERS)
                for at in range(0, len(tokens), mask):  # a lane holds this many
                    total = sum([known[t] for t in tokens[at : at + mask]])
                    counts = [c + (total >> (LANE * k) & mask) for k, c in enumerate(counts)]
                out.append((len(tokens), *counts))
            yield pd.DataFrame(out, columns=["n_words", *VOTERS])

    return F.pandas_udf(scan, ", ".join(f"{c} long" for c in ("n_words", *VOTERS)))(text)


def votes(hits: str) -> list[Column]:
    """1 or 0 per voter: lexicon and stem lists vote on any word, the style patterns on one word in five."""
    dense = F.col(f"{hits}.n_words") / 5
    return [
        (F.col(f"{hits}.{v}") > (F.lit(0) if v[0] in "w" or v.startswith("stems") else dense)).cast("int") for v in VOTERS
    ]


def label_model(patterns: np.ndarray, counts: np.ndarray, prior: float, rounds: int = 200, tolerance: float = 1e-9) -> np.ndarray:
    """Posterior of toxicity per vote pattern, from how often each pattern occurs, without labels.

    The generative model has a class prior, and per voter the chance to vote in either class (its accuracies), fitted by
    expectation maximisation until the posteriors stand still. Voters of a class are not independent: the mean
    correlation of a voter with the others, given the class, is estimated as well, and a vote's weight in the
    posterior is divided by the number of voters that it stands for (1 + correlation * (voters - 1)). Lists
    that are silent abstain where another list votes: a short toxic text has words of few lists.
    """
    n, v = counts.sum(), patterns.shape[1]
    if not n:
        return np.zeros(len(patterns))
    lexical = patterns[:, : 2 * LISTS].sum(1)
    posterior = np.clip(np.where(lexical > 0, 0.9, 0.1 * prior), 1e-6, 1 - 1e-6)
    for _ in range(rounds):
        fire, weights = [], []
        for p in (1 - posterior, posterior):
            w = counts * p
            rate = (w @ patterns + 0.01) / (w.sum() + 0.02)
            centred = patterns - rate
            spread = np.sqrt(np.maximum((w @ centred**2) / w.sum(), 1e-12))
            corr = (centred * w[:, None]).T @ centred / w.sum() / np.outer(spread, spread)
            np.fill_diagonal(corr, 0)
            fire.append(rate)
            weights.append(1 + np.clip(corr, 0, 1).sum(1))
        shared = np.maximum(np.minimum(*weights), 1.0)
        share = float(np.clip(counts @ posterior / n, 1e-4, 0.5))
        odds = math.log(share / (1 - share))
        yes = patterns @ (np.log(fire[1] / fire[0]) / shared)
        no = (1 - patterns) @ (np.log((1 - fire[1]) / (1 - fire[0])) / shared)
        no[lexical > 0] = 0
        fresh = 1 / (1 + np.exp(-np.clip(odds + yes + no, -30, 30)))
        moved = np.abs(fresh - posterior).max()
        posterior = fresh
        if moved < tolerance:
            break
    return posterior


def linear(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1e-6, rounds: int = 50) -> np.ndarray:
    """Coefficients (the last is the intercept) of a logistic regression on soft targets, by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    beta = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + ridge * np.r_[beta[:-1], 0]
        curve = weight * np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve((x.T * curve) @ x + np.diag([ridge] * (len(beta) - 1) + [1e-9]), gradient)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def score(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_hits): one row per document.

    Terms come from labelled rows that are not held out. Votes are taken on every document; the label model reads the
    counts of vote patterns over all rows that are not held out (a group-by, at most 2 ** voters rows, here a few
    hundred), and the classifier is fitted to its posteriors on capped hit counts, grouped likewise. Scores read the
    text alone. Empty and null texts are scored like texts without hits; without toxic labels all scores are 0.
    """
    common.small_batches(docs.sparkSession)
    words, stems, prior = learn_terms(docs, labels, held_out)
    rows = docs.select("doc_id", held_out.alias("held_out"), voter_hits(F.col("text"), words, stems).alias("_h"))
    lexical = [F.least(F.col(f"_h.{v}"), F.lit(CAP)).cast("int") for v in VOTERS[: 2 * LISTS]]
    rows = cut_lineage(rows.select("doc_id", "held_out", F.array(*votes("_h")).alias("_v"), F.array(*lexical).alias("_x")))
    hits = F.aggregate("_x", F.lit(0), lambda a, x: a + x)
    if not words and not stems:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), hits.alias("n_hits"))
    total = hits.alias("_sum")
    grouped = rows.where(~F.col("held_out")).groupBy("_v", F.least(total, F.lit(CAP)).alias("_sum")).count().collect()
    patterns = np.array([r["_v"] for r in grouped], float)
    counts = np.array([r["count"] for r in grouped], float)
    posterior = label_model(patterns, counts, prior)
    x = np.c_[patterns, [r["_sum"] / CAP for r in grouped], [r["_sum"] > 0 for r in grouped]]
    beta = linear(x, posterior, counts)
    terms = [F.lit(float(b)) * F.col("_v")[k] for k, b in enumerate(beta[:-3])]
    terms.append(F.lit(float(beta[-2])) * (hits > 0).cast("int"))
    z = F.lit(float(beta[-1])) + F.lit(float(beta[-3])) * F.least(hits, F.lit(CAP)) / CAP
    for term in terms:
        z = z + term
    value = 1 / (1 + F.exp(-z))
    return rows.select("doc_id", "held_out", value.alias("score"), (value >= 0.5).cast("int").alias("predicted"), hits.alias("n_hits"))
