"""Score arithmetic on columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tidemark.functions.vectors import with_value

# Label maps, index -> label.
SENTIMENT_LABELS = ("negative", "neutral", "positive")
EMOTION_LABELS = ("anger", "joy", "optimism", "sadness")


def softmax(logits: Sequence[Column]) -> list[Column]:
    """Stable softmax over a fixed list of logit columns."""
    top = F.greatest(*logits)
    exps = [F.exp(z - top) for z in logits]
    total = sum(exps[1:], exps[0])
    return [e / total for e in exps]


def softmax_array(logits: Column) -> Column:
    """Stable softmax over an array column of any width."""
    exps = with_value(F.array_max(logits), lambda top: F.transform(logits, lambda z: F.exp(z - top)))

    def scaled(es: Column) -> Column:
        total = F.aggregate(es, F.lit(0.0), lambda acc, e: acc + e)
        return with_value(total, lambda t: F.transform(es, lambda e: e / t))

    return with_value(exps, scaled)


def normalized_score(positive: Column, negative: Column) -> Column:
    """Mean positive minus mean negative, moved from [-1, 1] to [0, 1]."""
    return (positive - negative + 1) / 2


def labelled(scores: Column, labels: Sequence[str]) -> Column:
    """Score array -> struct with one field per label."""
    return F.struct(*[F.get(scores, F.lit(i)).alias(label) for i, label in enumerate(labels)])
