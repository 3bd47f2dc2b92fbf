"""Token counts under a unigram model, by dynamic programming shared along a trie of pre-tokens."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import common

CACHED = 500_000
SPACE = "▁"


def zipf_scores(model_file: str) -> tuple[dict[str, float], float]:
    """Log-probabilities of a public vocabulary's pieces by a fixed rule, and that of one fallback byte.

    The piece of rank r (file order, control and byte pieces left out) has a probability in proportion to 1 / r;
    a byte has that of the last rank. Nothing is trained.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    whole = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return {p: -math.log(r) - whole for r, p in enumerate(pieces, 1)}, -math.log(len(pieces)) - whole


def trie_counts(pre_tokens: list[str], scores: dict[str, float], byte: float) -> dict[str, int]:
    """Number of tokens in the best segmentation of each pre-token.

    The distinct pre-tokens form a trie, walked depth first (the order of the sorted list), so that only the path
    to the current node is held. A node holds the best score of a segmentation of its prefix and that
    segmentation's length; it is computed once for all pre-tokens below it, and a terminal's length is its
    count. Equal scores: the shorter segmentation. A character without a piece costs its UTF-8 bytes.
    """
    longest = max(map(len, scores), default=1)
    counts: dict[str, int] = {}
    best, length = [0.0], [0]
    before = ""
    for word in sorted(set(pre_tokens)):
        shared = 0
        for x, y in zip(before, word, strict=False):
            if x != y:
                break
            shared += 1
        del best[shared + 1 :], length[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            last = word[end - 1]
            if last in scores:
                top, n = best[-1] + scores[last], length[-1] + 1
            else:
                extra = len(last.encode("utf-8", "surrogatepass"))
                top, n = best[-1] + extra * byte, length[-1] + extra
            for start in range(max(0, end - longest), end - 1):
                score = scores.get(word[start:end])
                if score is not None:
                    score += best[start]
                    if score > top or (score == top and length[start] + 1 < n):
                        top, n = score, length[start] + 1
            best.append(top)
            length.append(n)
        counts[word] = length[-1]
        before = word
    return counts


def token_counts(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens): one row per document; null and blank texts have none.

    A pre-token is a run without white space, with a word mark before it. Each task keeps the counts of the
    pre-tokens it has met, up to a bound, and adds the new ones of a batch as one trie. No shuffle is needed.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores, byte = zipf_scores(model_file)
        known: dict[str, int] = {}
        for batch in batches:
            n_words, n_tokens = [], []
            texts = batch["text"].fillna("").tolist()
            for at in range(0, len(texts), 256):
                split = [text.split() for text in texts[at : at + 256]]
                new = {w for words in split for w in words if w not in known}
                if len(known) > CACHED:
                    known.clear()
                    new = {w for words in split for w in words}
                if new:
                    found = trie_counts([SPACE + w for w in new], scores, byte)
                    known.update((w[1:], n) for w, n in found.items())
                n_words += map(len, split)
                n_tokens += [sum([known[w] for w in words]) for words in split]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_pretokens": n_words, "n_tokens": n_tokens})

    common.small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")  # pandas would round ids beside a null
    counted = rows.mapInPandas(count, "doc_id string, n_pretokens long, n_tokens long")
    return counted.withColumn("doc_id", F.col("doc_id").cast("long"))
