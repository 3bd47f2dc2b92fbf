"""Ranked lexical search by blocked dense multiplication: item vocabulary tiles times document impact tiles."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tidemark.session import cut_lineage

TOP = 20
ITEMS_PER_PASS = 1_024  # items whose terms a task holds at once; more items take more passes over the documents
TERMS_PER_PASS = 1 << 18
TILE_ITEMS, TILE_TERMS, TILE_DOCS = 32, 1_024, 512
EXACT = 1 << 53  # float64 sums of integers are exact below it
MOST_IMPACT = 1_000_000
SLICES = 64

#: Every byte of a term as itself, but A-Z as a-z; all other ASCII bytes as a blank. Bytes from 0x80 belong to letters beyond ASCII.
FOLD = bytes(b if chr(b).isalnum() or b >= 0x80 else 32 for b in range(256)).lower()


def terms_of(raw: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: maximal runs of digits, ASCII letters (lower-cased) and characters beyond ASCII."""
    return raw.translate(FOLD).split()


class Tile:
    """Items of one tile and their weights by term, cut so that no score part of a cut can reach 2**53."""

    def __init__(self, items: list[Counter[int]], weight: np.ndarray) -> None:
        vocabulary: dict[int, list[tuple[int, int]]] = {}
        for column, counts in enumerate(items):
            for term, times in counts.items():
                if w := times * int(weight[term]):
                    vocabulary.setdefault(term, []).append((column, w))
        self.width = len(items)
        self.cuts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        most = (EXACT - 1) // MOST_IMPACT
        terms, cells, sums = [], [], [0] * self.width
        for term in sorted(vocabulary):
            left = dict(vocabulary[term])
            while left:
                part = {c: min(w, most) for c, w in left.items()}  # a heavier term takes several rows
                left = {c: w - part[c] for c, w in left.items() if w > part[c]}
                if len(terms) == TILE_TERMS or any(sums[c] + w > most for c, w in part.items()):
                    self._cut(terms, cells)
                    terms, cells, sums = [], [], [0] * self.width
                cells += [(len(terms), c, w) for c, w in part.items()]
                terms.append(term)
                for c, w in part.items():
                    sums[c] += w
        if terms:
            self._cut(terms, cells)

    def _cut(self, terms: list[int], cells: list[tuple[int, int, int]]) -> None:
        row, column, w = np.array(cells, np.int64).T
        self.cuts.append((np.array(terms), row, column, w))

    def scores(self, docs: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray, size: int) -> np.ndarray:
        """Integer scores (documents x items) from one document tile, given as cells (row, term, impact)."""
        total = np.zeros((docs, self.width), np.int64)
        for terms, at, column, w in self.cuts:
            weights = np.zeros((len(terms), self.width))
            weights[at, column] = w
            place = np.full(size, -1)
            place[terms] = np.arange(len(terms))
            mine = place[term]
            hit = mine >= 0
            impacts = np.zeros((docs, len(terms)))
            impacts[row[hit], mine[hit]] = impact[hit]
            total += (impacts @ weights).astype(np.int64)
        return total


class Best:
    """The ``top`` best of each item so far: greater scores first, then smaller ids, rows without id last."""

    def __init__(self, items: int, top: int) -> None:
        self.top, self.items = top, items
        self.least = np.ones(items, np.int64)
        self.held = np.empty((0, 4), np.int64)  # item, score, without id, id

    def add(self, first: int, scores: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        """Takes from a tile what can still be among the best; rows with the last place's score are compared by id."""
        doc, item = np.nonzero(scores >= self.least[first : first + scores.shape[1]])
        if not len(doc):
            return
        new = np.stack([item + first, scores[doc, item], none[doc], ids[doc]], axis=1)
        rows = np.concatenate([self.held, new])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        begin = np.searchsorted(rows[:, 0], np.arange(self.items + 1))
        place = np.arange(len(rows)) - begin[rows[:, 0]]
        self.held = rows[place < self.top]
        full = np.flatnonzero(np.diff(begin) >= self.top)
        self.least[full] = rows[begin[full] + self.top - 1, 1]


def _passes(items: DataFrame) -> Iterator[list[tuple[int | None, Counter[bytes]]]]:
    """Items in groups of a bounded number of items and terms; the driver holds one group at a time."""
    group: list[tuple[int | None, Counter[bytes]]] = []
    terms = 0
    for row in items.select("item_id", F.col("text").cast("binary").alias("text")).toLocalIterator():
        counts = Counter(terms_of(bytes(row["text"] or b"")))
        if group and (len(group) == ITEMS_PER_PASS or terms + len(counts) > TERMS_PER_PASS):
            yield group
            group, terms = [], 0
        group.append((row["item_id"], counts))
        terms += len(counts)
    if group:
        yield group


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(without, id, n, terms, counts) of every document: its terms in ``vocabulary``, by number. One read of the texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, terms, counts = [], [], []
            for raw in batch["text"]:
                own = terms_of(raw) if raw else []
                found = [(vocabulary[t], c) for t, c in Counter(own).items() if t in vocabulary]
                sizes.append(len(own))
                terms.append(np.array([t for t, _ in found], np.int32))
                counts.append(np.array([c for _, c in found], np.int32))
            yield pd.DataFrame({"without": batch["without"], "id": batch["id"], "n": sizes, "terms": terms, "counts": counts})

    rows = docs.select(
        F.col("doc_id").isNull().alias("without"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("text").cast("binary").alias("text")
    )
    return rows.mapInPandas(count, "without boolean, id long, n long, terms array<int>, counts array<int>")


def _weights(postings: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Number of documents with a term, number of terms, and the weight of each term of the vocabulary."""
    n, length = postings.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = np.zeros(size, np.int64)
    for row in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the terms of a pass
        found[row["term"]] = row["count"]
    return n, length, np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(f) + 1))) for f in found], np.int64)


def _search(docs: DataFrame, group: list[tuple[int | None, Counter[bytes]]], top: int) -> DataFrame:
    """(item, item_id, score, without, doc_id): the best of each task for each item of one pass."""
    vocabulary = {t: k for k, t in enumerate(dict.fromkeys(chain.from_iterable(c for _, c in group)))}
    postings = cut_lineage(_postings(docs, vocabulary))
    size = len(vocabulary)
    n, length, weight = _weights(postings, size)
    counts = [Counter({vocabulary[t]: c for t, c in own.items()}) for _, own in group]
    tiles = [Tile(counts[k : k + TILE_ITEMS], weight) for k in range(0, len(counts), TILE_ITEMS)]
    names = [None if i is None else str(i) for i, _ in group]

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = Best(len(names), top)
        for batch in batches:
            for at in range(0, len(batch), TILE_DOCS):
                part = batch.iloc[at : at + TILE_DOCS]
                row = np.repeat(np.arange(len(part)), [len(t) for t in part["terms"]])
                if not len(row):
                    continue
                term = np.concatenate(part["terms"].to_list())
                times = np.concatenate(part["counts"].to_list()).astype(np.int64)
                damping = np.array([12 * (75 + 25 * k * n // length) for k in part["n"].tolist()], np.int64)  # whole numbers of any size
                impact = 1_000_000_000 * times // (1000 * times + damping[row])
                none, ids = part["without"].to_numpy(), part["id"].to_numpy()
                for k, tile in enumerate(tiles):
                    best.add(k * TILE_ITEMS, tile.scores(len(part), row, term, impact, size), none, ids)
        if not len(best.held):
            return
        item, score, none, ids = best.held.T
        yield pd.DataFrame({"item": item, "item_id": [names[k] for k in item], "score": score, "without": none.astype(bool), "doc_id": ids})

    return postings.mapInPandas(multiply, "item long, item_id string, score long, without boolean, doc_id long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each row of ``items`` with a score above 0.

    Equal scores go by ascending doc_id, documents without id last. Every row of either table counts on its own, so a
    repeated item is answered twice and a repeated document can be found twice. Null and empty texts have no terms: they
    find nothing and are not found. Without items or documents there are no rows. Texts are read whole, once for each
    pass of at most ITEMS_PER_PASS items.
    """
    found = None
    for k, group in enumerate(_passes(items)):
        part = _search(docs, group, top).withColumn("pass", F.lit(k))
        found = part if found is None else cut_lineage(found).unionAll(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), "without", "doc_id"]
    slices = Window.partitionBy("pass", "item", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES))).orderBy(*order)
    kept = found.withColumn("rank", F.row_number().over(slices)).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("pass", "item").orderBy(*order))).where(F.col("rank") <= top)
    doc_id = F.when(~F.col("without"), F.col("doc_id"))
    return kept.select(F.col("item_id").cast("long").alias("item_id"), "rank", doc_id.alias("doc_id"), "score")
