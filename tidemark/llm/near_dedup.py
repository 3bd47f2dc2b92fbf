"""Near-duplicates by SimHash, found by a binary trie self-join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import common
from tidemark.session import cut_lineage

SHINGLE = 3
DISTANCE = 2
GROUP = 50_000
PAIRS = 1 << 20
MASK = (1 << 64) - 1


def fingerprints(docs: DataFrame, size: int = SHINGLE, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and fp: 64 bits voted by the XXH64 (seed 42) of every shingle of ``size`` lower-cased words.

    Repeats of a shingle vote each time; fewer words are one shingle; null or blank text has fingerprint 0.
    Rows are kept as they are, repeated ids as well.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), *keys, common.words(common.ascii_lower(F.col("text"))).alias("_words")
    )
    rows = rows.select(common.shingle_rows(size, ["_row", *keys], "_words"))
    parts = [F.col(f"w{k}") for k in range(size)]
    hashed = F.when(parts[0].isNotNull(), F.xxhash64(F.concat_ws(" ", *parts)))
    votes = rows.select("_row", *keys, hashed.alias("_h")).groupBy("_row", *keys)
    sums = votes.agg(*common.vote_sums(F.col("_h"), "_s"), F.count("_h").alias("_n"))
    return sums.select(*keys, F.coalesce(common.majority("_s", F.col("_n")), F.lit(0)).cast("long").alias("fp"))


def _rotated(value: Column, by: int, width: int = 64) -> Column:
    """The lowest ``width`` bits turned left by ``by``; the bits above stay."""
    if by == 0:
        return value
    low = F.lit((1 << width) - 1 if width < 64 else -1).cast("long")
    part = value.bitwiseAND(low)
    turned = F.shiftleft(part, by).bitwiseAND(low).bitwiseOR(F.shiftrightunsigned(part, width - by))
    return value.bitwiseAND(F.bitwise_not(low)).bitwiseOR(turned) if width < 64 else turned


def _blocks(width: int, distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of distance + 1 blocks; two words within the distance agree on one of them."""
    cuts = [width * k // (distance + 1) for k in range(distance + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b) edges whose connected components are those of all pairs of ``fp`` within ``distance`` bits.

    ``fps``: distinct values of ``fp``. The trie is built over each of distance + 1 rotations. Below its first
    block no bit may differ, so its subtrees are dealt out by that block; each is joined with itself by
    :func:`trie_pairs`. Subtrees of more than GROUP words are cut once more by the blocks of the remaining bits.
    A task returns a spanning forest of the pairs it found, never the pairs.
    """
    dealt = None
    for turn, (first, bits) in enumerate(_blocks(64, distance)):
        part = fps.select(
            F.lit(turn).alias("_t"), F.lit(0).alias("_u"), F.lit(bits).alias("_head"), "fp", _rotated(F.col("fp"), first).alias("_key")
        ).withColumn("_top", F.shiftrightunsigned("_key", 64 - bits))
        dealt = part if dealt is None else dealt.unionAll(part)
    dealt = cut_lineage(dealt)
    large = dealt.groupBy("_t", "_top").count().where(F.col("count") > GROUP).select("_t", "_top")
    cold = dealt.join(large, ["_t", "_top"], "left_anti")
    hot = dealt.join(large, ["_t", "_top"], "left_semi")
    finer = cold.select("_t", "_u", "_head", "fp", "_key", "_top")
    for turn, (_, bits) in enumerate(_blocks(64, distance)):
        for again, (first, more) in enumerate(_blocks(64 - bits, distance)):
            part = hot.where(F.col("_t") == turn).withColumn("_key", _rotated(F.col("_key"), first, 64 - bits))
            part = part.withColumn("_head", F.lit(bits + more)).withColumn("_u", F.lit(again + 1))
            part = part.withColumn("_top", F.shiftrightunsigned("_key", 64 - bits - more))
            finer = finer.unionAll(part.select("_t", "_u", "_head", "fp", "_key", "_top"))
    subtrees = finer.repartition("_t", "_u", "_top").select("_t", "_u", "_head", "fp", "_key")

    def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b.to_numpy() for b in batches if len(b)]
        if not held:
            return
        rows = np.concatenate(held)
        for t, u, head in np.unique(rows[:, :3], axis=0):
            own = rows[(rows[:, 0] == t) & (rows[:, 1] == u) & (rows[:, 2] == head)]
            keys, at = np.unique(own[:, 4].astype(np.int64).view(np.uint64), return_index=True)
            words = own[at, 3]
            parent = np.arange(len(keys))
            for i, j in trie_pairs(keys, int(head), distance):
                _unite(parent, i, j)
            root = _roots(parent)
            linked = np.nonzero(root != np.arange(len(keys)))[0]
            if len(linked):
                yield pd.DataFrame({"a": words[linked], "b": words[root[linked]]})

    return subtrees.mapInPandas(forest, "a long, b long")


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def _unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Hooks larger roots under smaller ones until the given links join equal roots."""
    while True:
        parent[:] = _roots(parent)
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(parent, np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart]))


def trie_pairs(keys: np.ndarray, head: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted distinct 64-bit ``keys`` with equal first ``head`` bits and at most ``distance`` others.

    A trie node is a range of the sorted keys with a common prefix. Pairs of nodes go down together, one bit a
    step; children of unequal bits cost one error, and a pair over the budget is dropped with all below it. Pairs
    wait on a stack in pieces of at most PAIRS, which bounds the memory.
    """
    if len(keys) < 2:
        return
    prefix = keys >> np.uint64(64 - head)
    start = np.nonzero(np.r_[True, prefix[1:] != prefix[:-1]])[0]
    end = np.r_[start[1:], len(keys)]
    many = end - start > 1
    lo, hi = start[many], end[many]
    stack = [(head, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        depth, a, az, b, bz, err = stack.pop()
        if len(a) > PAIRS:
            half = len(a) // 2
            stack.append((depth, a[half:], az[half:], b[half:], bz[half:], err[half:]))
            a, az, b, bz, err = a[:half], az[:half], b[:half], bz[:half], err[:half]
            stack.append((depth, a, az, b, bz, err))
            continue
        leaves = (az - a == 1) & (bz - b == 1)
        if leaves.any():
            i, j = a[leaves], b[leaves]
            near = np.bitwise_count(keys[i] ^ keys[j]) <= distance
            if near.any():
                yield i[near], j[near]
            a, az, b, bz, err = a[~leaves], az[~leaves], b[~leaves], bz[~leaves], err[~leaves]
        if not len(a) or depth == 64:
            continue
        am, bm = _split(keys, a, az, depth), _split(keys, b, bz, depth)
        same = a == b
        sides = [
            (a, am, b, bm, err, slice(None)),
            (am, az, bm, bz, err, slice(None)),
            (a, am, bm, bz, err + 1, slice(None)),
            (am, az, b, bm, err + 1, ~same),
        ]
        for x, xz, y, yz, e, kept in sides:
            x, xz, y, yz, e = x[kept], xz[kept], y[kept], yz[kept], e[kept]
            live = (xz > x) & (yz > y) & (e <= distance) & ((x != y) | (xz - x > 1))
            if live.any():
                stack.append((depth + 1, x[live], xz[live], y[live], yz[live], e[live]))


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """First index in each range whose key has the bit at ``depth`` set."""
    above = np.uint64((MASK << (64 - depth)) & MASK)
    value = (keys[lo] & above) | np.uint64(1 << (63 - depth))
    return np.clip(np.searchsorted(keys, value), lo, hi)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): smallest node reachable over ``edges`` (a, b), by alternating large and small stars.

    Every round is written to the shared folder; the number of edges never grows.
    """
    edges = cut_lineage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
        edges = cut_lineage(small.where("a != b").distinct())
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
        seen = state


def near_duplicates(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document.

    component_id is the smallest doc_id reachable over links of at most ``distance`` differing bits. A null id
    takes part in links and is never the smallest unless its component has no other. An empty table gives no rows.
    """
    fps = cut_lineage(fingerprints(docs, size))
    rooted = _rooted(fps, distance)
    least = rooted.join(fps.groupBy("fp").agg(F.min("doc_id").alias("_least")), "fp")
    least = least.groupBy("_root").agg(F.min("_least").alias("component_id"))
    joined = fps.join(rooted.join(least, "_root"), "fp")
    return joined.select("doc_id", common.hex64(F.col("fp")).alias("fingerprint"), "component_id")


def _rooted(fps: DataFrame, distance: int) -> DataFrame:
    """(fp, _root): each distinct fingerprint with the smallest one of its component."""
    distinct = cut_lineage(fps.select("fp").distinct())
    roots = components(links(distinct, distance))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("_root"))


def unique(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each component of near-duplicates, with all columns: the one with the smallest doc_id.

    Rows without id come last; of rows of one id, the one with the smaller hash of its text stays, and one of equal
    rows. Only ids and hashes take part in finding them; the texts are shuffled once, to pick them.
    """
    named = docs.select(F.struct("*").alias("_doc"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("_i"), F.xxhash64("text").alias("_x"), "text")
    fps = cut_lineage(fingerprints(named, size, ("_i", "_x")))
    owned = fps.join(_rooted(fps, distance), "fp")
    first = owned.groupBy("_root").agg(F.min(F.struct("_i", "_x")).alias("_w")).select("_w.*").distinct()
    kept = named.select("_doc", "_i", "_x").join(first, ["_i", "_x"], "left_semi")
    return kept.groupBy("_i", "_x").agg(F.first("_doc").alias("_doc")).select("_doc.*")
