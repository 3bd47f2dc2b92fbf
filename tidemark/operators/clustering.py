"""Clustering of embeddings, and reports on clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.functions import vectors as vx
from tidemark.operators import words as wd
from tidemark.operators.ingest import chain_totals
from tidemark.session import run_folder

AT_ONCE = 32_768  # clusters that are merged in one place
BLOCK = 8_192  # centres of a block, about
FEW_BLOCKS = 32  # up to so many blocks are a partition each; more of them share partitions
STEP = 1 << 20  # distances at once


def unit_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    return vectors.select(key, vx.unit(F.col(vector)).alias("unit")).where(F.col("unit").isNotNull())


def gram_matrix(units: DataFrame, vector: str, dim: int) -> np.ndarray:
    """dim x dim matrix of summed products; each task sends one dim x dim block.

    Functions that run on the executors use nothing of this package, so it need not be installed there.
    """

    def partial(batches: Iterator) -> Iterator:
        import pandas as pd

        total = np.zeros((dim, dim))
        for pdf in batches:
            if len(pdf):
                m = np.array(pdf[vector].tolist())
                total += m.T @ m
        yield pd.DataFrame({"i": np.arange(dim), "row": list(total)})

    rows = units.select(vector).mapInPandas(partial, "i int, row array<double>")
    sums = rows.groupBy("i").agg(F.expr(f"array({', '.join(f'sum(get(row, {j}))' for j in range(dim))})").alias("row"))
    gram = np.zeros((dim, dim))
    for r in sums.collect():  # dim rows, whatever the table size
        gram[r["i"]] = r["row"]
    return gram


def similarity_space(vectors: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """Vectors whose distances equal those between rows of the full cosine-similarity matrix.

    With unit vectors X (n x d), row i of S = X X' is X x_i, hence
    |S_i - S_j|^2 = (x_i - x_j)' G (x_i - x_j) with G = X'X. Mapping x to G^(1/2) x gives the
    same distances in d dimensions, so the n x n matrix is never built.
    """
    units = unit_vectors(vectors, key, vector)
    values, basis = np.linalg.eigh(gram_matrix(units, "unit", dim))
    root = basis * np.sqrt(np.clip(values, 0.0, None))

    def project(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({key: pdf[key], "features": list(np.array(pdf["unit"].tolist()) @ root)})

    return units.mapInPandas(project, f"{key} {vectors.schema[key].dataType.simpleString()}, features array<double>")


def kmeans(features: DataFrame, key: str, column: str, k: int = 20, seed: int = 42, **params):
    """(model, rows with ``cluster``) of Spark ML k-means over an array column."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    data = features.select(key, array_to_vector(column).alias("_f"))
    model = KMeans(k=k, seed=seed, featuresCol="_f", predictionCol="cluster", **params).fit(data)
    return model, model.transform(data).select(key, "cluster")


def _searcher():
    """The search between two blocks of clusters, as a function that goes to the executors by value."""

    def search(q, qw, qc, ids, w, c, threshold):
        """(row, d, other, tie): for rows of q the place of the nearest of ``ids`` by Ward distance, if nearer than ``threshold``.

        Products of 32-bit numbers give bounds from below; what they leave open is measured exactly, from both ends of a
        pair alike. Of equal distances the lowest hash of the pair counts, so that ties pair up all over. ``ids`` are in order.
        """
        if not len(q) or not len(ids):
            return np.empty(0, int), np.empty(0), np.empty(0, int), np.empty(0, int)
        dim = c.shape[1]
        square, squares = (qc * qc).sum(axis=1), (c * c).sum(axis=1)
        good, bad = np.isfinite(square), ~np.isfinite(squares)
        most = max(square.max(initial=0, where=good), squares.max(initial=0, where=~bad))
        slack = 8 * (dim + 8) * 2.0**-24 * most  # twice what rounding can do to a squared gap
        right = np.empty((dim + 2, len(ids)), "float32")
        right[:dim], right[dim], right[dim + 1] = -2 * c.T, 1, squares - slack
        right[:, bad], right[dim + 1, bad] = 0, np.inf
        inverse, step = (1 / w).astype("float32"), max(1, STEP // len(ids))
        products, shares = np.empty((step, len(ids)), "float32"), np.empty((step, len(ids)), "float32")
        place = np.minimum(np.searchsorted(ids, q), len(ids) - 1)
        own = ids[place] == q
        pairs = []
        for start in range(0, len(q), step):
            x, weight = qc[start : start + step], qw[start : start + step]
            n = len(x)
            left = np.ones((n, dim + 2), "float32")
            left[:, :dim], left[:, dim] = x, square[start : start + step]
            low, share, row = np.matmul(left, right, out=products[:n]), shares[:n], np.arange(n)
            np.multiply(weight[:, None].astype("float32"), inverse, out=share)
            share += 1
            low /= share  # d^2 / (2 * weight), or a little less
            itself = own[start : start + n]
            low[row[itself], place[start : start + n][itself]] = np.inf
            low[~good[start : start + n]] = np.inf
            at = low.argmin(axis=1)
            least = low[row, at].astype("float64")
            most = np.minimum(least + 2 * slack / share[row, at], threshold * threshold / 2 / weight)
            hit = least <= most * (1 + 1e-6)
            pairs.append((row[hit] + start, at[hit]))
            low[row, at] = np.inf
            for r in np.flatnonzero(hit & (low.min(axis=1) <= most * (1 + 1e-6))):
                more = np.flatnonzero(low[r] <= most[r] * (1 + 1e-6))
                pairs.append((np.full(len(more), r + start), more))
        i, j = (np.concatenate(x) for x in zip(*pairs))
        d = np.empty(len(i))
        for start in range(0, len(i), STEP // 64):
            a, b = i[start : start + STEP // 64], j[start : start + STEP // 64]
            gap = qc[a] - c[b]
            d[start : start + len(a)] = np.sqrt(2 * qw[a] * w[b] / (qw[a] + w[b]) * (gap * gap).sum(axis=1))
        kept = d < threshold
        i, j, d = i[kept], j[kept], d[kept]
        low, high = np.minimum(q[i], ids[j]).astype("uint64"), np.maximum(q[i], ids[j]).astype("uint64")
        tie = (low * np.uint64(0x9E3779B97F4A7C15)) ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))
        tie = (((tie ^ (tie >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(1)).astype("int64")
        order = np.lexsort((j, tie, d, i))
        first = order[np.r_[True, i[order][1:] != i[order][:-1]]] if len(order) else order
        return i[first], d[first], j[first], tie[first]

    return search


_search = _searcher()


def ward_labels(centres: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Ward merging of weighted points until the next merge would reach ``threshold``.

    Ward distances are reducible, so in each round all pairs that are nearest to each other merge at once, and only
    clusters that are new or have lost their nearest one search again. Clusters without a near one are done. Memory is
    in proportion to the points; their number, which the caller bounds, counts squared in time.
    """
    n = len(sizes)
    centre, weight = centres.astype("float64"), sizes.astype("float64")
    name, parent = np.arange(n), np.arange(n)
    other, best, asks = np.full(n, -1), np.full(n, np.inf), np.isfinite(centre).all(axis=1)
    while True:
        kept = asks | (other >= 0)
        if not kept.all():
            name, centre, weight, other, best, asks = name[kept], centre[kept], weight[kept], other[kept], best[kept], asks[kept]
            other = np.where(other >= 0, np.cumsum(kept)[other] - 1, -1)
        rows = np.flatnonzero(asks)
        other[rows] = -1
        row, gap, found, _ = _search(name[rows], weight[rows], centre[rows], name, weight, centre, threshold)
        other[rows[row]], best[rows[row]] = found, gap
        near = np.flatnonzero(other >= 0)
        if not len(near):
            break
        a = near[(other[other[near]] == near) & (near < other[near])]
        if not len(a):  # ties
            closest = near[np.argmin(best[near])]
            a = np.array([min(closest, other[closest])])
            b = np.array([max(closest, other[closest])])
        else:
            b = other[a]
        gone = np.zeros(len(name), dtype=bool)
        gone[a] = gone[b] = True
        total = weight[a] + weight[b]
        centre[a] = (weight[a, None] * centre[a] + weight[b, None] * centre[b]) / total[:, None]
        weight[a], parent[name[b]] = total, name[a]
        asks = gone | ((other >= 0) & gone[other])
        other[asks], asks[b] = -1, False
    for i in range(n):  # a parent comes before its children
        parent[i] = parent[parent[i]]
    order = {root: label for label, root in enumerate(dict.fromkeys(parent.tolist()))}
    return np.array([order[root] for root in parent.tolist()])


CLUSTER = "id long, w double, c array<double>"
PACKED = "ids binary, w binary, c binary"


def _stored(rows: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read back, with the size of the files as their estimate.

    A checkpoint keeps the estimate of its plan, which is a product for a join: over the rounds its digits double each
    time, until such numbers fill the driver.
    """
    path = run_folder(rows.sparkSession, "ward")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _partitions(n: int) -> int:
    return max(1, min(-(-n // BLOCK), FEW_BLOCKS))


def _packed(rows: DataFrame, n: int) -> DataFrame:
    """(ids, w, c): blocks of clusters in the order of their ids, as bytes of 64-bit numbers; centres end to end."""
    most = BLOCK

    def pack(batches: Iterator) -> Iterator:
        import pandas as pd

        parts = [(pdf["id"].to_numpy(), pdf["w"].to_numpy(), np.stack(pdf["c"])) for pdf in batches if len(pdf)]
        if not parts:
            return
        ids, w, c = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(ids)
        for some in np.array_split(order, max(1, round(len(order) / most))):
            yield pd.DataFrame({"ids": [ids[some].tobytes()], "w": [w[some].tobytes()], "c": [c[some].tobytes()]})

    return rows.select("id", "w", "c").coalesce(_partitions(n)).mapInPandas(pack, PACKED)


def nearest(asking: DataFrame, clusters: DataFrame, threshold: float, n: int) -> DataFrame:
    """(id, best): each of ``asking`` with its nearest pair (d, tie, low, high) in ``clusters``, where one is nearer than ``threshold``.

    ``asking`` are some of the ``n`` clusters. Every block of the one meets every block of the other where both are read, without
    a shuffle; a task holds two blocks and a bounded part of their distances, and sends one row a cluster.
    """

    def compare(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            for r in pdf.itertuples():
                q, ids = np.frombuffer(r.q_ids, "int64"), np.frombuffer(r.ids, "int64")
                if len(q) and len(ids):
                    qc, c = np.frombuffer(r.q_c).reshape(len(q), -1), np.frombuffer(r.c).reshape(len(ids), -1)
                    i, d, j, tie = _search(q, np.frombuffer(r.q_w), qc, ids, np.frombuffer(r.w), c, threshold)
                    yield pd.DataFrame({"id": q[i], "d": d, "tie": tie, "other": ids[j]})

    blocks, asked = _packed(clusters, n).persist(), _packed(asking, n).persist()
    for held in (blocks, asked):
        held.count()
    left = asked.select(*[F.col(c).alias(f"q_{c}") for c in ("ids", "w", "c")])
    pairs = left.crossJoin(blocks.hint("shuffle_replicate_nl")).mapInPandas(compare, "id long, d double, tie long, other long")
    best = F.min(F.struct("d", "tie", F.least("id", "other").alias("low"), F.greatest("id", "other").alias("high"))).alias("best")
    found = _stored(pairs.groupBy("id").agg(best))
    for held in (blocks, asked):
        held.unpersist()
    return found


def _merged(rows: DataFrame, n: int) -> DataFrame:
    """Clusters (id, w, c, asks) with those of one id put together; there are two at most."""

    def merge(batches: Iterator) -> Iterator:
        import pandas as pd

        parts = [pdf for pdf in batches if len(pdf)]
        if not parts:
            return
        held = pd.concat(parts, ignore_index=True).sort_values("id", ignore_index=True)
        ids, w, asks, c = held["id"].to_numpy(), held["w"].to_numpy().copy(), held["asks"].to_numpy(), np.stack(held["c"])
        second = np.flatnonzero(ids[1:] == ids[:-1]) + 1
        total = w[second - 1] + w[second]
        c[second - 1] = (w[second - 1, None] * c[second - 1] + w[second, None] * c[second]) / total[:, None]
        w[second - 1] = total
        kept = np.setdiff1d(np.arange(len(ids)), second)
        for some in np.array_split(kept, -(-len(kept) // 4_096)):
            yield pd.DataFrame({"id": ids[some], "w": w[some], "c": list(c[some]), "asks": asks[some]})

    return rows.repartition(_partitions(n), "id").mapInPandas(merge, f"{CLUSTER}, asks boolean")


def agglomerative(
    vectors: DataFrame, key: str, vector: str, threshold: float = 3.0, micro: int | None = None, seed: int = 42
) -> DataFrame:
    """(key, cluster) by Ward linkage with a distance threshold and no fixed number of clusters.

    Equal vectors are one weighted point. Ward distances are reducible, so in each round all pairs of clusters that are
    nearest to each other merge at once, and only clusters that are new or have lost their nearest one search again; rounds
    go on over all tasks until at most AT_ONCE clusters are left or no two are nearer than the threshold. Those few are then merged in one place. The result is that of merging the closest
    pair again and again, whatever the number of vectors. Zero vectors are left out; no rows give no rows.

    ``micro``: condense the vectors by k-means to so many weighted centres first (an approximation, for callers who
    want a bound on the work).
    """
    units = unit_vectors(vectors, key, vector)
    if units.isEmpty():
        return units.select(key, F.lit(0).alias("cluster"))
    if micro is not None:
        return _condensed(units, key, threshold, micro, seed)
    points = _stored(units.groupBy(F.col("unit").alias("c")).agg(F.count("*").cast("double").alias("w")).withColumn("id", F.monotonically_increasing_id()))
    n = points.count()
    clusters, bests, merged = points.withColumn("asks", F.lit(True)), None, None
    if n > AT_ONCE:
        clusters = _stored(clusters.repartition(_partitions(n), "id"))
    while n > AT_ONCE:
        found = nearest(clusters.where("asks").select("id", "w", "c"), clusters, threshold, n)
        bests = found if bests is None else _stored(bests.unionByName(found))
        mutual = bests.groupBy("best.low", "best.high").count().where("count = 2")
        mutual = _stored(mutual.select("low", "high"))
        pairs = mutual.count()
        if not pairs:
            closest = bests.agg(F.min("best").alias("best")).where("best IS NOT NULL")  # ties
            mutual = _stored(closest.select("best.low", "best.high"))
            pairs = mutual.count()
            if not pairs:
                break
        steps = mutual.select(F.col("high").alias("key"), F.col("low").alias("next"))
        merged = steps if merged is None else merged.unionAll(steps)
        # Merging brings no two clusters nearer than one of their parts was, so a nearest one that is left stays the nearest.
        other = F.when(F.col("id") == F.col("best.low"), F.col("best.high")).otherwise(F.col("best.low"))
        gone = mutual.select(F.explode(F.array("low", "high")).alias("_gone"))
        state = bests.withColumn("_other", other).join(gone, F.col("_other") == F.col("_gone"), "left")
        state = _stored(state.join(steps, F.col("id") == F.col("key"), "left").select("id", "best", F.col("_gone").isNotNull().alias("asks"), "next"))
        bests = state.where("NOT asks").select("id", "best")
        changed = state.where("asks").select("id", "asks", "next")
        moved = clusters.select("id", "w", "c").hint("merge").join(changed, "id", "left")
        moved = moved.select(F.coalesce("next", "id").alias("id"), "w", "c", F.coalesce("asks", F.lit(False)).alias("asks"))
        n -= pairs
        clusters = _stored(_merged(moved, n))
    if n <= AT_ONCE:
        held = [[np.frombuffer(x, kind) for x, kind in zip(r, ("int64", "float64", "float64"), strict=True)] for r in _packed(clusters, n).collect()]
        ids, w, c = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(ids)
        labels = ward_labels(c.reshape(len(ids), -1)[order], w[order], threshold)
        last = units.sparkSession.createDataFrame(list(zip(ids[order].tolist(), labels.tolist(), strict=True)), "last long, cluster long")
    else:
        last = clusters.select(F.col("id").alias("last"), F.col("id").alias("cluster"))
    roots = points.select(F.col("id").alias("last"), "c", F.col("id").alias("key"))
    if merged is not None:
        links = points.select(F.col("id").alias("key")).join(merged, "key", "left").withColumn("weight", F.lit(0))
        roots = points.select(F.col("id").alias("key"), "c").hint("merge").join(chain_totals(links, "ward-merges").select("key", "last"), "key")
    named = roots.hint("merge").join(last, "last").select(F.col("c").alias("unit"), "cluster")
    return units.join(named.hint("merge"), "unit").select(key, "cluster")


def _condensed(units: DataFrame, key: str, threshold: float, micro: int, seed: int) -> DataFrame:
    model, assigned = kmeans(units, key, "unit", k=micro, seed=seed)
    assigned = assigned.withColumnRenamed("cluster", "micro")
    sizes, centres = np.array(model.summary.clusterSizes), np.array(model.clusterCenters())
    used = np.flatnonzero(sizes)
    labels = ward_labels(centres[used], sizes[used], threshold)
    mapping = units.sparkSession.createDataFrame(
        [(int(m), int(c)) for m, c in zip(used, labels)], "micro int, cluster int"
    )
    return assigned.join(F.broadcast(mapping), "micro").select(key, "cluster")


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


def with_sizes(members: DataFrame) -> DataFrame:
    """Member rows with the size of their cluster; clusters are never gathered into one row."""
    return members.join(cluster_sizes(members), "cluster")


def cluster_top_words(counts: DataFrame, group: str, k: int = 10) -> DataFrame:
    """(group, word, count, rank) of the ``k`` commonest words per cluster."""
    return wd.top_per_group(counts, group, k)


def topic_info(texts: DataFrame, counts: DataFrame, group: str, k: int = 10) -> DataFrame:
    """(group, size, words): cluster size and its ``k`` top words in order."""
    sizes = texts.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    listed = cluster_top_words(counts, group, k).groupBy(group).agg(
        F.array_sort(F.collect_list(F.struct("rank", "word"))).alias("ranked")
    )
    words = F.array_join(F.transform("ranked", lambda r: r["word"]), " ")
    return sizes.join(listed, group, "left").select(group, "size", F.coalesce(words, F.lit("")).alias("words"))
