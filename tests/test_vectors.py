import os
import subprocess
import sys

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tidemark.functions import vectors as vx
from tidemark.operators import clustering as cl, vectors as ve, word_vectors as wv
from tidemark.session import estimated_bytes

DIM = 6


def random_vectors(n=60, seed=0):
    return np.random.default_rng(seed).normal(size=(n, DIM))


def frame(spark, m):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(m)], "id int, v array<double>")


def cosines(m):
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    return u @ u.T


def test_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "u array<double>, v array<double>, z array<double>")
    row = df.select(vx.cosine(F.col("u"), F.col("v")).alias("c"), vx.unit(F.col("u")).alias("n"), vx.unit(F.col("z")).alias("z"), vx.dot_with("u", [1, 2]).alias("d")).first()
    assert row["c"] == pytest.approx(0.96) and row["n"] == [0.6, 0.8] and row["z"] is None and row["d"] == 11


@pytest.mark.parametrize("ascending", [False, True])
def test_topk_and_intersection(spark, ascending):
    m = random_vectors()
    df = frame(spark, m)
    queries = ve.query_vectors(df, "id", "v", [1, 5])
    lists = ve.related_topk(df, "id", "v", queries, k=20, ascending=ascending)
    sims = cosines(m)
    want = {q: [int(i) for i in np.argsort(sims[q] if ascending else -sims[q], kind="stable")[:20]] for q in (1, 5)}
    got = {q: [r["id"] for r in lists.where(F.col("query_id") == q).orderBy("rank").collect()] for q in (1, 5)}
    assert got == want
    both = {r["id"] for r in ve.in_every_list(lists, "id", "query_id", 2).collect()}
    assert both == set(want[1]) & set(want[5])


def test_pairs(spark):
    m = random_vectors()
    pairs = spark.createDataFrame([(0, 1), (5, 9), (5, 999)], "a int, b int")
    got = {(r["a"], r["b"]): r["sim"] for r in ve.pair_similarity(pairs, frame(spark, m), "id", "v").collect()}
    assert got == pytest.approx({(0, 1): cosines(m)[0, 1], (5, 9): cosines(m)[5, 9]})


def test_mean_pool(spark):
    m = random_vectors()
    pooled = ve.mean_pool(frame(spark, m).withColumn("g", F.col("id") % 2), "g", "v", DIM)
    for r in pooled.collect():
        assert r["mean"] == pytest.approx(m[r["g"] :: 2].mean(axis=0))


def test_sentence_vectors(spark):
    words = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], "word string, vector array<double>")
    texts = spark.createDataFrame([(1, ["a", "a", "b", "?"]), (2, ["?"])], "id int, toks array<string>")
    got = ve.sentence_vectors(texts, "id", "toks", words, 2).collect()
    assert [(r["id"], r["mean"]) for r in got] == [(1, pytest.approx([2 / 3, 2 / 3]))]


def test_word_vectors(spark):
    texts = spark.createDataFrame([(["x", "y", "z"] * 5,), (["x", "y", "rare"],)], "toks array<string>")
    got = ve.word_vectors(texts, "toks", size=4, min_count=2).collect()
    assert {r["word"] for r in got} == {"x", "y", "z"} and all(len(r["vector"]) == 4 for r in got)


def test_similarity_space_keeps_the_distances_of_the_full_matrix(spark):
    m = random_vectors(40)
    mapped = cl.similarity_space(frame(spark, m), "id", "v", DIM).orderBy("id").collect()
    got, full = np.array([r["features"] for r in mapped]), cosines(m)
    for i in range(0, 40, 7):
        assert np.linalg.norm(got - got[i], axis=1) == pytest.approx(np.linalg.norm(full - full[i], axis=1), abs=1e-9)


def brute_ward(points, threshold):
    groups = [[i] for i in range(len(points))]
    while len(groups) > 1:
        best = None
        for a in range(len(groups)):
            for b in range(a):
                na, nb = len(groups[a]), len(groups[b])
                gap = points[groups[a]].mean(axis=0) - points[groups[b]].mean(axis=0)
                d = np.sqrt(2 * na * nb / (na + nb)) * np.linalg.norm(gap)
                if best is None or d < best[0]:
                    best = (d, a, b)
        if best[0] >= threshold:
            break
        _, a, b = best
        groups[b] += groups.pop(a)
    return sorted(sorted(g) for g in groups)


def grouped(labels):
    out = {}
    for i, c in enumerate(labels):
        out.setdefault(int(c), []).append(i)
    return sorted(out.values())


@pytest.mark.parametrize("threshold", [0.3, 0.8, 1.5, 3.0, 100.0])
def test_ward_equals_brute_force(spark, threshold):
    m = random_vectors(45, seed=4)
    units = m / np.linalg.norm(m, axis=1, keepdims=True)
    assert grouped(cl.ward_labels(units, np.ones(45), threshold)) == brute_ward(units, threshold)
    rows = cl.agglomerative(frame(spark, m), "id", "v", threshold).orderBy("id").collect()
    assert grouped([r["cluster"] for r in rows]) == brute_ward(units, threshold)


def blobs():
    rng = np.random.default_rng(1)
    return np.concatenate([np.eye(DIM)[i] * 5 + rng.normal(scale=0.05, size=(30, DIM)) for i in range(3)])


def test_condensed_ward_finds_separate_blobs(spark):
    rows = cl.agglomerative(frame(spark, blobs()), "id", "v", threshold=3.0, micro=20).orderBy("id").collect()
    assert grouped([r["cluster"] for r in rows]) == [list(range(0, 30)), list(range(30, 60)), list(range(60, 90))]


def test_kmeans_on_similarities_finds_blobs(spark):
    features = cl.similarity_space(frame(spark, blobs()), "id", "v", DIM)
    _, rows = cl.kmeans(features, "id", "features", k=3)
    assert sorted(r["size"] for r in cl.cluster_sizes(rows).collect()) == [30, 30, 30]


def test_executors_need_not_have_the_package(tmp_path):
    """Workers start in another folder without the package on their path."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys, os\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false').config('spark.sql.shuffle.partitions','2').getOrCreate()\n"
        "sys.path.insert(0, sys.argv[1])\n"
        "import __spark_entry__ as c\n"
        "print('rows', c.queries()['kmeans_sizes'](spark, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code, root], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 20" in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize("threshold", [0.9, 2.5])
def test_distributed_ward_rounds_equal_brute_force(spark, monkeypatch, threshold):
    """All mutual nearest pairs merge at once, over many cells and blocks; a tenth of the rows are one vector."""
    monkeypatch.setattr(cl, "AT_ONCE", 40)
    monkeypatch.setattr(cl, "BLOCK", 8)
    m = random_vectors(110, seed=9)
    m[:11] = m[0]
    units = m / np.linalg.norm(m, axis=1, keepdims=True)
    rows = cl.agglomerative(frame(spark, m), "id", "v", threshold).orderBy("id").collect()
    assert grouped([r["cluster"] for r in rows]) == brute_ward(units, threshold)


@pytest.mark.parametrize("few", [0, 16])
def test_ward_rounds_search_again_only_for_clusters_that_lost_their_nearest(spark, monkeypatch, few):
    """Both searches, with blocks and with cells, give the clusters of one place; most neighbours are kept over a round."""
    monkeypatch.setattr(cl, "AT_ONCE", 100)
    monkeypatch.setattr(cl, "BLOCK", 16)
    monkeypatch.setattr(cl, "FEW_BLOCKS", few)
    asked, search = [], cl.nearest

    def counted(asking, clusters, threshold, n):
        asked.append((asking.count(), n))
        return search(asking, clusters, threshold, n)

    monkeypatch.setattr(cl, "nearest", counted)
    m = random_vectors(160, seed=11)
    units = m / np.linalg.norm(m, axis=1, keepdims=True)
    rows = cl.agglomerative(frame(spark, m), "id", "v", 2.0).orderBy("id").collect()
    assert grouped([r["cluster"] for r in rows]) == brute_ward(units, 2.0)
    assert asked[0] == (160, 160) and len(asked) > 1 and all(a < n for a, n in asked[1:])


def test_rounds_do_not_grow_the_estimates_of_the_plan(spark, monkeypatch):
    """The estimates of a round are those of its stored rows and not products over all rounds."""
    monkeypatch.setattr(cl, "AT_ONCE", 10)
    sizes, search = [], cl.nearest

    def seen(asking, clusters, threshold, n):
        sizes.append(max(estimated_bytes(asking), estimated_bytes(clusters)))
        found = search(asking, clusters, threshold, n)
        sizes.append(estimated_bytes(found))
        return found

    monkeypatch.setattr(cl, "nearest", seen)
    m = random_vectors(60, seed=3)
    cl.agglomerative(frame(spark, m), "id", "v", 100.0).count()
    assert len(sizes) >= 8 and max(sizes) < 1 << 20


def test_ward_pairs_up_ties_all_over(monkeypatch):
    """Points at equal distances merge in few rounds, not pair by pair; a point that is not a number stays alone."""
    calls, search = [], cl._search
    monkeypatch.setattr(cl, "_search", lambda *given: calls.append(1) or search(*given))
    m = np.concatenate([np.eye(256), np.full((1, 256), np.nan)])
    labels = cl.ward_labels(m, np.ones(257), 1.5)
    sizes = np.bincount(labels)
    assert sizes.sum() == 257 and sizes[labels[256]] == 1 and sizes[:-1].min() >= 2 and len(calls) < 128


def test_search_finds_the_nearest_of_weighted_clusters():
    """32-bit bounds and exact distances together give what 64-bit distances give, over weights of all sizes."""
    rng = np.random.default_rng(8)
    c = rng.normal(size=(300, 20))
    c /= np.linalg.norm(c, axis=1, keepdims=True) * rng.uniform(1, 3, size=(300, 1))
    c[200:250] = c[:50] + rng.normal(scale=1e-9, size=(50, 20))
    w = np.floor(10 ** rng.uniform(0, 6, 300))
    gap = ((c[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    d = np.sqrt(2 * w[:, None] * w / (w[:, None] + w) * gap)
    np.fill_diagonal(d, np.inf)
    ids = np.arange(300) * 3
    limit = float(np.median(d[::2].min(axis=1)))
    row, got, place, _ = cl._search(ids[::2], w[::2], c[::2], ids, w, c, limit)
    want = np.flatnonzero(d[::2].min(axis=1) < limit)
    assert len(want) == 75 and (row == want).all()
    assert (place == d[::2].argmin(axis=1)[want]).all() and np.allclose(got, d[::2].min(axis=1)[want], atol=1e-12)


def test_ward_in_one_place_over_nearly_equal_points():
    """Distances that differ by rounding alone end the chain; places of merged clusters are given up."""
    m = np.repeat(np.eye(3), 40, axis=0) + np.arange(120)[:, None] * 1e-17
    m += np.random.default_rng(2).normal(scale=1e-16, size=m.shape)
    assert grouped(cl.ward_labels(m, np.ones(120), 0.5)) == [list(range(0, 40)), list(range(40, 80)), list(range(80, 120))]


@pytest.mark.parametrize("ascending", [False, True])
def test_any_number_of_keywords(spark, ascending):
    """1,000 keywords over blocks of both sides, with repeated vectors as ties, a zero vector and missing values."""
    m = random_vectors(1200)
    m[600:700], m[7] = m[:100], 0
    items = frame(spark, m).unionByName(spark.createDataFrame([(None, [1.0] * DIM), (9999, None)], "id int, v array<double>"))
    asked = items.where("id < 1000 OR id IS NULL")
    got = ve.related_blocks(asked, items, "id", "v", 15, ascending, query_block=300, item_block=400).collect()
    with np.errstate(invalid="ignore"):
        sims = cosines(m).round(ve.DIGITS)
    others = [i for i in range(1200) if i != 7]
    want = set()
    for q in range(1000):
        if q != 7:
            best = sorted(others, key=lambda i: (sims[q, i] if ascending else -sims[q, i], i))[:15]
            want |= {(q, i, rank) for rank, i in enumerate(best, 1)}
    assert len(got) == len(want) and {(r["query_id"], r["id"], r["rank"]) for r in got} == want
    assert ve.related_blocks(asked.limit(0), items, "id", "v").count() == 0


def test_word_vectors_are_the_leading_eigenvectors(spark):
    """Against a dense matrix from brute-force counts: repeated words, a null text, a null word, an empty text, a lone word."""
    rng = np.random.default_rng(4)
    topics = [[f"{t}{i}" for i in range(12)] for t in "abc"]
    texts = [list(rng.choice(topics[n % 3], 30)) for n in range(60)] + [["a1", "a1", None, "b2"], [], ["lone"], None]
    texts = [None if t is None else [None if w is None else str(w) for w in t] for t in texts]
    tokens = spark.createDataFrame([(t,) for t in texts], "words array<string>")
    n = {}
    for t in texts:
        for i in range(len(t or [])):
            for j in range(max(0, i - 2), min(len(t), i + 3)):
                if j != i and t[i] is not None and t[j] is not None:
                    n[t[i], t[j]] = n.get((t[i], t[j]), 0) + 1
    counts = wv.cooccurrence(tokens, "words", 2)
    assert {(r["a"], r["b"]): r["n"] for r in counts.collect()} == n
    names = sorted({a for a, _ in n})
    dense = np.array([[n.get((a, b), 0) for b in names] for a in names], dtype=float)
    sums = dense.sum(axis=1)
    with np.errstate(divide="ignore"):
        information = np.maximum(np.log(dense * dense.sum() / np.outer(sums, sums)), 0)
    values, basis = np.linalg.eigh(information)
    first = np.argsort(-np.abs(values))[:3]
    got = {r["word"]: r["vector"] for r in wv.word_vectors(tokens, "words", 3, 1, 2, rounds=25).collect()}
    assert sorted(got) == names and "lone" not in got
    mine = np.array([got[w] for w in names])
    assert np.allclose(mine @ mine.T, basis[:, first] * np.abs(values[first]) @ basis[:, first].T, atol=1e-4)
    assert wv.word_vectors(tokens.limit(0), "words").count() == 0


def test_vectors_do_not_depend_on_what_is_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(5)
    tokens = spark.createDataFrame([([f"w{k}" for k in rng.zipf(1.5, 40) % 60],) for _ in range(80)], "words array<string>")
    got = []
    for frequent, entries in ((1_000, 1 << 23), (7, 100)):
        monkeypatch.setattr(wv, "FREQUENT", frequent)
        monkeypatch.setattr(wv, "BUCKET_ENTRIES", entries)
        got.append({r["word"]: r["vector"] for r in wv.word_vectors(tokens, "words", 4, 1, 2, rounds=2).collect()})
    assert len(got[0]) > 20 and got[0].keys() == got[1].keys()
    assert all(np.allclose(got[0][w], got[1][w], atol=1e-9) for w in got[0])


def test_matrix_is_not_moved_in_a_product(spark, tmp_path, monkeypatch):
    plans = []
    times = wv._times

    def seen(*given):
        plans.append(plan_of(times(*given)))
        return times(*given)

    monkeypatch.setattr(wv, "_times", seen)
    monkeypatch.setattr(wv, "FREQUENT", 2)
    tokens = spark.createDataFrame([(list("abcdeafbgch"),)] * 3, "words array<string>")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wv.word_vectors(tokens, "words", 2, 1, 2, rounds=2).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plans
    for plan in plans:
        keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert len(keys) == 2 and sum("_key" in line for line in keys) == 1, plan  # the vectors and the sums


def test_words_with_one_hash_get_another(spark, monkeypatch):
    """A seed under which two words share a number is not used, so every word keeps its own vector."""
    hashed = F.xxhash64
    monkeypatch.setattr(wv.F, "xxhash64", lambda c, *seed: F.lit(7).cast("long") if seed and str(seed[0]) == str(F.lit(0)) else hashed(c, *seed))
    numbered, seed = wv.numbered_words(spark.createDataFrame([("a",), ("b",), ("c",)], "word string"))
    assert seed == 1 and numbered.select("id").distinct().count() == 3


def test_matrix_is_stored_as_few_rows_and_scanned_once_in_a_product(spark, monkeypatch):
    plans, rows, times = [], [], wv._times

    def seen(matrix, *given):
        rows.append(matrix.count())
        plans.append(plan_of(times(matrix, *given)))
        return times(matrix, *given)

    monkeypatch.setattr(wv, "_times", seen)
    monkeypatch.setattr(wv, "FREQUENT", 9)
    rng = np.random.default_rng(6)
    tokens = spark.createDataFrame([([f"w{k}" for k in rng.integers(0, 90, 40)],) for _ in range(60)], "words array<string>")
    assert wv.word_vectors(tokens, "words", 3, 1, 2, rounds=2).count() == 90
    parts = 2 * spark.sparkContext.defaultParallelism
    assert all(n <= parts for n in rows) and all(plan.count("word_matrix_") == plans[0].count("word_matrix_") for plan in plans)
    assert sum("Scan" in line and "word_matrix_" in line for line in plans[0].splitlines()) == 1
