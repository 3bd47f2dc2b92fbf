import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.functions import ids
from tidemark.operators import ingest as ing
from tidemark.sources import webpages, writers


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ids(spark):
    row = spark.range(1).select(
        ids.base36_decode(F.lit("11abc")).alias("n"),
        ids.base36_encode(F.lit(1739640)).alias("code"),
        ids.profile_name(F.lit(" https://twitter.com/FamousFoxFed?x=1 ")).alias("user"),
        ids.profile_name(F.lit("https://example.com/a")).alias("none"),
        ids.epoch_seconds(ids.moment(datetime(2024, 1, 1, 1, 2, 3, 500000))).alias("s"),
        ids.epoch_seconds(ids.moment(datetime(1969, 12, 31, 23, 59, 59))).alias("before"),
        F.unix_micros(ids.utc(ids.moment(datetime(2024, 1, 1)))).alias("u"),
    ).first()
    assert tuple(row) == (1739640, "11ABC", "FamousFoxFed", "", 1704070923.5, -1.0, 1704067200000000)


def test_profile_names(spark):
    names = {
        "https://twitter.com/#!/old": "old", "http://www.Twitter.com/@at/": "at", "https://twitter.com//name//?a=/b": "name",
        "https://twitter.com/name/status/1": "", "https://twitter.com": "", "https://twitter.com/": "", "https://twitter.com/#!/a/b": "",
        "https://nottwitter.com/name": "", "https://twitter.com.example/name": "", "twitter.com/name": "", None: "",
        "https://twitter.com:443/name#x": "name", "https://twitter.com/?x=1#!/behind": "behind", "https://x.com/a": "",
    }
    df = spark.createDataFrame([(k,) for k in names], "url string")
    assert {r["url"]: r["name"] for r in df.select("url", ids.profile_name(F.col("url")).alias("name")).collect()} == names


def test_projection_is_strict_but_drop_is_not(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, _c int")
    assert ing.project_fields(df, ["a", "b"], drop=["b", "body_html"]).columns == ["a"]
    assert ing.drop_private(df).columns == ["a", "b"]
    with pytest.raises(AnalysisException):
        ing.project_fields(df, ["missing"])


def test_flatten_rejects_missing_names(spark):
    schema = "i int, author struct<name:string>, subreddit struct<display_name:string>"
    df = spark.createDataFrame([(1, ("a",), ("s",)), (2, None, ("s",)), (3, ("a",), None)], schema)
    assert rows(ing.flatten_author(df)) == [(1, "a", "s")]


def test_active_posts_keep_missing_authors(spark):
    df = spark.createDataFrame([(1, 1, "ann"), (2, 2, "[deleted]"), (3, 2, None), (4, 2, "ann")], "id int, num_comments int, author string")
    assert [r["id"] for r in ing.active_posts(df).orderBy("id").collect()] == [3, 4]
    assert [r["id"] for r in ing.active_posts(df, before=F.col("id") < 4).collect()] == [3]


def test_rule(spark):
    data = [("Amazon layoff news", "en"), ("RT @a Amazon layoff", "en"), ("Amazon layoff @bob", "en"), ("Amazon layoff", "fr"),
            ("Amazon sale", "en"), ("amazon: LAYOFF!", "en"), ("amazonian layoff", "en"), ("Amazon layoff a@b", "en"), ("@x Amazon layoff", "en")]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "i int, text string, lang string")
    rule = ing.follows_rule(F.col("text"), F.col("lang"), "amazon", ["interview", "layoff", "engineer"])
    assert [r["i"] for r in df.where(rule).orderBy("i").collect()] == [0, 5, 7]


def test_mentions(spark):
    data = ["hi @ann", "@ann!", "x@ann", "@anna", "@@ann", "none", "(@ann)"]
    df = spark.createDataFrame(list(enumerate(data)), "i int, text string")
    assert [r["i"] for r in ing.mentioning(df, F.col("text"), "ann", F.desc("i")).collect()] == [6, 1, 0]
    assert [r["i"] for r in ing.mentioning(df, F.col("text"), "ann", F.desc("i"), limit=2).collect()] == [6, 1]


def test_previous_time_equals_global_lag(spark):
    rng = random.Random(5)
    data = [(i, f"2024-01-{rng.choice([1, 1, 1, 2, 9]):02d} {rng.choice([0, 5, 23]):02d}:{rng.randint(0, 2):02d}:00") for i in range(300)]
    df = spark.createDataFrame(data, "k int, at string").select("k", F.col("at").cast("timestamp_ntz").alias("ts"))
    got = {r["k"]: r["previous_ts"] for r in ing.with_previous_time(df, "ts", "k").collect()}
    ordered = sorted((datetime.fromisoformat(a), k) for k, a in data)
    want = {ordered[0][1]: None, **{k: before for (before, _), (_, k) in zip(ordered, ordered[1:])}}
    assert got == want


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_cap_equals_brute_force(spark, width):
    rng = random.Random(7)
    data = [(p, o) for p, n in enumerate([1, 40, 7, 200, 3]) for o in rng.sample(range(5000), n)]
    caps = {0: 5, 1: 10, 2: 7, 3: 133, 4: 0}
    df = spark.createDataFrame(data, "post int, o int")
    got = ing.capped_per_post(df, "post", "o", spark.createDataFrame(list(caps.items()), "post int, cap int"), width)
    want = [x for p, c in caps.items() for x in sorted((d for d in data if d[0] == p), reverse=True)[:c]]
    assert rows(got) == sorted(want)


def test_cap_of_a_hot_post_ranks_only_its_last_slice(spark):
    """A third of all comments in one post, times by the microsecond, crowded at the end; equal times; rows without time."""
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    data = [(0, i, start + timedelta(microseconds=10**13 - int(rng.random() ** 4 * 10**13) - i)) for i in range(3000)]
    data += [(1 + i % 600, 3000 + i, start + timedelta(microseconds=rng.randrange(10**12))) for i in range(6000)]
    data += [(700, 9000 + i, start) for i in range(30)] + [(701, 9100, None), (None, 9101, start)]
    df = spark.createDataFrame(data, "post int, id int, ts timestamp_ntz")
    caps = spark.createDataFrame([(0, 1234), (700, 7), (701, 3), *[(i, 1 + i % 12) for i in range(1, 600)]], "post int, cap int")
    got = ing.capped_per_post(df, "post", "ts", caps, 20).collect()
    kept = dict(caps.collect())
    by_post = {}
    for post, i, ts in data:
        if post is not None and ts is not None:
            by_post.setdefault(post, []).append((ts, i))
    for post, found in by_post.items():
        mine = [r["id"] for r in got if r["post"] == post]
        if post == 700:
            assert len(mine) == len(set(mine)) == 7
        else:
            assert sorted(mine) == sorted(i for _, i in sorted(found, reverse=True)[: kept.get(post, 0)])
    assert not [r for r in got if r["post"] in (None, 701)]
    bounds = ing.cap_bounds(df.select("post", ing.order_number(df, "ts").alias("_at")), "post", caps, 20)
    at = {post: sorted((ts - datetime(1970, 1, 1)) // timedelta(microseconds=1) for ts, _ in f) for post, f in by_post.items()}
    for r in bounds.collect():
        if r["post"] != 700:
            assert sum(r["_low"] <= x <= r["_high"] for x in at[r["post"]]) <= 20


def test_pages_and_cap(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "id int, t int")
    b = spark.createDataFrame([(2, 20), (3, 30)], "id int, t int")
    assert rows(ing.dedup_pages([a, b], "id", "t")) == [(1, 10), (2, 20), (3, 30)]
    assert rows(ing.dedup_pages([a, b], "id", "t", 2)) == [(2, 20), (3, 30)]


def test_newest_page_stays(spark):
    a = spark.createDataFrame([(1, 7, 1), (2, 5, 3)], "id int, n int, t int")
    b = spark.createDataFrame([(1, 9, 2), (2, 9, 2)], "id int, n int, t int")
    for pages in ([a, b], [b, a]):
        assert rows(ing.dedup_pages(pages, "id", "t")) == [(1, 9, 2), (2, 5, 3)]


def test_dedup_texts(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, "ab"), (3, "c")], "id int, text string")
    assert sorted((r["id"], r["copies"]) for r in ing.dedup_texts(df, "id", F.col("text")).collect()) == [(1, 2), (3, 1)]


def test_incremental_copy(spark, tmp_path):
    target = str(tmp_path / "target")
    spark.createDataFrame([(2, "old")], "id int, v string").write.parquet(target)
    source = spark.createDataFrame([(i, "new", i) for i in (1, 2, 3)], "id int, v string, extra int")
    for _ in range(2):
        ing.incremental_copy(source, target, "id", ["id", "v"], per_file=1)
        assert rows(spark.read.parquet(target)) == [(1, "new"), (2, "old"), (3, "new")]
    fresh = str(tmp_path / "fresh")
    ing.incremental_copy(source, fresh, "id", ["id", "v"])
    assert spark.read.parquet(fresh).count() == 3
    repeated = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "id int, v string")
    ing.incremental_copy(repeated, str(tmp_path / "once"), "id", ["id", "v"])
    assert rows(spark.read.parquet(str(tmp_path / "once"))) == [(1, "a"), (2, "c")]


def tree(n, seed):
    rng = random.Random(seed)
    parent = {i: (f"c{rng.randrange(i)}" if i and rng.random() < 0.9 else "t3_p") for i in range(n)}
    depth = {}
    for i in range(n):
        depth[f"c{i}"] = 0 if parent[i] == "t3_p" else depth[parent[i]] + 1
    return [(f"c{i}", p) for i, p in parent.items()], depth


def test_depths_equal_brute_force(spark):
    data, want = tree(120, 2)
    assert dict(rows(ing.thread_depths(spark.createDataFrame(data, "id string, parent_id string")))) == want


def test_depths_of_chain_orphan_and_loop(spark):
    chain = [("c0", "t3_p")] + [(f"c{i}", f"c{i - 1}") for i in range(1, 3000)]
    odd = [("o", "gone"), ("o2", "o"), ("n", None), ("l1", "l2"), ("l2", "l1"), ("under", "l1"), ("self", "self")]
    df = spark.createDataFrame(chain + odd, "id string, parent_id string")
    assert dict(rows(ing.thread_depths(df))) == {f"c{i}": i for i in range(3000)}


def test_user_bundle(spark):
    df = spark.createDataFrame([("a", i, f"t{i}") for i in range(5)] + [("b", 1, "x")], "user string, o int, text string")
    got = rows(ing.user_bundle(df, "user", "o", ["o", "text"]))
    assert got == [("a", 5, i, f"t{i}") for i in range(5)] + [("b", 1, 1, "x")]


def test_envelope_and_comment_record(spark):
    df = spark.createDataFrame([("c1", 'say "hi"', "ann", "t3_x", "2024-01-01 02:03:04.5")], "id string, body string, author string, link_id string, at string")
    row = ing.envelope(F.col("body"), F.col("at").cast("timestamp_ntz"), df).first()
    assert tuple(row) == ("raw_data", '{"message":"say \\"hi\\"","created_utc":"2024-01-01 02:03:04"}')
    record = ing.comment_record(df, 5.0).first()
    assert (record["comment_id"], record["raw_text"], record["insert_time"]) == ("c1", 'say "hi"', 5.0)


def test_web_pages(spark):
    html = "<title>T</title><ul><li><a href='x'>CVE-2023-1</a></li><li><a>xCVE-2023-2</a></li></ul>"
    df = spark.createDataFrame([(1, html), (2, "<p>")], "id int, html string")
    assert rows(webpages.link_texts(df, F.col("html"), r"CVE-2023-\d+", "id")) == [(1, "CVE-2023-1")]
    assert rows(df.select("id", webpages.labelled_value(F.col("html")))) == [(1, "T"), (2, None)]


def test_append_splits_files(spark, tmp_path):
    path = str(tmp_path / "out")
    for _ in range(2):
        writers.append(spark.range(5).withColumn("d", F.col("id") % 2), path, partition_by="d", per_file=2)
    assert spark.read.parquet(path).count() == 10


def test_previous_rows_across_ranges(spark):
    """A time that a third of all rows have is cut by the key; every row finds the one before it."""
    df = spark.createDataFrame([(i, 7 if i % 3 == 0 else i * 37 % 1_000) for i in range(3_000)], "k long, ts int")
    got = [(r["ts"], r["k"], r["previous_ts"], r["previous_k"]) for r in ing.with_previous(df, ["ts", "k"], ["ts", "k"]).collect()]
    want = sorted((7 if i % 3 == 0 else i * 37 % 1_000, i) for i in range(3_000))
    assert got == [(*row, *before) for row, before in zip(want, [(None, None), *want[:-1]], strict=True)]
    assert ing.with_previous(df.limit(0), ["ts", "k"], ["ts"]).count() == 0


def test_comments_landed_twice(spark):
    chain = [(f"c{i}", f"c{i - 1}" if i else "t3_p") for i in range(2_000)]
    cycle = [("x", "y"), ("y", "x"), ("z", "x"), ("gone", "missing"), (None, "t3_p"), ("null", None)]
    df = spark.createDataFrame(chain * 2 + cycle * 3, "id string, parent_id string")
    found = rows(ing.thread_depths(df))
    assert len(found) == 2_000 and dict(found) == {f"c{i}": i for i in range(2_000)}


def test_places_read_threads_top_down(spark):
    import random

    rng = random.Random(4)
    edges = [(f"p{k}-{i:03}", f"p{k}-{rng.randrange(i):03}" if i and rng.random() < 0.8 else f"t3_p{k}") for k in range(5) for i in range(60)]
    answers = {}
    for i, parent in sorted(edges):
        answers.setdefault(parent, []).append(i)
    want = {}

    def read(i, post, depth):
        want[i] = (post, depth, sum(w[0] == post for w in want.values()))
        for a in answers.get(i, []):
            read(a, post, depth + 1)

    for k in range(5):
        for i in answers[f"t3_p{k}"]:
            read(i, f"t3_p{k}", 0)
    df = spark.createDataFrame(edges * 2 + [("a", "b"), ("b", "a")], "id string, parent_id string")
    assert {r["id"]: (r["post"], r["depth"], r["place"]) for r in ing.thread_places(df).collect()} == want
