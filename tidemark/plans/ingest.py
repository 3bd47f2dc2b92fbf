"""Scan, reshape, filter and join queries."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import ids
from tidemark.operators import ingest as ing
from tidemark.plans import snippets as sq
from tidemark.plans.registry import query
from tidemark.plans.words import _documents
from tidemark.session import spread
from tidemark.sources import tables, webpages

_COUNTED = ("documents", "events", "conversations", "pages", "embeddings", "labels")
CUTOFF = datetime(2024, 1, 20)


@query("scan_count", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in _COUNTED))
def scan_count(spark: SparkSession, root: str) -> DataFrame:
    parts = [
        tables.load_table(spark, root, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("name"), "n")
        for t in _COUNTED
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "range_scan",
    "SELECT event_id, ts, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'",
)
def range_scan(spark: SparkSession, root: str) -> DataFrame:
    events = tables.load_table(spark, root, "events")
    found = ing.time_range(events, "ts", ids.moment(datetime(2024, 1, 10)), ids.moment(datetime(2024, 1, 12)))
    return found.select("event_id", "ts", "user_id")


@query(
    "replay_order",
    """SELECT event_id, ts, floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-20')) / 60000000)::BIGINT AS replay_delay_s,
      round((epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts, event_id))) / 1000000.0, 6) AS gap_s
    FROM events WHERE ts > TIMESTAMP '2024-01-20' ORDER BY ts, event_id""",
)
def replay_order(spark: SparkSession, root: str) -> DataFrame:
    """Events after the cutoff in time order, with replay delay and distance to the one before."""
    cutoff = ids.moment(CUTOFF)
    events = tables.load_table(spark, root, "events").select("event_id", "ts").where(F.col("ts") > cutoff)
    gap = ids.epoch_seconds(F.col("ts")) - ids.epoch_seconds(F.col("previous_ts"))
    linked = ing.with_previous_time(events, "ts", "event_id")
    return linked.select("event_id", "ts", ing.replay_delay(F.col("ts"), cutoff).alias("replay_delay_s"), F.round(gap, 6).alias("gap_s"))


@query("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(spark: SparkSession, root: str) -> DataFrame:
    events = tables.load_table(spark, root, "events")
    return events.select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


@query(
    "kafka_envelope",
    """SELECT 'raw_data' AS key, concat('{"message":"', event_type, '","created_utc":"',
      strftime(ts, '%Y-%m-%d %H:%M:%S'), '"}') AS value FROM events""",
)
def kafka_envelope(spark: SparkSession, root: str) -> DataFrame:
    events = tables.load_table(spark, root, "events")
    return ing.envelope(F.col("event_type"), F.col("ts"), events)


@query(
    "first_per_partition",
    """SELECT event_type, ts, event_id, user_id FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def first_per_partition(spark: SparkSession, root: str) -> DataFrame:
    events = tables.load_table(spark, root, "events")
    return ing.first_per_partition(events, ["event_type"], ["ts", "event_id"], ["user_id"])


@query(
    "landed_pages_dedup",
    """SELECT doc_id AS id, crawl, n_chars FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY crawl DESC) AS rn FROM (
        SELECT d.doc_id, 2 AS crawl, d.n_chars + 1 AS n_chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id
        UNION ALL SELECT doc_id, 1 AS crawl, n_chars FROM documents)) WHERE rn = 1""",
)
def landed_pages_dedup(spark: SparkSession, root: str) -> DataFrame:
    """A full crawl and a later one of the labelled documents, which have changed; the newer row of an id stays."""
    documents = tables.load_table(spark, root, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    labels = tables.load_table(spark, root, "labels").select(F.col("doc_id").alias("id"))
    later = documents.join(labels, "id", "left_semi").select("id", F.lit(2).alias("crawl"), (F.col("n_chars") + 1).alias("n_chars"))
    return ing.dedup_pages([later, documents.select("id", F.lit(1).alias("crawl"), "n_chars")], "id", "crawl")


@query(
    "comments_capped",
    """SELECT concat(conv_id, '-', turn) AS id, conv_id, turn, role AS author FROM (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn,
        count(*) FILTER (WHERE role = 'user') OVER (PARTITION BY conv_id) AS cap
      FROM conversations) WHERE rn <= cap""",
)
def comments_capped(spark: SparkSession, root: str) -> DataFrame:
    """The newest comments of every post, as many as the post reports (here: its user turns)."""
    comments = tables.comments(spark, root).select("id", "conv_id", "turn", "author")
    caps = comments.groupBy("conv_id").agg(F.count_if(F.col("author") == "user").alias("cap"))
    return ing.capped_per_post(comments, "conv_id", "turn", caps)


NEWEST = 0.3


@query(
    "newest_events",
    f"""SELECT event_type, event_id, ts FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS rn,
        ceil(count(*) OVER (PARTITION BY event_type) * {NEWEST}::DOUBLE) AS cap
      FROM events) WHERE rn <= cap""",
)
def newest_events(spark: SparkSession, root: str) -> DataFrame:
    """The newest three tenths of every type's events, by times to the microsecond; a type holds a fifth of all rows or so."""
    events = tables.load_table(spark, root, "events").select("event_type", "event_id", "ts")
    caps = events.groupBy("event_type").agg(F.ceil(F.count(F.lit(1)) * F.lit(NEWEST)).alias("cap"))
    return ing.capped_per_post(events, "event_type", "ts", caps)


@query(
    "thread_flatten",
    """WITH RECURSIVE c AS (
      SELECT concat(conv_id, '-', turn) AS id, length(text)::BIGINT AS n, conv_id,
        CASE WHEN turn > 0 THEN concat(conv_id, '-', turn - 1) ELSE concat('t3_', conv_id) END AS parent_id FROM conversations),
    t AS (
      SELECT id, 0 AS depth FROM c WHERE starts_with(parent_id, 't3_')
      UNION ALL SELECT c.id, t.depth + 1 FROM c JOIN t ON c.parent_id = t.id)
    SELECT t.id, t.depth, p.n AS parent_length FROM t JOIN c ON c.id = t.id LEFT JOIN c p ON p.id = c.parent_id""",
)
def thread_flatten(spark: SparkSession, root: str) -> DataFrame:
    """Comments landed twice, each of them once with its depth and the length of what it answers."""
    comments = tables.comments(spark, root)
    landed = comments.select("id", "parent_id")
    depths = ing.thread_tree(landed.unionAll(landed))
    parents = comments.select(F.col("id").alias("parent_id"), F.length("body").cast("bigint").alias("parent_length"))
    return depths.join(parents, "parent_id", "left").select("id", "depth", "parent_length")


@query(
    "thread_places",
    """WITH RECURSIVE c AS (
      SELECT concat(conv_id, '-', turn) AS id, concat('t3_', conv_id) AS post,
        CASE WHEN turn > 0 THEN concat(conv_id, '-', (turn - 1) // 3) ELSE concat('t3_', conv_id) END AS parent_id
      FROM conversations),
    t AS (
      SELECT id, post, 0 AS depth, [id] AS path FROM c WHERE parent_id = post
      UNION ALL SELECT c.id, c.post, t.depth + 1, list_append(t.path, c.id) FROM c JOIN t ON c.parent_id = t.id)
    SELECT id, post, depth, row_number() OVER (PARTITION BY post ORDER BY path) - 1 AS place FROM t""",
)
def thread_places(spark: SparkSession, root: str) -> DataFrame:
    """Every turn answers the one at a third of its number; the place of each comment in the flattened thread."""
    above = F.concat_ws("-", "conv_id", F.expr("(turn - 1) DIV 3"))
    comments = tables.comments(spark, root).select("id", F.when(F.col("turn") > 0, above).otherwise(F.col("link_id")).alias("parent_id"))
    return ing.thread_places(comments.unionAll(comments)).select("id", "post", "depth", "place")


@query(
    "post_comments",
    "SELECT conv_id AS id, count(*) AS num_comments, count(DISTINCT role) AS num_authors FROM conversations GROUP BY conv_id",
)
def post_comments(spark: SparkSession, root: str) -> DataFrame:
    comments = tables.comments(spark, root)
    posts = comments.where(F.col("parent_id") == F.col("link_id")).select(F.col("conv_id").cast("string").alias("id"))
    return ing.post_comments(posts, comments).withColumn("id", F.col("id").cast("bigint"))


@query(
    "comments_by_post",
    """SELECT concat(conv_id, '-', turn) AS id, concat('t3_', conv_id) AS link_id FROM conversations
    WHERE regexp_matches(concat('t3_', conv_id), 't3_1')""",
)
def comments_by_post(spark: SparkSession, root: str) -> DataFrame:
    return ing.comments_by_post(tables.comments(spark, root), "t3_1").select("id", "link_id")


@query(
    "active_posts",
    """SELECT conv_id AS id, first_role AS author, n::BIGINT AS num_comments FROM (
      SELECT conv_id, count(*) AS n, arg_min(role, turn) AS first_role FROM conversations GROUP BY conv_id)
    WHERE n > 1 AND first_role <> 'system'""",
)
def active_posts(spark: SparkSession, root: str) -> DataFrame:
    per_post = tables.load_table(spark, root, "conversations").groupBy(F.col("conv_id").alias("id")).agg(
        F.min_by("role", "turn").alias("author"), F.count(F.lit(1)).alias("num_comments")
    )
    return ing.active_posts(per_post, min_comments=2, excluded=("system",))


@query(
    "user_bundle",
    "SELECT source AS author, count(*) OVER (PARTITION BY source) AS n_records, doc_id FROM documents",
)
def user_bundle(spark: SparkSession, root: str) -> DataFrame:
    records = tables.load_table(spark, root, "documents").select(F.col("source").alias("author"), "doc_id")
    return ing.user_bundle(records, "author", "doc_id", ["doc_id"])


@query("project_fields", "SELECT doc_id, lang, source FROM documents")
def project_fields(spark: SparkSession, root: str) -> DataFrame:
    documents = tables.load_table(spark, root, "documents")
    return ing.project_fields(documents, ["doc_id", "lang", "source", "text"], drop=["text", "body_html"])


@query("drop_private", "SELECT doc_id, lang, source FROM documents")
def drop_private(spark: SparkSession, root: str) -> DataFrame:
    documents = tables.load_table(spark, root, "documents")
    return ing.drop_private(documents.withColumnsRenamed({"n_chars": "_n_chars", "text": "_text"}))


@query(
    "flatten_author",
    "SELECT doc_id, source AS author, lang AS subreddit FROM documents WHERE source <> 'src0'",
)
def flatten_author(spark: SparkSession, root: str) -> DataFrame:
    """Authors and subreddits as nested records, the author missing for one source."""
    documents = tables.load_table(spark, root, "documents").select(
        "doc_id",
        F.when(F.col("source") != "src0", F.struct(F.col("source").alias("name"))).alias("author"),
        F.struct(F.col("lang").alias("display_name")).alias("subreddit"),
    )
    return ing.flatten_author(documents)


@query(
    "comment_record",
    """SELECT concat(conv_id, '-', turn) AS comment_id, text AS raw_text, role AS author_name,
      concat('t3_', conv_id) AS permalink, 1704067200.0::DOUBLE AS insert_time FROM conversations""",
)
def comment_record(spark: SparkSession, root: str) -> DataFrame:
    return ing.comment_record(tables.comments(spark, root), 1704067200.0)


@query("labeled_docs_semi", "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def labeled_docs_semi(spark: SparkSession, root: str) -> DataFrame:
    documents = tables.load_table(spark, root, "documents").select("doc_id", "lang", "source")
    return documents.join(tables.load_table(spark, root, "labels").select("doc_id"), "doc_id", "left_semi")


@query("unanalyzed_docs", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unanalyzed_docs(spark: SparkSession, root: str) -> DataFrame:
    documents = tables.load_table(spark, root, "documents").select("doc_id")
    return ing.new_rows(documents, tables.load_table(spark, root, "labels"), "doc_id")


@query(
    "incremental_copy",
    "SELECT doc_id, source, n_chars, doc_id IN (SELECT doc_id FROM labels) AS had FROM documents",
)
def incremental_copy(spark: SparkSession, root: str) -> DataFrame:
    """A target that already holds the labelled documents, after two runs of the copy."""
    from tidemark.session import run_folder

    fields = ["doc_id", "source", "n_chars", "had"]
    documents = tables.load_table(spark, root, "documents")
    labels = tables.load_table(spark, root, "labels").select("doc_id")
    target = run_folder(spark, "incremental-copy")
    documents.join(labels, "doc_id", "left_semi").withColumn("had", F.lit(True)).select(*fields).write.parquet(target)
    source = documents.withColumn("had", F.lit(False))
    source = source.unionByName(source)  # every id twice
    for _ in range(2):
        ing.incremental_copy(source, target, "doc_id", fields)
    return spark.read.schema(source.select(*fields).schema).parquet(target)


@query(
    "date_spine",
    """SELECT d.day, coalesce(e.n, 0) AS n FROM (
      SELECT unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-05', INTERVAL 1 DAY))::DATE AS day) d
    LEFT JOIN (SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1) e ON d.day = e.day""",
)
def date_spine(spark: SparkSession, root: str) -> DataFrame:
    per_day = tables.load_table(spark, root, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return ing.date_spine(per_day, "day", "2024-01-01", "2024-02-05")


@query(
    "rule_filter",
    f"""SELECT doc_id FROM (SELECT doc_id, text, {sq.tokens('text')} AS toks FROM documents WHERE lang = 'en')
    WHERE NOT starts_with(text, 'RT @') AND NOT regexp_matches(text, '(^|\\s)@\\w')
      AND list_contains(toks, 'thing') AND list_has_any(toks, ['ering', 'oning', 'thble'])""",
)
def rule_filter(spark: SparkSession, root: str) -> DataFrame:
    documents = _documents(spark, root, "text", "lang")
    rule = ing.follows_rule(F.col("text"), F.col("lang"), "thing", ["ering", "oning", "thble"])
    return documents.where(rule).select("doc_id")


@query(
    "mention_search",
    f"""SELECT doc_id, source FROM (SELECT *, concat('thanks @', source, ', ', text) AS said FROM documents)
    WHERE list_contains(regexp_extract_all(said, '(?:^|[^A-Za-z0-9_@])@([A-Za-z0-9_]+)', 1), 'src3')
    ORDER BY doc_id DESC LIMIT {ing.MENTION_LIMIT}""",
)
def mention_search(spark: SparkSession, root: str) -> DataFrame:
    documents = tables.load_table(spark, root, "documents")
    said = F.concat(F.lit("thanks @"), "source", F.lit(", "), "text")
    return ing.mentioning(documents, said, "src3", F.desc("doc_id")).select("doc_id", "source")


@query("offset_limit", "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 50 OFFSET 100")
def offset_limit(spark: SparkSession, root: str) -> DataFrame:
    """Resume a listing: skip what was done, take the next page."""
    return tables.load_table(spark, root, "documents").select("doc_id", "source").orderBy("doc_id").offset(100).limit(50)


@query(
    "base36_ids",
    """SELECT doc_id, to_base(doc_id, 36) AS code, doc_id AS decoded, concat('t3_', to_base(doc_id, 36)) AS link_id FROM documents""",
)
def base36_ids(spark: SparkSession, root: str) -> DataFrame:
    coded = tables.load_table(spark, root, "documents").select("doc_id", ids.base36_encode(F.col("doc_id")).alias("code"))
    return coded.withColumns(
        {"decoded": ids.base36_decode(F.col("code")), "link_id": F.concat(F.lit(ids.SUBMISSION_PREFIX), "code")}
    )


@query(
    "url_parts",
    """SELECT page_id, split_part(split_part(split_part(split_part(url, '://', 2), '#', 1), '?', 1), '/', 1) AS host,
      split_part(split_part(split_part(split_part(url, '://', 2), '#', 1), '?', 1), '/', 2) AS first_segment FROM pages""",
)
def url_parts(spark: SparkSession, root: str) -> DataFrame:
    pages = tables.load_table(spark, root, "pages")
    return pages.select(
        "page_id", ids.url_host(F.col("url")).alias("host"), ids.url_first_segment(F.col("url")).alias("first_segment")
    )


@query(
    "page_link_texts",
    """SELECT * FROM (SELECT page_id, unnest(regexp_extract_all(html, '<li><a[^>]*>([^<]*)</a>', 1)) AS link_text FROM pages)
    WHERE starts_with(link_text, 'th')""",
)
def page_link_texts(spark: SparkSession, root: str) -> DataFrame:
    pages = spread(tables.load_table(spark, root, "pages").select("page_id", "html"), "page_id")
    return webpages.link_texts(pages, F.col("html"), "th", "page_id")


@query(
    "page_title",
    """SELECT page_id, CASE WHEN contains(html, '<title>') THEN split_part(split_part(html, '<title>', 2), '</title>', 1) END AS title
    FROM pages""",
)
def page_title(spark: SparkSession, root: str) -> DataFrame:
    pages = spread(tables.load_table(spark, root, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", webpages.labelled_value(F.col("html")).alias("title"))
