"""Landed records: reshaping, filters, deduplication, threads, incremental copies."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType, TimestampType
from pyspark.sql.window import Window as W

from tidemark.functions import ids, text as tx
from tidemark.session import run_folder

if TYPE_CHECKING:
    import pyarrow as pa

# Author names with a meaning, the topic key, the page size of a mention search.
DELETED_AUTHOR = "[deleted]"
MODERATOR = "AutoModerator"
TOPIC_KEY = "raw_data"
MENTION_LIMIT = 50


# --- reshaping ----------------------------------------------------------------------------


def project_fields(df: DataFrame, fields: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Named fields only (an unknown one is an error), then drop others if they are there."""
    return df.select(*fields).drop(*drop)


def drop_private(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def flatten_author(df: DataFrame) -> DataFrame:
    """Nested author and subreddit -> their names; records that lack one are rejected."""
    nested = {"author": "name", "subreddit": "display_name"}
    flat = df.withColumns({c: F.col(f"{c}.{f}") for c, f in nested.items() if c in df.columns})
    return flat.dropna(subset=[c for c in nested if c in df.columns])


def comment_record(df: DataFrame, insert_time: float) -> DataFrame:
    """Comment -> stream record, stamped with one time for the whole batch."""
    return df.select(
        F.col("id").alias("comment_id"),
        F.col("body").alias("raw_text"),
        F.col("author").alias("author_name"),
        F.col("link_id").alias("permalink"),
        F.lit(float(insert_time)).alias("insert_time"),
    )


def envelope(message: Column, created: Column, df: DataFrame) -> DataFrame:
    """(key, value) rows for a topic; value is the record as JSON, time to the second."""
    record = F.struct(
        message.alias("message"), F.substring(created.cast("string"), 1, 19).alias("created_utc")
    )
    return df.select(F.lit(TOPIC_KEY).alias("key"), F.to_json(record).alias("value"))


# --- filters ------------------------------------------------------------------------------


def active_posts(
    df: DataFrame, min_comments: int = 2, excluded: Sequence[str] = (DELETED_AUTHOR,), before: Column | None = None
) -> DataFrame:
    """Posts with enough comments by a real author; a missing author is not a deleted one."""
    kept = df.where((F.col("num_comments") >= min_comments) & ~F.coalesce(F.col("author").isin(list(excluded)), F.lit(False)))
    return kept if before is None else kept.where(before)


def time_range(df: DataFrame, ts: str, start: Column, end: Column) -> DataFrame:
    """start <= ts < end on the bare column, so the scan can skip row groups."""
    return df.where((F.col(ts) >= start) & (F.col(ts) < end))


def comments_by_post(comments: DataFrame, pattern: str) -> DataFrame:
    """Comments whose link id contains a pattern anywhere."""
    return comments.where(F.col("link_id").rlike(pattern))


def follows_rule(text: Column, lang: Column, keyword: str, any_of: Sequence[str], wanted_lang: str = "en") -> Column:
    """keyword AND (a OR b ..), in one language, no repost, no mention. Cheap tests come first."""
    lowered = F.lower(text)
    return (
        (lang == wanted_lang)
        & ~text.startswith("RT @")
        & lowered.contains(keyword.lower())
        & ~text.rlike(r"@(?<![^ \n\r\t]@)[A-Za-z0-9_]")
        & lowered.rlike(tx.whole_word([keyword.lower()]))
        & lowered.rlike(tx.whole_word([w.lower() for w in any_of]))
    )


def mentioning(df: DataFrame, text: Column, user: str, order: Column, limit: int = MENTION_LIMIT) -> DataFrame:
    """The latest rows that mention ``@user`` as a whole name."""
    name = "\\Q" + user.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    whole_name = rf"@{name}(?<![A-Za-z0-9_@]@{name})(?![A-Za-z0-9_])"
    found = df.where(text.contains(f"@{user}") & text.rlike(whole_name))
    return found.orderBy(order).limit(limit)


def replay_delay(ts: Column, cutoff: Column) -> Column:
    """Whole minutes between the cutoff and a record's time: the pause before it is replayed."""
    return F.floor((ids.epoch_seconds(ts) - ids.epoch_seconds(cutoff)) / 60)


def with_previous(df: DataFrame, order: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """Rows in global order, each with ``previous_<c>`` of the row before it (null for the first row of all).

    The rows are dealt once, by ranges of ``order``, and sorted inside their ranges; the row before is then the one
    above in the same task. Only the first row of a range looks further: the last row of every range (one row a task)
    is broadcast back. A time or key with a third of all rows is cut by the later columns of ``order``.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)  # a given number is not changed at run time
    dealt = dealt.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    names = [f"previous_{c}" for c in columns]

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        above: list[pa.Array] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = [batch.column(c) for c in columns]
            above = above or [pa.nulls(1, a.type) for a in own]
            moved = [pa.concat_arrays([x, a.slice(0, len(a) - 1)]) for x, a in zip(above, own, strict=True)]
            above = [a.slice(len(a) - 1) for a in own]
            yield pa.RecordBatch.from_arrays([*batch.columns, *moved], names=[*batch.schema.names, *names])

    added = [StructField(name, df.schema[c].dataType) for c, name in zip(columns, names, strict=True)]
    linked = dealt.mapInArrow(shift, StructType([*dealt.schema.fields, *added]))
    ends = dealt.groupBy("_part").agg(F.max("_at").alias("_last"), F.min("_at").alias("_first"), F.max_by(F.struct(*columns), "_at").alias("_end"))
    before = ends.select(F.col("_first").alias("_start"), F.lag("_end").over(W.orderBy("_part")).alias("_end"))
    joined = linked.join(F.broadcast(before), F.col("_at") == F.col("_start"), "left")
    found = {name: F.coalesce(F.col(name), F.when(F.col("_start").isNotNull(), F.col("_end")[c])) for c, name in zip(columns, names, strict=True)}
    return joined.select(*df.columns, *[f.alias(name) for name, f in found.items()])


def with_previous_time(df: DataFrame, ts: str, key: str) -> DataFrame:
    """Append ``previous_ts``: the time of the row before it in global (ts, key) order; the rows come in that order."""
    return with_previous(df, [ts, key], [ts]).withColumnRenamed(f"previous_{ts}", "previous_ts")


# --- deduplication, caps, copies ----------------------------------------------------------


def dedup_pages(pages: Sequence[DataFrame], key: str, order: str, max_rows: int | None = None) -> DataFrame:
    """Union of overlapping landed pages; of the rows of a key the one with the largest ``order`` stays.

    Rows of equal order are compared as a whole, so the result does not depend on the order of the pages.
    ``max_rows``: only so many of the newest.
    """
    merged = pages[0]
    for page in pages[1:]:
        merged = merged.unionByName(page)
    rest = [c for c in merged.columns if c not in (key, order)]
    newest = merged.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("_row"))
    unique = newest.select(key, "_row.*").select(*merged.columns)
    return unique if max_rows is None else unique.orderBy(F.desc(order), key).limit(max_rows)


def dedup_texts(df: DataFrame, id_col: str, text: Column) -> DataFrame:
    """(text_hash, id of the first copy, copies) per distinct cleaned text.

    Texts are grouped by their SHA-256, so the shuffle moves 64 characters per row; copies
    are merged before it, which keeps a text with very many copies from piling up.
    """
    hashed = df.select(F.col(id_col), F.sha2(tx.clean_text(text), 256).alias("text_hash"))
    return hashed.groupBy("text_hash").agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("copies"))


def capped_per_post(
    comments: DataFrame, post: str, order: str, caps: DataFrame, bucket_width: int = 1000
) -> DataFrame:
    """The newest ``cap`` comments of every post; ``caps`` has (post, cap), ``order`` is a whole number or a timestamp.

    The cut of each post is found by :func:`cap_bounds` from counts alone. Comments above it stay unranked, those below
    go unranked; only the last slice, of at most ``bucket_width`` comments, is sorted. ``order`` should be unique in a
    post: comments of equal order share a slice and are told apart by a hash of the row. Rows without post or order,
    and posts without a cap or with none above 0, have no row.
    """
    at = order_number(comments, order)
    bounds = cap_bounds(comments.select(F.col(post), at.alias("_at")), post, caps, bucket_width)
    near = comments.withColumn("_at", at).join(bounds, post).where(F.col("_at") >= F.col("_low"))
    sure = near.where(F.col("_at") > F.col("_high")).select(*comments.columns)
    newest = W.partitionBy(post).orderBy(F.desc("_at"), F.xxhash64(*[F.col(c) for c in comments.columns]))
    last = near.where(F.col("_at") <= F.col("_high")).withColumn("_rank", F.row_number().over(newest))
    return sure.unionByName(last.where(F.col("_rank") <= F.col("_left")).select(*comments.columns))


def order_number(df: DataFrame, order: str) -> Column:
    """An order column as a whole number: timestamps by microseconds."""
    kind = df.schema[order].dataType
    if isinstance(kind, TimestampNTZType):
        return ids.epoch_micros(F.col(order))
    return F.unix_micros(order) if isinstance(kind, TimestampType) else F.col(order).cast("bigint")


CAP_SLICES = 256


def cap_bounds(orders: DataFrame, post: str, caps: DataFrame, last_slice: int = 1000) -> DataFrame:
    """(post, _low, _high, _left): of the rows (post, _at), those above _high are within the cap, those below _low are
    beyond it, and of those in [_low, _high] the _left newest are within. At most ``last_slice`` rows of a post are in
    [_low, _high], unless they are of one order number.

    Each round counts an open post's rows in CAP_SLICES slices of its range and goes on with the slice in which the cap
    is reached, so a range of 2^50 microseconds is settled in seven rounds at most. Counts are partial aggregates:
    a post that holds most of the rows costs a task CAP_SLICES numbers. The caller's rows are read once a round, two
    columns wide; bounds of the rounds are written to the shared folder.
    """
    spark = orders.sparkSession
    folder = run_folder(spark, "cap-bounds")
    wanted = caps.where(F.col("cap") > 0).groupBy(post).agg(F.max("cap").cast("bigint").alias("_left"))
    spans = orders.where(F.col("_at").isNotNull()).groupBy(post).agg(
        F.min("_at").alias("_low"), F.max("_at").alias("_high"), F.count(F.lit(1)).alias("_rows")
    )
    found = spans.join(wanted, post).select(post, "_low", "_high", "_left", "_rows")
    found.write.parquet(f"{folder}/0")
    schema, rounds = found.schema, [f"{folder}/0"]
    settled = (F.col("_rows") <= F.greatest(F.lit(last_slice), F.lit(1))) | (F.col("_rows") <= F.col("_left")) | (F.col("_low") == F.col("_high"))
    while True:
        newest = spark.read.schema(schema).parquet(rounds[-1]).where(~settled)
        if newest.isEmpty():
            bounds = spark.read.schema(schema).parquet(*rounds).where(settled)
            whole = F.when(F.col("_rows") <= F.col("_left"), F.col("_low") - 1).otherwise(F.col("_high"))  # nothing to rank
            return bounds.withColumn("_high", whole).drop("_rows")
        width = F.floor((F.col("_high") - F.col("_low")) / CAP_SLICES).cast("bigint") + 1
        open_posts = newest.select(post, "_low", "_high", "_left", width.alias("_width"))
        inside = orders.join(open_posts, post).where(F.col("_at").between(F.col("_low"), F.col("_high")))
        slices = inside.withColumn("_slice", F.expr("(_at - _low) div _width"))
        counts = slices.groupBy(post, "_low", "_left", "_width", "_slice").agg(
            F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"), F.max("_at").alias("_last")
        )
        later = W.partitionBy(post).orderBy(F.desc("_slice")).rowsBetween(W.unboundedPreceding, -1)
        above = counts.withColumn("_above", F.coalesce(F.sum("_rows").over(later), F.lit(0)))
        cut = above.where((F.col("_above") < F.col("_left")) & (F.col("_above") + F.col("_rows") >= F.col("_left")))
        rounds.append(f"{folder}/{len(rounds)}")
        cut.select(
            post, F.col("_first").alias("_low"), F.col("_last").alias("_high"), (F.col("_left") - F.col("_above")).alias("_left"), "_rows"
        ).write.parquet(rounds[-1])


def new_rows(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` whose key the target does not hold yet."""
    return source.join(target.select(key), key, "left_anti")


def incremental_copy(source: DataFrame, target_path: str, key: str, fields: Sequence[str], per_file: int | None = None) -> None:
    """Append the rows of ``source`` the target folder lacks; a second run adds nothing.

    A key that the source holds several times is copied once: the smallest of its rows.
    """
    spark = source.sparkSession
    rest = [f for f in fields if f != key] or [key]
    once = source.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    wanted = once.select(*[F.col(key) if f == key else F.col("_row")[f].alias(f) for f in fields])
    try:
        wanted = new_rows(wanted, spark.read.schema(wanted.schema).parquet(target_path), key)
    except AnalysisException as missing:  # first run: no target yet
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    writer = wanted.write.mode("append")
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.parquet(target_path)


# --- posts, threads, users ----------------------------------------------------------------


def post_comments(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Comments and distinct authors per post. Comments are aggregated before the join."""
    per_post = comments.groupBy(F.expr("substring(link_id, 4)").alias("id")).agg(
        F.count(F.lit(1)).alias("num_comments"), F.countDistinct("author").alias("num_authors")
    )
    return posts.join(per_post, "id")


def chain_totals(links: DataFrame, name: str) -> DataFrame:
    """(key, total, last): the sum of ``weight`` from ``key`` to the end of its chain, and the key at the end.

    ``links`` has one row per key: key, next (null at the end of a chain) and weight. Every open key points ahead and
    knows the sum up to there. Each round lets it take over what the key it points to knows, so a chain of n keys needs
    log2(n) rounds. A round is written to the shared folder and read back: a key is written as settled once, and only
    the open ones are joined again. Chains that lead to a missing key drop out when the gap is reached. While a key that
    will be settled or dropped is open, each round settles one at least; a round that settles none leaves only cycles
    and what leads into them, which get no row.
    """
    spark = links.sparkSession
    folder = run_folder(spark, name)
    kind = links.schema["key"].dataType.simpleString()
    schema = f"key {kind}, next {kind}, total bigint, last {kind}"
    ended = F.when(F.col("next").isNull(), F.col("key"))
    links.select("key", "next", F.col("weight").cast("bigint").alias("total"), ended.alias("last")).write.parquet(f"{folder}/0")
    rounds, before = [f"{folder}/0"], None
    while True:
        settled = spark.read.schema(schema).parquet(*rounds).where("next IS NULL")
        unsettled = spark.read.schema(schema).parquet(rounds[-1]).where("next IS NOT NULL")
        left = unsettled.count()
        if left in (0, before):
            return settled.select("key", "total", "last")
        before = left
        ahead = unsettled.unionByName(settled)
        ahead = ahead.select(F.col("key").alias("next"), F.col("next").alias("_next"), F.col("total").alias("_more"), "last")
        moved = unsettled.select("key", "next", "total").join(ahead, "next")
        rounds.append(f"{folder}/{len(rounds)}")
        moved.select("key", F.col("_next").alias("next"), (F.col("total") + F.col("_more")).alias("total"), "last").write.parquet(rounds[-1])


def thread_depths(comments: DataFrame, root_prefix: str = ids.SUBMISSION_PREFIX) -> DataFrame:
    """(id, depth) of :func:`thread_tree`."""
    return thread_tree(comments, root_prefix).select("id", "depth")


def thread_tree(comments: DataFrame, root_prefix: str = ids.SUBMISSION_PREFIX) -> DataFrame:
    """(id, post, parent_id, depth): one row per comment, 0 for a direct answer to a post, else one more than its parent.

    Landed pages overlap, so the rows are first reduced to one per id (of different parents the smallest). Comments
    under a missing parent and in cycles have no row; see :func:`chain_totals`.
    """
    once = comments.groupBy("id").agg(F.min("parent_id").alias("parent_id")).where("parent_id IS NOT NULL AND id IS NOT NULL")
    above = F.when(~F.col("parent_id").startswith(root_prefix), F.col("parent_id"))
    found = chain_totals(once.select(F.col("id").alias("key"), above.alias("next"), F.lit(1).alias("weight")), "thread-depths")
    tops = once.where(above.isNull()).select(F.col("id").alias("last"), F.col("parent_id").alias("post"))
    placed = found.join(tops, "last").select(F.col("key").alias("id"), "post", (F.col("total") - 1).cast("int").alias("depth"))
    return placed.join(once, "id").select("id", "post", "parent_id", "depth")


def thread_places(comments: DataFrame, root_prefix: str = ids.SUBMISSION_PREFIX) -> DataFrame:
    """(id, post, parent_id, depth, place): depths, and the place of each comment when its post is read top down.

    A comment stands before its answers, and answers of one parent go by id; ``place`` counts from 0 in a post. Every
    comment is entered and left: from the way in one goes to the first answer, or out again; from the way out to the next
    answer of the same parent, or out of the parent. Ranking that list (see :func:`chain_totals`) counts the ways in that
    are still to come, so neither a long chain nor a post with very many comments is ever in one task.
    """
    spark = comments.sparkSession
    folder = run_folder(spark, "thread-places")
    thread_tree(comments, root_prefix).write.parquet(folder)
    tree = spark.read.parquet(folder)
    into, out = (lambda c: F.concat(F.lit("+"), c)), (lambda c: F.concat(F.lit("-"), c))
    siblings = with_previous(tree.select("id", "parent_id"), ["parent_id", F.desc("id")], ["id", "parent_id"])
    after = F.when(F.col("previous_parent_id") == F.col("parent_id"), F.col("previous_id"))
    first = tree.groupBy(F.col("parent_id").alias("id")).agg(F.min("id").alias("answer"))
    leaving = siblings.select(
        out(F.col("id")).alias("key"),
        F.when(after.isNotNull(), into(after)).when(~F.col("parent_id").startswith(root_prefix), out(F.col("parent_id"))).alias("next"),
        F.lit(0).alias("weight"),
    )
    entering = tree.join(first, "id", "left").select(
        into(F.col("id")).alias("key"), F.coalesce(into(F.col("answer")), out(F.col("id"))).alias("next"), F.lit(1).alias("weight")
    )
    ranks = chain_totals(entering.unionByName(leaving), "thread-ranks")
    ranks = ranks.where(F.col("key").startswith("+")).select(F.substr("key", F.lit(2)).alias("id"), "total")
    sizes = tree.groupBy("post").agg(F.count(F.lit(1)).alias("size"))
    placed = tree.join(ranks, "id").join(sizes, "post")
    return placed.select("id", "post", "parent_id", "depth", (F.col("size") - F.col("total")).alias("place"))


def user_bundle(records: DataFrame, user: str, order: str, fields: Sequence[str]) -> DataFrame:
    """(user, n_records, order, fields): every record beside the number of its user's records, none left out.

    Records stay rows, so a busy user is spread like the others; the counts are partial aggregates.
    """
    totals = records.groupBy(user).agg(F.count(F.lit(1)).alias("n_records"))
    kept = dict.fromkeys([user, order, *fields])
    return records.select(*kept).join(totals, user).select(user, "n_records", *[c for c in kept if c != user])


def first_per_partition(df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The first record of every topic partition, as a partial aggregate instead of a sort."""
    first = df.groupBy(*keys).agg(F.min(F.struct(*order, *fields)).alias("first"))
    return first.select(*keys, *[F.col(f"first.{c}").alias(c) for c in (*order, *fields)])


def date_spine(counts: DataFrame, day: str, start: str, end: str) -> DataFrame:
    """Every day in [start, end) with its count; a day without rows has 0."""
    spark = counts.sparkSession
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))).alias(day)
    )
    return days.join(counts, day, "left").fillna(0)
