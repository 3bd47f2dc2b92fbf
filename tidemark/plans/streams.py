"""Stream queries: the tables are read as a stream until they are used up, the result is read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.functions import ids, scores as sc
from tidemark.operators import company as co, entities as en, sentiment as st
from tidemark.plans import snippets as sq
from tidemark.plans.registry import query
from tidemark.session import run_folder, spread
from tidemark.sources import tables
from tidemark.streaming import generations, layers, replay, sources, state

BATCH_TIME = 1704067200.0
KEYS = {"documents": ("doc_id",), "events": ("event_id",), "conversations": ("conv_id", "turn")}


def _stream(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    # A pattern, as the file source takes a plain path for a folder; it matches a file or a folder.
    stream = sources.landed_stream(spark, f"{root}/{{{name}.parquet}}", schemas.TABLES[name]).select(*columns)
    return spread(stream, *KEYS[name], size_of=tables.load_table(spark, root, name).select(*columns))


def _comment_records(spark: SparkSession, root: str) -> DataFrame:
    """The comments as they arrive on the topic: JSON values, parsed again."""
    record = F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("comment_id"),
        F.col("text").alias("raw_text"),
        F.col("role").alias("author_name"),
    )
    envelope = _stream(spark, root, "conversations", "conv_id", "turn", "role", "text").select(F.lit("raw_data").alias("key"), F.to_json(record).alias("value"))
    return sources.parse_records(envelope).select("comment_id", "raw_text", "author_name")


def _run_layers(spark: SparkSession, root: str, layer) -> str:
    folder = run_folder(spark, "layers")
    running = layers.run_layers(
        _comment_records(spark, root), folder, f"{folder}/checkpoint", (layer,), every=None, clock=lambda: BATCH_TIME
    )
    running.awaitTermination()
    return folder


_COMMENT_ID = "concat(conv_id, '-', turn)"
_COMMENTS = f"SELECT {_COMMENT_ID} AS doc_id, text FROM conversations"
_COMMENT_WORDS = f"""SELECT * FROM (SELECT {_COMMENT_ID} AS comment_id, unnest({sq.tokens(sq.clean('text'))}) AS word FROM conversations)
  WHERE regexp_matches(word, '^[a-zA-Z]') AND word NOT IN ({sq.names(sq.wd.STOP_WORDS)})"""


@query(
    "stream_word_frequency",
    f"SELECT word, count(*) AS count, {BATCH_TIME}::DOUBLE AS timestamp FROM ({_COMMENT_WORDS}) GROUP BY word",
)
def stream_word_frequency(spark: SparkSession, root: str) -> DataFrame:
    return layers.word_frequency(spark, _run_layers(spark, root, layers.word_layer))


@query(
    "stream_time_series",
    f"""SELECT comment_id, word, count(*) AS count, {BATCH_TIME}::DOUBLE AS timestamp FROM ({_COMMENT_WORDS})
    GROUP BY comment_id, word""",
)
def stream_time_series(spark: SparkSession, root: str) -> DataFrame:
    folder = _run_layers(spark, root, layers.word_layer)
    return spark.read.parquet(f"{folder}/{layers.SERIES}").drop("batch_id")


@query(
    "stream_raw",
    f"SELECT {_COMMENT_ID} AS comment_id, text AS raw_text, role AS author_name, {BATCH_TIME}::DOUBLE AS insert_time FROM conversations",
)
def stream_raw(spark: SparkSession, root: str) -> DataFrame:
    folder = _run_layers(spark, root, layers.raw_layer)
    return spark.read.parquet(f"{folder}/{layers.RAW}").drop("batch_id")


@query(
    "stream_sentiment",
    "SELECT doc_id AS comment_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in sc.SENTIMENT_LABELS)
    + f" FROM ({sq.scores(_COMMENTS)})",
)
def stream_sentiment(spark: SparkSession, root: str) -> DataFrame:
    folder = _run_layers(spark, root, layers.sentiment_layer)
    scored = spark.read.parquet(f"{folder}/{layers.SENTIMENT}")
    return scored.select("comment_id", *[F.round(c, 6).alias(c) for c in sc.SENTIMENT_LABELS])


@query("stream_word_count", sq.WORD_COUNT)
def stream_word_count(spark: SparkSession, root: str) -> DataFrame:
    """Running totals kept as stream state; must equal the batch count."""
    folder = run_folder(spark, "words")
    counted = state.running_word_count(_stream(spark, root, "documents", "doc_id", "text"), F.col("text"))
    generations.write(counted, f"{folder}/out", f"{folder}/checkpoint", ["word"]).awaitTermination()
    return generations.latest(spark, f"{folder}/out", ["word"])


@query(
    "stream_company_daily",
    f"""SELECT company, date_trunc('day', t.created_utc)::TIMESTAMP + INTERVAL 1 DAY AS utc_interval_date,
      round(avg(positive), 6) AS positive, round(avg(negative), 6) AS negative, round(avg(neutral), 6) AS neutral, count(*) AS count
    FROM ({sq.PAIRS}) p JOIN ({sq.POST_TIMES}) t ON p.doc_id = t.doc_id GROUP BY 1, 2""",
)
def stream_company_daily(spark: SparkSession, root: str) -> DataFrame:
    """Posts as a stream, their creation time from a stored table, rolled up per day of event time."""
    folder = run_folder(spark, "company")
    times = tables.post_times(spark, root).select(F.col("id").alias("doc_id"), ids.utc(F.col("created_utc")).alias("ts"))
    scored = st.score_sentiment(_stream(spark, root, "documents", "doc_id", "text"), F.col("text"))
    pairs = scored.select("doc_id", F.explode(en.orgs(F.col("text"))).alias("company"), *co.LABELS).join(times, "doc_id")
    rolled = state.company_windows(pairs, "ts", "1 day")
    # The label leaves the stream as epoch seconds, so no session zone gets into it.
    rolled = rolled.withColumn("end_s", F.unix_seconds("window_end")).drop("window_end")
    state.write_updates(rolled, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    newest = state.latest(spark, f"{folder}/out", ["company", "end_s"])
    label = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, end_s)")
    return newest.select(
        "company", label.alias("utc_interval_date"), *[F.round(c, 6).alias(c) for c in co.LABELS], "count"
    )


@query("stream_dedup", "SELECT event_id, user_id FROM events")
def stream_dedup(spark: SparkSession, root: str) -> DataFrame:
    """The event stream delivered twice; every event stays once."""
    folder = run_folder(spark, "dedup")
    once, again = (
        _stream(spark, root, "events", "event_id", "user_id", "ts").select("event_id", "user_id", ids.utc(F.col("ts")).alias("ts")) for _ in range(2)
    )
    unique = state.dedup(once.unionByName(again), "event_id", "ts", delay="60 days").select("event_id", "user_id")
    state.write_updates(unique, f"{folder}/out", f"{folder}/checkpoint", mode="append").awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch_id")


@query(
    "stream_first_records",
    """SELECT event_type AS topic, 0 AS partition, event_id AS "offset", 'raw_data' AS key, props AS value FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1""",
)
def stream_first_records(spark: SparkSession, root: str) -> DataFrame:
    """Events as topic rows (topic = event type); the first record per topic partition of the batch."""
    folder = run_folder(spark, "first")
    envelope = _stream(spark, root, "events", "event_id", "event_type", "props").select(
        F.lit("raw_data").alias("key"), F.col("props").alias("value"), F.col("event_type").alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
    )
    layers.first_records(envelope, folder, f"{folder}/checkpoint", every=None).awaitTermination()
    return spark.read.parquet(f"{folder}/{layers.FIRST}").drop("batch_id")


HOLD = "2 days"


@query(
    "stream_replay",
    """SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::BIGINT AS "offset"
    FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 DAY FROM events)""",
)
def stream_replay(spark: SparkSession, root: str) -> DataFrame:
    """Events released per user in event-time order, a day at a time; the days the watermark has not passed are still held."""
    folder = run_folder(spark, "replay")
    events = _stream(spark, root, "events", "event_id", "user_id", "ts").withColumn("ts", ids.utc(F.col("ts")))
    ordered = replay.in_event_order(events, "user_id", "ts", "event_id", HOLD, tick_s=86_400)
    with state.rocksdb(spark):
        state.write_updates(ordered, f"{folder}/out", f"{folder}/checkpoint", mode="append").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("user_id", "event_id", "offset")


@query(
    "stream_all_layers",
    f"""SELECT 'word' AS layer, word AS item, count(*)::DOUBLE AS value FROM ({_COMMENT_WORDS}) GROUP BY word
    UNION ALL SELECT 'raw', role, count(*) FROM conversations GROUP BY role
    UNION ALL SELECT 'sentiment', 'scored', count(*) FROM conversations
    UNION ALL SELECT 'company', company, round(avg(positive), 6) FROM ({sq.pairs(_COMMENTS)}) GROUP BY company""",
)
def stream_all_layers(spark: SparkSession, root: str) -> DataFrame:
    """One stream feeds words, raw records, sentiment and companies; what each layer holds at the end."""
    folder = run_folder(spark, "layers")
    records = _comment_records(spark, root)
    layers.run_layers(records, folder, f"{folder}/checkpoint", every=None, clock=lambda: BATCH_TIME).awaitTermination()

    def held(layer: str, item: Column, value: Column) -> DataFrame:
        rows = spark.read.parquet(f"{folder}/{layer}").groupBy(item.alias("item")).agg(value.cast("double").alias("value"))
        return rows.select(F.lit(layer).alias("layer"), "item", "value")

    words = layers.word_frequency(spark, folder).select(
        F.lit("word").alias("layer"), F.col("word").alias("item"), F.col("count").cast("double").alias("value")
    )
    n = F.count(F.lit(1))
    parts = [
        words, held(layers.RAW, F.col("author_name"), n), held(layers.SENTIMENT, F.lit("scored"), n),
        held(layers.COMPANY, F.col("company"), F.round(F.first("positive"), 6)),  # one batch, so one row a company
    ]
    return reduce(DataFrame.unionByName, parts)
