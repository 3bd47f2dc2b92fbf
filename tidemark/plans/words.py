"""Word queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import ids, text as tx
from tidemark.operators import clustering as cl, ingest as ing, words as wd
from tidemark.plans import snippets as sq
from tidemark.plans.registry import query
from tidemark.session import spread
from tidemark.sources import tables

STATE_TIME, DELTA_TIME = 1704067200.0, 1704153600.0


def _documents(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    return spread(tables.load_table(spark, root, "documents").select("doc_id", *columns), "doc_id")


@query("word_count", sq.WORD_COUNT)
def word_count(spark: SparkSession, root: str) -> DataFrame:
    return wd.word_count(_documents(spark, root, "text"), F.col("text"))


@query(
    "word_count_split",
    "SELECT lower(w) AS word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY 1",
)
def word_count_split(spark: SparkSession, root: str) -> DataFrame:
    return wd.word_count_split(_documents(spark, root, "text"), F.col("text"))


@query("top_words", f"{sq.WORD_COUNT} ORDER BY count DESC, word LIMIT 10")
def top_words(spark: SparkSession, root: str) -> DataFrame:
    return wd.top_words(word_count(spark, root))


@query("alpha_words", f"SELECT * FROM ({sq.WORD_COUNT}) WHERE regexp_matches(word, '^[a-zA-Z]+$')")
def alpha_words(spark: SparkSession, root: str) -> DataFrame:
    return word_count(spark, root).where(tx.is_ascii_word(F.col("word")))


@query("noun_words", f"SELECT * FROM ({sq.WORD_COUNT}) WHERE {sq.TAG} = 'N'")
def noun_words(spark: SparkSession, root: str) -> DataFrame:
    return wd.noun_words(word_count(spark, root))


@query("word_map", f"SELECT lang, word, count(*) AS count FROM ({sq.DOC_WORDS}) GROUP BY lang, word")
def word_map(spark: SparkSession, root: str) -> DataFrame:
    """All words of every group with their counts."""
    return wd.word_time_series(_documents(spark, root, "text", "lang"), F.col("text"), "lang")


@query(
    "word_time_series",
    f"""SELECT w.doc_id AS id, t.created_utc, w.word, count(*) AS count
    FROM ({sq.DOC_WORDS}) w JOIN ({sq.POST_TIMES}) t ON w.doc_id = t.doc_id GROUP BY 1, 2, 3""",
)
def word_time_series(spark: SparkSession, root: str) -> DataFrame:
    """Texts are dealt by their id once; there they meet their time and are counted, and no word is moved."""
    known = tables.load_table(spark, root, "documents").where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "text")
    timed = known.repartition("id").join(tables.post_times(spark, root), "id")
    return wd.word_time_series(timed, F.col("text"), "id", "created_utc").select("id", "created_utc", "word", "count")


@query(
    "word_freq_upsert",
    f"""SELECT word, count(*) AS count, max(CASE WHEN l.doc_id IS NULL THEN {DELTA_TIME}::DOUBLE ELSE {STATE_TIME}::DOUBLE END) AS timestamp
    FROM ({sq.DOC_WORDS}) w LEFT JOIN labels l ON w.doc_id = l.doc_id GROUP BY word""",
)
def word_freq_upsert(spark: SparkSession, root: str) -> DataFrame:
    """The state (labelled documents) and what is added to it (all others) in one aggregate. Texts are read once and not moved."""
    counts = wd.word_time_series(_documents(spark, root, "text"), F.col("text"), "doc_id")
    labelled = tables.load_table(spark, root, "labels").select("doc_id").distinct().withColumn("known", F.lit(True))
    stamped = counts.join(labelled, "doc_id", "left").select("word", "count", F.when(F.col("known"), STATE_TIME).otherwise(DELTA_TIME).alias("timestamp"))
    return wd.summed_counts(stamped)


@query(
    "clean_tokens",
    f"""SELECT d.doc_id, count(k.word) AS n_kept FROM documents d LEFT JOIN ({sq.KEPT_TOKENS}) k
    ON d.doc_id = k.doc_id GROUP BY d.doc_id""",
)
def clean_tokens(spark: SparkSession, root: str) -> DataFrame:
    kept = wd.clean_tokens(F.col("text"))
    return _documents(spark, root, "text").select("doc_id", F.size(kept).cast("bigint").alias("n_kept"))


@query(
    "clean_token_text",
    f"""SELECT d.doc_id, md5(coalesce(string_agg(k.word, ' ' ORDER BY k.pos), '')) AS text_md5
    FROM documents d LEFT JOIN ({sq.KEPT_TOKENS}) k ON d.doc_id = k.doc_id GROUP BY d.doc_id""",
)
def clean_token_text(spark: SparkSession, root: str) -> DataFrame:
    joined = wd.clean_token_text(F.col("text"))
    return _documents(spark, root, "text").select("doc_id", F.md5(joined).alias("text_md5"))


@query(
    "sentence_count",
    r"""SELECT doc_id, len(list_filter(regexp_extract_all(text, '[^.!?]+'), lambda r: regexp_matches(r, '[^ \n\r\t\f]')))::BIGINT
    AS n_sentences FROM documents""",
)
def sentence_count(spark: SparkSession, root: str) -> DataFrame:
    return _documents(spark, root, "text").select(
        "doc_id", F.size(tx.sentences(F.col("text"))).cast("bigint").alias("n_sentences")
    )


@query("clean_text", f"SELECT doc_id, md5({sq.clean('text')}) AS clean_md5 FROM documents")
def clean_text(spark: SparkSession, root: str) -> DataFrame:
    return _documents(spark, root, "text").select("doc_id", F.md5(tx.clean_text(F.col("text"))).alias("clean_md5"))


_MARKED = "concat('@bob see ', url, ' ', chr(128512), chr(10), html, ' @ ', url)"


@query("clean_text_pages", f"SELECT page_id, {sq.clean(_MARKED)} AS clean FROM pages")
def clean_text_pages(spark: SparkSession, root: str) -> DataFrame:
    """Texts with mentions, links, emoji and newlines, made from the web pages."""
    marked = F.concat(
        F.lit("@bob see "), F.col("url"), F.lit(" \U0001f600\n"), F.col("html"), F.lit(" @ "), F.col("url")
    )
    pages = tables.load_table(spark, root, "pages").select("page_id", "url", "html")
    return spread(pages, "page_id").select("page_id", tx.clean_text(marked).alias("clean"))


@query(
    "strip_wide",
    f"SELECT doc_id, md5(regexp_replace(text, '[{tx.WIDE_SYMBOL_CLASS}]', '', 'g')) AS stripped_md5 FROM documents",
)
def strip_wide(spark: SparkSession, root: str) -> DataFrame:
    return _documents(spark, root, "text").select("doc_id", F.md5(tx.strip_wide(F.col("text"))).alias("stripped_md5"))


@query(
    "strip_prefix",
    """SELECT event_id, replace(concat('https://twitter.com/', event_type, user_id, '?v=', event_id), 'https://twitter.com/', '') AS stripped,
    concat(event_type, user_id) AS name FROM events""",
)
def strip_prefix(spark: SparkSession, root: str) -> DataFrame:
    events = tables.load_table(spark, root, "events")
    url = F.concat(F.lit(tx.PROFILE_PREFIX), "event_type", "user_id", F.lit("?v="), "event_id")
    return events.select("event_id", tx.strip_profile_prefix(url).alias("stripped"), ids.profile_name(url).alias("name"))


@query(
    "dedup_texts",
    f"""SELECT sha256({sq.clean('text')}) AS text_hash, min(doc_id) AS doc_id, count(*) AS copies
    FROM documents GROUP BY 1""",
)
def dedup_texts(spark: SparkSession, root: str) -> DataFrame:
    return ing.dedup_texts(_documents(spark, root, "text"), "doc_id", F.col("text"))


def _source_words(spark: SparkSession, root: str) -> DataFrame:
    return wd.group_words(_documents(spark, root, "text", "source"), F.col("text"), "source")


_SOURCE_WORDS = f"""SELECT *, row_number() OVER (PARTITION BY source ORDER BY count DESC, word)::INTEGER AS rank
  FROM (SELECT source, word, count(*) AS count FROM ({sq.KEPT_TOKENS}) GROUP BY source, word)"""


@query("cluster_top_words", f"SELECT source, word, count, rank FROM ({_SOURCE_WORDS}) WHERE rank <= 10")
def cluster_top_words(spark: SparkSession, root: str) -> DataFrame:
    return cl.cluster_top_words(_source_words(spark, root), "source")


@query(
    "topic_info",
    f"""SELECT d.source, d.size, coalesce(w.words, '') AS words
    FROM (SELECT source, count(*) AS size FROM documents GROUP BY source) d
    LEFT JOIN (SELECT source, string_agg(word, ' ' ORDER BY rank) AS words FROM ({_SOURCE_WORDS})
      WHERE rank <= 10 GROUP BY source) w ON d.source = w.source""",
)
def topic_info(spark: SparkSession, root: str) -> DataFrame:
    sources = tables.load_table(spark, root, "documents").select("source")
    return cl.topic_info(sources, _source_words(spark, root), "source")
