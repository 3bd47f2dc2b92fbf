"""One registered query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    conversations,
    fingerprints,
    jaccard,
    language,
    mixing,
    near_dedup,
    packing,
    quality,
    search,
    secrets,
    sharding,
    token_counts,
    toxicity,
)
from tidemark.llm.common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(plan: Callable) -> Callable:
        QUERIES[name] = plan
        if sql is not None:
            SQL[name] = sql
        return plan

    return register


def byte_bpe() -> tuple[str, str, str]:
    """Files and pattern of the public byte-level vocabulary."""
    path = public_tokenizers.path
    return path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query("op1_token_counts")
def op1(spark: SparkSession, root: str) -> DataFrame:
    return token_counts.token_counts(table(spark, root, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


MIX_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS m, COALESCE(strlen(text), 0) + 1 AS bytes FROM documents
), sizes AS (SELECT source, SUM(bytes) AS b, COUNT(*) OVER () AS n FROM d GROUP BY source),
shares AS (
  SELECT source, n, pow(b, 0.9) / SUM(pow(b, 0.9)) OVER () * (1000 - n) AS x FROM sizes
), dealt AS (
  SELECT source, n, floor(x) AS w, ROW_NUMBER() OVER (ORDER BY round(x - floor(x), 9) DESC, source NULLS FIRST) AS r FROM shares
), parts AS (
  SELECT source, CAST(w + 1 + CASE WHEN r <= 1000 - n - SUM(w) OVER () THEN 1 ELSE 0 END AS BIGINT) AS p FROM dealt
), l AS (
  SELECT list(source ORDER BY source NULLS FIRST) AS ss, list(p ORDER BY source NULLS FIRST) AS ps, CAST(SUM(p) AS BIGINT) AS h
  FROM parts
), turns AS (
  SELECT CAST(-1 AS BIGINT) AS slot, list_transform(ps, lambda p: CAST(0 AS BIGINT)) AS nxt, CAST(0 AS BIGINT) AS c FROM l
  UNION ALL
  SELECT slot + 1, list_transform(nxt, lambda v, i: v + CASE WHEN i = k THEN 1 ELSE 0 END), k
  FROM (
    SELECT slot, nxt, CAST(list_position(dues, list_min(dues)) AS BIGINT) AS k
    FROM (
      SELECT slot, nxt, list_transform(ps, lambda p, i: CASE WHEN nxt[i] < p AND (nxt[i] * h) // p <= slot + 1
             THEN ((nxt[i] + 1) * h + p - 1) // p END) AS dues
      FROM turns, l WHERE slot + 1 < h
    )
  )
), slots AS (
  SELECT ss[c] AS source, ps[c] AS p, h, slot, ROW_NUMBER() OVER (PARTITION BY c ORDER BY slot) - 1 AS nth
  FROM turns, l WHERE slot >= 0
), blocks AS (
  SELECT doc_id, source, bytes, CAST(COALESCE(SUM(bytes) OVER (PARTITION BY source ORDER BY m
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // 4096 AS block FROM d
), ends AS (
  SELECT MIN(((b - 1) // 4096 + 1) // p * h + slot) AS e
  FROM (SELECT source, CAST(b AS BIGINT) AS b FROM sizes) z JOIN slots s
    ON z.source IS NOT DISTINCT FROM s.source AND ((b - 1) // 4096 + 1) % p = nth
)
SELECT doc_id, b.source AS source, CAST(bytes AS BIGINT) AS bytes, block, block // p * h + slot AS slot, block // p * h + slot < e AS in_mix
FROM blocks b JOIN slots s ON b.source IS NOT DISTINCT FROM s.source AND block % p = nth, ends
"""


@query("op2_mix_sources", MIX_SQL)
def op2(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix(table(spark, root, "documents")).select("doc_id", "source", "bytes", "block", "slot", "in_mix")


@query("op3_best_fit_packing")
def op3(spark: SparkSession, root: str) -> DataFrame:
    return packed(table(spark, root, "documents"))


def packed(docs: DataFrame, place: str | None = None) -> DataFrame:
    pieces = packing.token_pieces(docs, *byte_bpe(), place=place)
    kept = [place] * bool(place)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), *kept), place=place)


@query("op4_toxicity")
def op4(spark: SparkSession, root: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 5) == 0
    return toxicity.score(table(spark, root, "documents"), table(spark, root, "labels"), held_out)


@query("op5_fingerprints")
def op5(spark: SparkSession, root: str) -> DataFrame:
    rows = fingerprints.compare_with_next(table(spark, root, "documents"))
    own, edited, after = [(F.col(f"{p}_hi"), F.col(f"{p}_lo")) for p in "oen"]
    compared = rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.digits(own).alias("fingerprint"),
        fingerprints.digits(edited).alias("edited_fingerprint"),
        fingerprints.likeness(own, edited).alias("near_edited"),
        fingerprints.likeness(own, after).alias("near_next"),
        own[0].alias("hi"),
        own[1].alias("lo"),
    )
    return fingerprints.near_counts(compared, F.col("doc_id") % 100 == 0).drop("hi", "lo")


@query("op6_language_id")
def op6(spark: SparkSession, root: str) -> DataFrame:
    return language.identify(table(spark, root, "documents"), remainder(F.col("doc_id"), 4) == 2)


@query("op7_kd_shards")
def op7(spark: SparkSession, root: str) -> DataFrame:
    rows = sharding.kd_shards(table(spark, root, "documents"), shards=8)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return rows.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query("op8_secret_scan")
def op8(spark: SparkSession, root: str) -> DataFrame:
    found = secrets.scan(table(spark, root, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    counts = [secrets.count_of(k) for k in range(4)]
    return found.select(
        "doc_id",
        counts[0].alias("n_assign"),
        counts[1].alias("n_access"),
        counts[2].alias("n_hex"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
        counts[3].alias("n_opaque"),
        F.size(F.filter("spans", lambda s: s["example"])).cast("long").alias("n_example"),
    )


@query("op9_quality_rules")
def op9(spark: SparkSession, root: str) -> DataFrame:
    return quality.judged(table(spark, root, "documents"), table(spark, root, "labels"))


@query("op10_simhash_near_dedup")
def op10(spark: SparkSession, root: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, root, "documents"))


SEARCH_SQL = r"""
WITH d AS (
  SELECT ROW_NUMBER() OVER () AS r, doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), b AS (
  SELECT ROW_NUMBER() OVER () AS i, item_id, unnest(regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), q AS (SELECT i, item_id, term, COUNT(*) AS times FROM b GROUP BY ALL),
corpus AS (SELECT COUNT(*) FILTER (len(terms) > 0) AS n, CAST(SUM(len(terms)) AS BIGINT) AS l FROM d),
tf AS (
  SELECT r, doc_id, size, term, COUNT(*) AS tf FROM (SELECT r, doc_id, len(terms) AS size, unnest(terms) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, COUNT(*) AS df FROM tf GROUP BY term), corpus
), scores AS (
  SELECT i, item_id, r, doc_id, CAST(SUM(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * size * n) // l)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), corpus GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 20
"""


@query("op11_ranked_search", SEARCH_SQL)
def op11(spark: SparkSession, root: str) -> DataFrame:
    return search.ranked(table(spark, root, "documents"), table(spark, root, "benchmark"))


@query("op12_conversation_repair")
def op12(spark: SparkSession, root: str) -> DataFrame:
    return conversations.summaries(conversations.damage(table(spark, root, "conversations")), F.col("live"))


@query("op13_ngram_jaccard")
def op13(spark: SparkSession, root: str) -> DataFrame:
    return jaccard.similar(table(spark, root, "documents"))
