"""Organisation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import text as tx
from tidemark.operators import entities as en
from tidemark.plans import snippets as sq
from tidemark.plans.registry import query
from tidemark.plans.words import _documents
from tidemark.sources import tables
from tidemark.sources.label_maps import label_map

_LISTED = f"SELECT doc_id, string_agg(DISTINCT org, ',' ORDER BY org) AS orgs FROM ({sq.MENTIONS}) GROUP BY doc_id"


@query(
    "orgs_per_doc",
    f"SELECT d.doc_id, coalesce(o.orgs, '') AS orgs FROM documents d LEFT JOIN ({_LISTED}) o ON d.doc_id = o.doc_id",
)
def orgs_per_doc(spark: SparkSession, root: str) -> DataFrame:
    found = F.array_join(F.array_sort(en.orgs(F.col("text"))), ",")
    return _documents(spark, root, "text").select("doc_id", found.alias("orgs"))


@query("docs_with_orgs", _LISTED)
def docs_with_orgs(spark: SparkSession, root: str) -> DataFrame:
    named = en.docs_with_orgs(_documents(spark, root, "text"), "doc_id", F.col("text"))
    return named.withColumn("orgs", F.array_join(F.array_sort("orgs"), ","))


@query(
    "org_table_match",
    f"SELECT DISTINCT doc_id, org FROM ({sq.MENTIONS})",
)
def org_table_match(spark: SparkSession, root: str) -> DataFrame:
    """The same hits from a gazetteer kept as a table."""
    names = label_map(spark, en.ORGANISATIONS).select(F.col("label").alias("org"))
    return en.match_table(_documents(spark, root, "text"), "doc_id", F.col("text"), names)


_PIECES = r"regexp_extract_all(lower(text), '[\p{L}\p{N}'']+|[^\p{L}\p{N}'']+')"


@query(
    "entity_offsets",
    f"""SELECT doc_id, piece AS text, 'ORG' AS label, (ends - length(piece))::INTEGER AS start, ends::INTEGER AS "end" FROM (
      SELECT doc_id, piece, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pos) AS ends FROM (
        SELECT doc_id, unnest(pieces) AS piece, unnest(range(1, len(pieces) + 1)) AS pos
        FROM (SELECT doc_id, {_PIECES} AS pieces FROM documents)))
    WHERE piece IN ({sq.names(en.ORGANISATIONS)})""",
)
def entity_offsets(spark: SparkSession, root: str) -> DataFrame:
    return _documents(spark, root, "text").select("doc_id", F.inline(en.entity_spans(F.col("text"))))


_WORDS = r"""SELECT doc_id, piece, ends - length(piece) AS start, ends, pos FROM (
    SELECT doc_id, piece, pos, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pos) AS ends FROM (
      SELECT doc_id, unnest(pieces) AS piece, unnest(range(1, len(pieces) + 1)) AS pos
      FROM (SELECT doc_id, {pieces} AS pieces FROM documents)))
  WHERE regexp_matches(piece, '^[\p{{L}}\p{{N}}'']')""".format(pieces=_PIECES)


def _runs(n: int) -> str:
    words = " || ' ' || ".join(["piece", *(f"lead(piece, {k}) OVER o" for k in range(1, n))])
    return f"SELECT doc_id, {words} AS org, start, lead(ends, {n - 1}) OVER o AS ends FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)"


_WIDE_NAMES = f"""SELECT DISTINCT array_to_string(list_slice(toks, 1, 1 + item_id % 5), ' ') AS org
  FROM (SELECT item_id, {sq.tokens('text')} AS toks FROM benchmark) WHERE len(toks) > 0"""
_WIDE_HITS = f"""WITH w AS ({_WORDS}), runs AS ({' UNION ALL '.join(map(_runs, range(1, 6)))})
  SELECT doc_id, org, start::INTEGER AS start, ends::INTEGER AS "end" FROM runs WHERE org IN ({_WIDE_NAMES})"""


def _wide_names(spark: SparkSession, root: str) -> DataFrame:
    """Names of one to five words: the first words of every benchmark passage."""
    items = tables.load_table(spark, root, "benchmark").select("item_id", tx.tokens(F.col("text")).alias("toks"))
    first = F.slice("toks", F.lit(1), (F.col("item_id") % 5 + 1).cast("int"))
    return items.where(F.size("toks") > 0).select(F.array_join(first, " ").alias("org"))


@query("org_table_offsets", _WIDE_HITS)
def org_table_offsets(spark: SparkSession, root: str) -> DataFrame:
    """All hits of names of one to five words with their places, by a trie that travels with the tasks."""
    return en.find_names(_documents(spark, root, "text"), "doc_id", F.col("text"), _wide_names(spark, root))


@query("org_table_large", f"SELECT DISTINCT doc_id, org FROM ({_WIDE_HITS})")
def org_table_large(spark: SparkSession, root: str) -> DataFrame:
    """The same names as if they were too many to travel: runs of words are sifted by a bitmap, then joined."""
    return en.match_table(_documents(spark, root, "text"), "doc_id", F.col("text"), _wide_names(spark, root), held=0)


@query("org_mentions", f"SELECT org, count(*) AS mentions FROM ({sq.MENTIONS}) GROUP BY org")
def org_mentions(spark: SparkSession, root: str) -> DataFrame:
    return en.mention_counts(_documents(spark, root, "text"), F.col("text"))


@query("org_union", f"SELECT DISTINCT org FROM ({sq.MENTIONS})")
def org_union(spark: SparkSession, root: str) -> DataFrame:
    return en.distinct_orgs(_documents(spark, root, "text"), F.col("text"))


@query("org_distinct", f"SELECT count(DISTINCT org) AS n_orgs FROM ({sq.MENTIONS})")
def org_distinct(spark: SparkSession, root: str) -> DataFrame:
    """Extract, run the extractor over the found names again, count what it confirms."""
    return en.refine_orgs(org_union(spark, root)).agg(F.countDistinct("org").alias("n_orgs"))
