"""Secret scans that tell live-looking credentials from examples by how many owners share a value."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import common
from tidemark.session import cut_lineage

# Base kinds in their order; OPAQUE is the kind that the method may add.
KINDS = ("assign", "access", "hex", "opaque")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
OPAQUE = r"[A-Za-z0-9+/_=-]{20,}"
EXAMPLE_OWNERS = 4
EXAMPLE_REPOSITORIES = 4
LIVE_BITS = 3.5
SPANS = "array<struct<kind:int,first:int,last:int,value:long>>"


def spans(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, value hash) of every candidate: base matches, then opaque strings apart from them.

    Offsets are code points, the end exclusive. The hash is of the value alone (of an assignment: what is
    assigned), so one value has one hash in every context. Values themselves are not kept.
    """
    found = []
    if ":" in text or "=" in text:
        for m in re.finditer(ASSIGN, text, re.IGNORECASE | re.ASCII):
            if len(m[2]) >= 12:
                found.append((0, m.start(), m.end(), m[2]))
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in re.finditer(ACCESS, text) if len(m[0]) >= 18]
    found += [(2, m.start(), m.end(), m[0]) for m in re.finditer(HEX, text)]
    base = [(start, end) for _, start, end, _ in found]
    for m in re.finditer(OPAQUE, text):
        if opaque(m[0]) and all(m.end() <= start or end <= m.start() for start, end in base):
            found.append((3, m.start(), m.end(), m[0]))
    hashed = ((k, s, e, hashlib.blake2b(v.encode("utf-8", "surrogatepass"), digest_size=8).digest()) for k, s, e, v in found)
    return [(k, s, e, int.from_bytes(h, "little", signed=True)) for k, s, e, h in hashed]


def opaque(value: str) -> bool:
    """Digits and letters of both cases, with many bits a character."""
    if not (re.search("[0-9]", value) and re.search("[a-z]", value) and re.search("[A-Z]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= LIVE_BITS


def candidates(text: Column) -> Column:
    def scan(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "first", "last", "value"), s, strict=True)) for s in spans(t or "")] for t in texts])

    return F.pandas_udf(scan, SPANS)(text)


def _decided(hits: DataFrame) -> DataFrame:
    """(_row, _spans): the candidates of each hit in order of start and kind, with ``example`` set by the corpus.

    A value is an example if it has at least EXAMPLE_OWNERS owners and EXAMPLE_REPOSITORIES repositories, each
    counted on its own over the whole corpus: one text copied to many owners is one repository. Distinct owners and
    repositories are aggregated before they are counted, so a value in a third of all rows is a few rows a task.
    """
    each = hits.select("_row", "_owner", "_repository", F.inline("_cands"))
    sides = [F.struct(F.lit(c).alias("_side"), F.col(c).cast("string").alias("_name")) for c in ("_owner", "_repository")]
    distinct = each.select("value", F.inline(F.array(*sides))).groupBy("value", "_side", "_name").agg(F.lit(1).alias("_one"))
    owners, repositories = [F.count(F.when(F.col("_side") == c, 1)) for c in ("_owner", "_repository")]
    spread = distinct.groupBy("value").agg(owners.alias("_owners"), repositories.alias("_repositories"))
    example = (F.col("_owners") >= EXAMPLE_OWNERS) & (F.col("_repositories") >= EXAMPLE_REPOSITORIES)
    judged = each.join(spread.select("value", example.alias("example")), "value")
    return judged.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("first", "kind", "last", "example"))).alias("_spans"))


def _marked(docs: DataFrame, owner: str, repository: Column) -> DataFrame:
    common.small_batches(docs.sparkSession)
    return docs.select(
        F.struct("*").alias("_doc"),
        F.col(owner).cast("string").alias("_owner"),
        repository.alias("_repository"),
        candidates(F.col("text")).alias("_cands"),
    )


def scan(docs: DataFrame, owner: str = "source", repository: Column | None = None) -> DataFrame:
    """(doc_id, spans): spans are structs (first, kind, last, example), ordered; kind is an index of KINDS.

    All base spans are given. An opaque string is given only if the corpus does not show it as a widely copied
    example. ``repository`` defaults to the whole text, so copies of a text count once per owner; a null owner is
    an owner of its own. One row per document; null and empty texts have no span.
    """
    repository = F.xxhash64("text") if repository is None else repository
    marked = _marked(docs, owner, repository)
    rows = marked.select(F.monotonically_increasing_id().alias("_row"), F.col("_doc.doc_id").alias("doc_id"), "_owner", "_repository", "_cands")
    rows = cut_lineage(rows)
    joined = rows.select("_row", "doc_id").join(_decided(rows.where(F.size("_cands") > 0)), "_row", "left")
    return joined.select("doc_id", live_spans(F.col("_spans")).alias("spans"))


def live_spans(decided: Column) -> Column:
    kept = F.filter(decided, lambda s: (s["kind"] < 3) | ~s["example"])
    return F.coalesce(kept, F.array().cast("array<struct<first:int,kind:int,last:int,example:boolean>>"))


def count_of(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def joined(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", names[s["kind"]], s["first"], s["last"])), ",")


def redact(docs: DataFrame, owner: str = "source", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every live-looking span of ``text`` replaced by ``mark``; ``n_chars`` follows where it exists.

    Spans of widely copied examples stay, and so does every document. Overlapping spans become one mark. Only
    documents with candidates (a few percent, with their texts) are written to the shared folder and shuffled.
    """
    marked = _marked(docs, owner, F.xxhash64("text"))
    hits = marked.where(F.size("_cands") > 0).withColumn("_row", F.monotonically_increasing_id())
    hits = cut_lineage(hits.select("_row", "_doc", "_owner", "_repository", "_cands"))
    live = F.filter("_spans", lambda s: ~s["example"])
    decided = _decided(hits).select("_row", live.alias("_spans"))

    @F.pandas_udf("string")
    def masked(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([_mask(t, s, mark) for t, s in zip(texts, found, strict=True)], dtype=object)

    fixed = hits.select("_row", "_doc").join(decided, "_row").withColumn("_text", masked("_doc.text", "_spans"))
    columns = []
    for name in docs.columns:
        value = {"text": F.col("_text"), "n_chars": F.char_length("_text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}.get(name)
        columns.append((F.col(f"_doc.`{name}`") if value is None else value).alias(name))
    free = marked.where(F.size("_cands") == 0).select("_doc.*")
    return free.unionByName(fixed.select(*columns))


def _mask(text: str, found: Iterator[dict], mark: str) -> str:
    out, at = [], 0
    end = -1
    for span in found:
        if span["first"] >= end:
            out += [text[at : span["first"]], mark]
        end = max(end, span["last"])
        at = end
    return "".join([*out, text[at:]])
