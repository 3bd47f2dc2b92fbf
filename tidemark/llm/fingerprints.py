"""Document fingerprints by SimHash, their likeness, and search within a Hamming radius over permuted block tables."""

from __future__ import annotations

import itertools
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidemark.llm import common
from tidemark.session import cut_lineage

BITS = 128
BLOCK = 32
RADIUS = 11  # finds nearly all copies with one replaced word among 100 to 450, see the README
MIN_FANOUT, MAX_FANOUT = 8, 1_024
ROWS_PER_RANGE = 2_000
HALVES = ("_hi", "_lo")


def vote(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys``, _hi and _lo: 128 bits of the text of each distinct value of ``keys``.

    Terms are pairs of neighbouring lower-cased words (a lone word is a term); a term weighs the length of its
    shorter word, each time it occurs. Every term's hash votes with its weight for its set bits and against the
    others. Equal texts get equal bits; texts without words get none.
    """
    split = rows.select(*keys, common.words(F.lower(text)).alias("_words"))
    pairs = split.select(common.shingle_rows(2, keys, "_words"))
    weight = F.least(F.char_length("w0"), F.coalesce(F.char_length("w1"), F.char_length("w0"))).cast("long")
    first = F.when(F.col("w0").isNotNull(), F.xxhash64("w0", "w1"))
    terms = pairs.select(*keys, first.alias("_h"), weight.alias("_w")).withColumn("_h2", F.xxhash64("_h", F.lit(1)))
    sums = terms.groupBy(*keys).agg(
        *common.vote_sums(F.col("_h"), "_a", F.col("_w")), *common.vote_sums(F.col("_h2"), "_b", F.col("_w")), F.sum("_w").alias("_n")
    )
    halves = zip(HALVES, ("_a", "_b"), strict=True)
    bits = [F.coalesce(common.majority(p, F.col("_n")), F.lit(0)).cast("long").alias(h) for h, p in halves]
    return sums.select(*keys, *bits)


def likeness(left: tuple[Column, Column], right: tuple[Column, Column]) -> Column:
    """1 less the share of differing bits."""
    return 1 - distance(left, right) / F.lit(float(BITS))


def distance(left: tuple[Column, Column], right: tuple[Column, Column]) -> Column:
    return reduce(lambda a, b: a + b, (F.bit_count(x.bitwiseXOR(y)) for x, y in zip(left, right, strict=True)))


def digits(halves: tuple[Column, Column]) -> Column:
    return F.concat(*map(common.hex64, halves))


def _fanout(n: int) -> int:
    return min(MAX_FANOUT, max(MIN_FANOUT, math.ceil(math.sqrt(n / ROWS_PER_RANGE))))


def _ranged(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text) with _q and _p: (_q, _p) falls in the order of :func:`compare_with_next`.

    Both levels are cut at quantiles of the ids, the second inside each range of the first, so an id far from
    the others moves no cut. Rows without id are cut the same way by the hash that orders them. A pair holds at most about
    ROWS_PER_RANGE rows up to MAX_FANOUT^2 pairs; only rows of one id, or without id and of one text, can't be parted.
    The driver sees MAX_FANOUT numbers, and as many for each range travel with the tasks.
    """
    named, unnamed = rows.agg(F.count("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    f, g = _fanout(named), _fanout(unnamed)
    steps = [k / f for k in range(1, f)]
    turn = F.xxhash64("text") / F.lit(2.0**64) + 0.5  # 0 to 1 by the hash
    outer, missing = F.floor(turn * g), F.col("doc_id").isNull()
    inner = F.floor((turn * g - outer) * g)
    last = F.lit(g - 1)
    hashed = [-1 - F.least(outer, last), last - F.least(inner, last)]

    def passed(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda x: x <= F.col("doc_id")))

    cuts = rows.agg(F.percentile_approx("doc_id", steps)).first()[0]
    ranged = rows.withColumn("_q", F.when(missing, hashed[0]).otherwise(passed(F.lit(cuts or [0]))).cast("long"))
    finer = ranged.where(~missing).groupBy("_q").agg(F.percentile_approx("doc_id", steps).alias("_cuts"))
    finer = F.broadcast(cut_lineage(finer))  # kept, as sketches may differ when they are made again; at most 1,024 rows of 1,023 numbers
    placed = ranged.join(finer, "_q", "left")
    return placed.withColumn("_p", F.when(missing, hashed[1]).otherwise(passed(F.col("_cuts"))).cast("long")).drop("_cuts")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_text, and the halves of three fingerprints.

    Fingerprints: own (_hi, _lo), of the edited text (e_hi, e_lo), of the next document (n_hi, n_lo). The next
    document has the next smaller doc_id; after the last comes the first. The edited text has its last third
    (rounded down) replaced by the next document's first code points. Null text is empty. Rows of equal id are
    ordered by a hash of the text, rows without id come last; a lone row is its own next.

    Texts are shuffled once, by ranges of the id. A range's last row takes its next from the first row of the
    following range, of which there is one for some thousand rows.
    """
    rows = _ranged(docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    place = Window.partitionBy("_q", "_p").orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    heads = cut_lineage(rows.withColumn("_r", F.row_number().over(place)).where("_r = 1").select("_q", "_p", "text"))
    inner = Window.partitionBy("_q").orderBy(F.col("_p").desc())
    outer = Window.orderBy(F.col("_q").desc())
    tops = heads.groupBy("_q").agg(F.max("_p").alias("_top"))  # at most 2 * MAX_FANOUT rows
    tops = tops.select("_q", F.lead(F.struct("_q", "_top")).over(outer).alias("_after"), F.first(F.struct("_q", "_top")).over(outer).alias("_first"))
    after = heads.select("_q", "_p", F.lead("_p").over(inner).alias("_below")).join(F.broadcast(tops), "_q")
    turn = F.coalesce("_after", "_first")
    after = after.select(
        "_q", "_p", F.when(F.col("_below").isNotNull(), F.struct("_q", F.col("_below").alias("_top"))).otherwise(turn).alias("_to")
    )
    marked = heads.join(vote(heads, ["_q", "_p"], "text"), ["_q", "_p"])
    marked = marked.select(F.struct("_q", F.col("_p").alias("_top")).alias("_to"), F.col("text").alias("_t"), F.col("_hi").alias("_bh"), F.col("_lo").alias("_bl"))
    border = cut_lineage(after.join(marked, "_to").select("_q", "_p", "_t", "_bh", "_bl"))

    ordered = rows.select(
        "_q", "_p", "doc_id", "text", F.row_number().over(place).alias("_r"), F.lead("text").over(place).alias("_next")
    )
    ordered = ordered.join(border.select("_q", "_p", "_t"), ["_q", "_p"])
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    follower = F.coalesce("_next", "_t")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring(follower, F.lit(1), cut))
    both = ordered.select("_q", "_p", "_r", "doc_id", "text", edited.alias("edited_text"))
    own = ["_q", "_p", "_r", "doc_id", "n_chars", "edited_sha256"]
    both = both.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited_sha256", F.sha2("edited_text", 256))
    kinds = F.array(*[F.struct(F.lit(k).alias("_kind"), F.col(c).alias("_text")) for k, c in enumerate(("text", "edited_text"))])
    facts = both.select(*own, F.inline(kinds))
    voted = vote(facts, [*own, "_kind"], "_text")
    picked = [F.max(F.when(F.col("_kind") == k, F.col(h))).alias(f"{p}{h}") for k, p in ((0, "o"), (1, "e")) for h in HALVES]
    wide = voted.groupBy(*own).agg(*picked)
    turned = Window.partitionBy("_q", "_p").orderBy("_r")
    wide = wide.select("*", F.lead("o_hi").over(turned).alias("_nh"), F.lead("o_lo").over(turned).alias("_nl"))
    wide = wide.join(border.select("_q", "_p", "_bh", "_bl"), ["_q", "_p"])
    return wide.select(
        "doc_id", "n_chars", "edited_sha256", "o_hi", "o_lo", "e_hi", "e_lo",
        F.coalesce("_nh", "_bh").alias("n_hi"), F.coalesce("_nl", "_bl").alias("n_lo"),
    )


def _blocks(halves: tuple[Column, Column]) -> list[Column]:
    """The four 32-bit blocks, each with its number in the bits above."""
    values = [part for x in halves for part in (F.shiftrightunsigned(x, BLOCK), x.bitwiseAND(F.lit(common.LOW)))]
    return [v.bitwiseOR(F.lit(k << BLOCK).cast("long")) for k, v in enumerate(values)]


def within_radius(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(q_hi, q_lo, hi, lo): pairs of a query's and any fingerprint with at most ``radius`` differing bits.

    Both inputs hold distinct (hi, lo). There is a table for each of four blocks of 32 bits. Of two fingerprints within the
    radius, some block differs in at most radius // 4 bits; a query looks up every value of a block with that many
    bits turned (529 for a radius of 8 to 11), so every pair is found. It is given at the first such block, once.
    Fingerprints are stored four times at any radius; nothing is capped.
    """
    turns = radius * BLOCK // BITS
    masks = [sum(1 << i for i in bits) for n in range(turns + 1) for bits in itertools.combinations(range(BLOCK), n)]
    turned = F.expr(f"array({', '.join(f'{m}L' for m in masks)})")
    own, other = (F.col("hi"), F.col("lo")), (F.col("q_hi"), F.col("q_lo"))
    stored = fingerprints.select("hi", "lo", F.explode(F.array(*_blocks(own))).alias("_v"))
    asked = queries.select(F.col("hi").alias("q_hi"), F.col("lo").alias("q_lo"), F.explode(F.array(*_blocks(own))).alias("_b"))
    asked = asked.select("q_hi", "q_lo", F.explode(F.transform(turned, lambda m: m.bitwiseXOR(F.col("_b")))).alias("_v"))
    near = asked.join(stored, "_v").where(distance(own, other) <= radius)
    pairs = zip(_blocks(own), _blocks(other), strict=True)
    earlier = [(F.bit_count(x.bitwiseXOR(y)) <= turns) & (F.shiftright("_v", BLOCK) > k) for k, (x, y) in enumerate(pairs)]
    return near.where(~reduce(lambda a, b: a | b, earlier)).select("q_hi", "q_lo", "hi", "lo")


def near_counts(rows: DataFrame, asked: Column, radius: int = RADIUS) -> DataFrame:
    """``rows`` (hi, lo, ...) with n_near: how many rows are within ``radius`` bits, itself included; null where not ``asked``.

    Equal fingerprints are counted first, so a large group of copies is one fingerprint with a weight.
    """
    rows = cut_lineage(rows.withColumn("_asked", F.coalesce(asked, F.lit(False))))
    sizes = rows.groupBy("hi", "lo").agg(F.count("*").alias("_c"), F.max("_asked").alias("_any"))
    found = within_radius(sizes.where("_any").select("hi", "lo"), sizes.select("hi", "lo"), radius)
    summed = found.join(sizes.select("hi", "lo", "_c"), ["hi", "lo"]).groupBy("q_hi", "q_lo").agg(F.sum("_c").alias("n_near"))
    own = rows.where("_asked").join(summed, (F.col("hi") == F.col("q_hi")) & (F.col("lo") == F.col("q_lo"))).drop("q_hi", "q_lo")
    return own.unionByName(rows.where(~F.col("_asked")).withColumn("n_near", F.lit(None).cast("long"))).drop("_asked")
