"""Shards of equal bytes from a k-d tree over the metadata of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tidemark.llm import common
from tidemark.session import cut_lineage

STEPS = 65_535
TOLERANCE = 0.002
SHIFTS = (47, 31, 15, 0)  # of the key's digits: 16 bits of the dimension, 32 of the text's hash, 15 of the row's


def dimensions(text: Column, size: Column) -> list[Column]:
    """Metadata of a text, equal for equal texts: log of the bytes, share of multi-byte characters, share of line ends."""
    chars = F.greatest(F.char_length(text), F.lit(1))
    lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return [F.log2(size), (F.octet_length(text) - F.char_length(text)) / chars, lines / chars]


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): one row per document; give ``shards`` or ``target_bytes``.

    size: UTF-8 bytes plus 1 (null text: 1). A node with several shards is cut at the weighted median of its
    widest dimension (at the weighted quantile, if its shards are odd). Copies of a text have equal keys and stay
    together unless that would leave a side more than TOLERANCE of the node off its share; then they are split by a
    hash of the id and the row's number, which parts repeated rows and rows without id as well. slot numbers a shard's rows from 0. An empty table gives no rows.

    Only (id, size, hashes, dimensions) are held, not texts. A median is found in four rounds, each a sum of bytes
    by the next 16 bits of the key, so no node is ever sorted or sent to one task.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    rows = docs.select(
        F.col("doc_id"), size.alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("_h"),
        F.xxhash64(F.col("doc_id"), F.monotonically_increasing_id()).alias("_t"), F.array(*dimensions(text, size)).alias("_d"),
    )
    rows = cut_lineage(rows)
    n = len(dimensions(text, size))
    spread = rows.agg(F.sum("size"), *[f(F.col("_d")[k]) for k in range(n) for f in (F.min, F.max)]).first()
    total = spread[0] or 0
    shards = shards or max(1, round(total / target_bytes))
    scaled = []
    for k in range(n):
        low, high = (spread[1 + 2 * k] or 0.0), (spread[2 + 2 * k] or 0.0)
        scaled.append(F.floor((F.col("_d")[k] - low) / ((high - low) or 1.0) * STEPS).cast("long"))
    rows = rows.select("doc_id", "size", "text_crc32", "_h", "_t", F.array(*scaled).alias("_d"), F.lit(0).alias("_node"))
    quotas = {0: (0, shards)}  # node: first shard, number of shards
    while any(q > 1 for _, q in quotas.values()):
        rows, quotas = _level(spark, rows, quotas, n)
    first = _lookup(spark, [(node, a) for node, (a, _) in quotas.items()], "_id int, shard int")
    rows = rows.join(F.broadcast(first), F.col("_node") == F.col("_id")).select("doc_id", "size", "text_crc32", "_t", "shard")
    unit = F.shiftrightunsigned("_t", 12) / F.lit(float(1 << 52))
    return common.ranked(rows, "shard", unit, [F.col("doc_id"), F.col("text_crc32")], "slot", small_groups=True).drop("_t")


def _lookup(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of literals: at most one row per shard, so it may be broadcast."""
    names = [c.split() for c in schema.split(", ")]
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, names, strict=True)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _level(spark: SparkSession, rows: DataFrame, quotas: dict, n: int) -> tuple[DataFrame, dict]:
    """Cuts every node that still has several shards in two."""
    spreads = [F.max(F.col("_d")[k]) - F.min(F.col("_d")[k]) for k in range(n)]
    facts = rows.groupBy("_node").agg(F.sum("size"), *spreads).collect()
    cuts = {}
    for node, size, *wide in facts:
        if quotas[node][1] > 1:
            axis = max(range(n), key=lambda k: wide[k])
            goal = size * (quotas[node][1] // 2) / quotas[node][1]
            cuts[node] = {"axis": axis, "prefix": 0, "left": goal, "size": size}
    if not cuts:  # no rows in any node
        return rows, {2 * node: (first, 1) for node, (first, _) in quotas.items()}
    hashed = F.shiftrightunsigned("_h", 32) * F.lit(1 << 15) + F.shiftrightunsigned("_t", 49)
    axes = _lookup(spark, [(k, c["axis"]) for k, c in cuts.items()], "_id int, _axis int")
    keyed = rows.join(F.broadcast(axes), F.col("_node") == F.col("_id"), "left").drop("_id")
    keyed = keyed.withColumn("_key", F.shiftleft(F.element_at("_d", F.coalesce("_axis", F.lit(0)) + 1), 47) + hashed)
    keyed = cut_lineage(keyed.drop("_axis"))
    for turn, shift in enumerate(SHIFTS):
        wanted = {k: c for k, c in cuts.items() if "end" not in c}
        if not wanted:
            break
        table = _lookup(spark, [(k, c["prefix"], c["left"]) for k, c in wanted.items()], "_id int, _prefix long, _left double")
        above = SHIFTS[turn - 1] if turn else 63
        inside = keyed.join(F.broadcast(table), (F.col("_node") == F.col("_id")) & (F.shiftright("_key", above) == F.col("_prefix")))
        digit = F.shiftright("_key", shift)
        sums = inside.groupBy("_id", digit.alias("_digit"), "_left").agg(F.sum("size").alias("_bytes"))
        so_far = Window.partitionBy("_id").orderBy("_digit")
        sums = sums.withColumn("_sum", F.sum("_bytes").over(so_far))
        reached = sums.where((F.col("_sum") >= F.col("_left")) & (F.col("_sum") - F.col("_bytes") < F.col("_left")))
        for r in reached.select("_id", "_digit", "_bytes", "_sum").collect():
            cut = cuts[r["_id"]]
            before, after = cut["left"] - (r["_sum"] - r["_bytes"]), r["_sum"] - cut["left"]
            cut["prefix"], cut["left"] = r["_digit"], before
            near = min(before, after) <= TOLERANCE * cut["size"]
            if (turn == 2 and near) or turn == 3:  # a text's copies end here, or its rows do
                cut["end"] = (r["_digit"] + (after <= before)) << shift
    table = _lookup(spark, [(k, c["end"]) for k, c in cuts.items()], "_id int, _end long")
    placed = keyed.join(F.broadcast(table), F.col("_node") == F.col("_id"), "left")
    right = F.coalesce((F.col("_key") >= F.col("_end")).cast("int"), F.lit(0))
    placed = placed.withColumn("_node", F.col("_node") * 2 + right).drop("_id", "_end", "_key")
    below = {}
    for node, (first, q) in quotas.items():
        half = q // 2
        if node in cuts:
            below[2 * node], below[2 * node + 1] = (first, half), (first + half, q - half)
        else:  # one shard, or no rows
            below[2 * node] = (first, 1)
    return cut_lineage(placed), below
