"""Mixing sources to target weights by Pfair scheduling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidemark.llm import common
from tidemark.session import cut_lineage

PERIOD = 1_000
BLOCK_BYTES = 4_096
TEMPER = 0.9
PARTS_PER_SOURCE = 10
GROUP_SLOTS = 4_096  # slots of a group that one task halves on its own


def tempered_parts(sizes: DataFrame, temper: float = TEMPER, period: int = PERIOD) -> DataFrame:
    """(source, parts): a source's share of the bytes to the power ``temper``, in whole parts of ``period``.

    Every source gets one part; the others are dealt by largest remainder (ties by name). With more sources than
    ``period``, PARTS_PER_SOURCE each are dealt by the same rule, and remainders are ranked by ranges, not in one task.
    """
    weight = F.pow(F.col("bytes").cast("double"), F.lit(temper))
    n, total = sizes.agg(F.count("*"), F.sum(weight)).first()
    if n > period:
        period = PARTS_PER_SOURCE * n
        shared = sizes.select("source", (weight / F.lit(total) * F.lit(period - n)).alias("_x"))
        shared = shared.select("source", F.floor("_x").alias("_whole"), (F.col("_x") - F.floor("_x")).alias("_rest"))
        shared = _numbered(shared, "_rank", F.round("_rest", 9).desc(), F.col("source").asc_nulls_first())
        spare = period - n - shared.agg(F.sum("_whole")).first()[0]
        return shared.select("source", (F.col("_whole") + 1 + (F.col("_rank") < spare).cast("long")).cast("long").alias("parts"))
    all_rows = Window.partitionBy(F.lit(0))
    shared = sizes.select(
        "source", F.count("*").over(all_rows).alias("_n"), (weight / F.sum(weight).over(all_rows)).alias("_w")
    ).select("source", "_n", (F.col("_w") * (F.lit(period) - F.col("_n"))).alias("_x"))
    shared = shared.select("source", F.floor("_x").alias("_whole"), (F.col("_x") - F.floor("_x")).alias("_rest"), "_n")
    order = Window.partitionBy(F.lit(0)).orderBy(F.round("_rest", 9).desc(), F.col("source").asc_nulls_first())
    spare = F.lit(period) - F.col("_n") - F.sum("_whole").over(all_rows)
    extra = (F.row_number().over(order) <= spare).cast("long")
    return shared.select("source", (F.col("_whole") + 1 + extra).cast("long").alias("parts"))


def schedule(parts: DataFrame) -> DataFrame:
    """(source, nth, slot, parts, period): the slots of one period, period being the sum of the parts.

    Block i of a source with weight w = parts / period is released at floor(i / w) and due at ceil((i + 1) / w);
    each slot goes to the released block that is due first (ties by name). All blocks meet their dues, so after any
    number of slots a source is less than one block from its weight. The next period repeats the slots.
    Up to PERIOD sources are scheduled slot by slot; more of them get the same slots from :func:`halved_schedule`.
    """
    if parts.count() > PERIOD:
        return halved_schedule(parts)
    listed = parts.groupBy().agg(F.sort_array(F.collect_list(F.struct("source", "parts"))).alias("_s"))
    listed = listed.where(F.size("_s") > 0)
    period = F.aggregate("_s", F.lit(0).cast("long"), lambda a, s: a + s["parts"])
    listed = listed.withColumn("_period", period).withColumn("_parts", F.transform("_s", lambda s: s["parts"]))
    start = F.struct(F.transform("_parts", lambda p: F.lit(0).cast("long")).alias("next"), F.array().cast("array<int>").alias("out"))
    h = F.col("_period")

    def turn(state: Column, slot: Column) -> Column:
        def due(n: Column, p: Column) -> Column:
            released = F.floor(n * h / p) <= slot
            return F.when(released & (n < p), F.ceil((n + 1) * h / p))

        dues = F.zip_with(state["next"], F.col("_parts"), due)
        chosen = F.array_position(dues, F.array_min(dues)).cast("int")
        bound = F.transform(F.array(chosen), lambda c: F.struct(
            F.transform(state["next"], lambda n, i: n + (i + 1 == c).cast("long")).alias("next"),
            F.array_append(state["out"], c).alias("out"),
        ))
        return bound[0]

    slots = F.sequence(F.lit(0).cast("long"), h - 1)
    planned = listed.select("_s", "_period", F.aggregate(slots, start, turn)["out"].alias("_out"))
    each = planned.select("_s", "_period", F.posexplode("_out").alias("slot", "_c")).select(
        F.element_at("_s", F.col("_c")).alias("_x"), F.col("_period").alias("period"), F.col("slot").cast("long").alias("slot")
    )
    turnwise = Window.partitionBy("_x").orderBy("slot")
    nth = (F.row_number().over(turnwise) - 1).cast("long")
    return each.select(F.col("_x.source").alias("source"), nth.alias("nth"), "slot", F.col("_x.parts").alias("parts"), "period")


def _numbered(df: DataFrame, out: str, *order: Column) -> DataFrame:
    """``df`` with ``out``: the gapless place of each row (from 0) in the whole order, by one exchange by ranges."""
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    held = cut_lineage(sorted_.withColumn("_id", F.monotonically_increasing_id()))
    task = F.shiftright("_id", 33).alias("_task")
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = held.groupBy(task).agg(F.count("*").alias("_c")).select("_task", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_first"))
    placed = held.withColumn("_task", task).join(F.broadcast(tasks), "_task")
    return placed.withColumn(out, F.col("_first") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_task", "_first", "_id")


def halved_schedule(parts: DataFrame) -> DataFrame:
    """The slots of :func:`schedule`, row by row the same, for any number of sources and without a sequence in one task.

    Earliest due first is this: in the order of (due, name), each block takes the first free slot from its release on.
    Which slots the first half of these blocks fills does not depend on their order, but only on how many are released
    when: a slot stays free where the running sum of (released - 1) falls to a new minimum below 0. So the first half
    and its slots become one group, the other blocks and the free slots another, each with its own gapless
    times; every group is halved anew until a block has one slot left.
    """
    h = parts.agg(F.sum("parts")).first()[0]
    nth = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("nth")
    blocks = parts.select("source", F.col("parts").cast("long").alias("parts")).select("source", "parts", nth)
    blocks = blocks.withColumn("t", F.expr(f"nth * {h}L div parts")).withColumn("_due", F.expr(f"((nth + 1) * {h}L + parts - 1) div parts"))
    blocks = _numbered(blocks, "k", F.col("_due").asc(), F.col("source").asc_nulls_first()).drop("_due")
    blocks = blocks.withColumn("g", F.lit(1).cast("long")).withColumn("m", F.lit(h).cast("long"))
    slots = parts.sparkSession.range(h).select(F.lit(1).cast("long").alias("g"), F.col("id").alias("t"), F.col("id").alias("slot"))
    size = h
    while size > GROUP_SLOTS:
        blocks, slots = map(cut_lineage, _halved(blocks, slots))
        size = -(-size // 2)
    none = [F.lit(None).cast("long").alias(c) for c in ("k", "m", "nth", "parts")]
    rows = blocks.select("g", "t", F.lit(None).cast("long").alias("slot"), "k", "m", "nth", "parts", "source")
    rows = rows.unionByName(slots.select("g", "t", "slot", *none, F.lit(None).cast("string").alias("source")))
    rows = rows.withColumn("_base", F.col("g")).repartition("_base")
    for _ in range((size - 1).bit_length()):
        rows = _halved_in_place(rows)
    found = rows.groupBy("_base", "g").agg(*[F.max(c).alias(c) for c in ("source", "nth", "slot", "parts")])
    return found.select("source", "nth", "slot", "parts", F.lit(h).cast("long").alias("period"))


def _halved(blocks: DataFrame, slots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One halving of groups of any size: times are cut into chunks, only sums and minima of chunks meet in one place."""
    early = F.col("k") < F.floor(F.col("m") / 2)
    released = blocks.where(early).groupBy("g", "t").agg(F.count("*").alias("_n"))
    run = Window.partitionBy("g", "_c").orderBy("t")
    upto, before = run.rowsBetween(Window.unboundedPreceding, 0), run.rowsBetween(Window.unboundedPreceding, -1)
    timed = slots.withColumn("_c", F.floor(F.col("t") / common.ROWS_PER_BUCKET)).join(released, ["g", "t"], "left")
    timed = timed.withColumn("_x", F.sum(F.coalesce("_n", F.lit(0)) - 1).over(upto))
    timed = timed.withColumn("_y", F.min("_x").over(upto)).withColumn("_z", F.min("_x").over(before))
    ends = timed.groupBy("g", "_c").agg(F.max_by("_x", "t").alias("_sum"), F.min("_x").alias("_least"))
    past = Window.partitionBy("g").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_first", F.coalesce(F.sum("_sum").over(past), F.lit(0)))
    ends = ends.withColumn("_low", F.least(F.min(F.col("_first") + F.col("_least")).over(past), F.lit(0)))
    timed = timed.join(ends.select("g", "_c", "_first", "_low"), ["g", "_c"])
    free = F.col("_first") + F.col("_x") < F.least("_low", F.col("_first") + F.col("_z"))
    timed = timed.select("g", "t", "slot", free.alias("_free"), (-F.least("_low", F.col("_first") + F.col("_y"))).alias("_idle"))
    split = timed.select(
        (F.col("g") * 2 + F.col("_free").cast("long")).alias("g"),
        F.when(F.col("_free"), F.col("_idle") - 1).otherwise(F.col("t") - F.col("_idle")).alias("t"),
        "slot",
    )
    idle = blocks.join(timed.select("g", (F.col("t") + 1).alias("t"), "_idle"), ["g", "t"], "left")
    return _split(idle.withColumn("_idle", F.coalesce("_idle", F.lit(0))), early).select(blocks.columns), split


def _split(blocks: DataFrame, early: Column) -> DataFrame:
    half = F.floor(F.col("m") / 2)
    moved = {
        "g": F.col("g") * 2 + (~early).cast("long"),
        "t": F.when(early, F.col("t") - F.col("_idle")).otherwise(F.col("_idle")),
        "k": F.when(early, F.col("k")).otherwise(F.col("k") - half),
        "m": F.when(early, half).otherwise(F.col("m") - half),
    }
    return blocks.withColumns(moved)


def _halved_in_place(rows: DataFrame) -> DataFrame:
    """One halving of small groups that lie in one task each; blocks (without slot) and slots are rows of one table."""
    is_slot, early = F.col("slot").isNotNull(), F.col("k") < F.floor(F.col("m") / 2)
    run = Window.partitionBy("_base", "g").orderBy("t", is_slot)
    upto, before = run.rowsBetween(Window.unboundedPreceding, 0), run.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_x", F.sum(F.when(is_slot, -1).when(early, 1).otherwise(0)).over(upto))
    free = is_slot & (F.col("_x") < F.least(F.min("_x").over(before), F.lit(0)))
    rows = rows.withColumns({"_idle": -F.least(F.min("_x").over(upto), F.lit(0)), "_free": free})
    half = F.floor(F.col("m") / 2)
    late = F.when(is_slot, F.col("_free")).otherwise(~early)
    return rows.select(
        "_base",
        (F.col("g") * 2 + late.cast("long")).alias("g"),
        F.when(late, F.col("_idle") - is_slot.cast("long")).otherwise(F.col("t") - F.col("_idle")).alias("t"),
        "slot",
        F.when(early, F.col("k")).otherwise(F.col("k") - half).alias("k"),
        F.when(early, half).otherwise(F.col("m") - half).alias("m"),
        "nth", "parts", "source",
    )


def mix(docs: DataFrame, block_bytes: int = BLOCK_BYTES, parts: DataFrame | None = None) -> DataFrame:
    """All of ``docs`` in _doc, with source, bytes, block, slot and in_mix.

    A source's documents follow each other in the order of a hash of their id; block is the ``block_bytes`` range of
    that stream in which a document starts. slot is the block's place in the mixture, the same for all documents of
    a block. in_mix holds until the first source has no block left; beyond that, the others keep their order.
    bytes: UTF-8 bytes plus 1. Null is a source like any other. Weights: ``parts`` (source, parts), or
    :func:`tempered_parts`. A source without parts is never in the mix (slot null). No rows are dropped.
    """
    rows = docs.select(
        F.struct("*").alias("_doc"), F.col("doc_id"), F.col("source").cast("string").alias("source"), F.col("text")
    )
    rows = rows.withColumn("bytes", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long"))
    rows = rows.withColumn("_md5", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).withColumn("_x", F.xxhash64("text"))
    sizes = rows.groupBy("source").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("_rows"))
    sizes = cut_lineage(sizes)
    parts = tempered_parts(sizes.select("source", "bytes")) if parts is None else parts
    plan = cut_lineage(schedule(parts))

    # Keys without nulls: a null-safe join would be dealt out anew, and the texts with it.
    key = F.when(F.col("source").isNotNull(), F.concat(F.lit("="), F.col("source"))).otherwise("")
    counts = plan.groupBy(key.alias("_k")).agg(F.first("parts").alias("_parts"), F.first("period").alias("_period"))
    slots = plan.select(key.alias("_k"), F.col("nth").alias("_nth"), F.col("slot").alias("_slot"))
    if parts.count() <= PERIOD:  # one period of slots
        slots = F.broadcast(slots)
    sliced = sizes.where(F.col("_rows") > common.ROWS_PER_BUCKET)  # one source for some thousand rows, at most
    sliced = sliced.select(key.alias("_k"), F.ceil(F.col("_rows") / common.ROWS_PER_BUCKET).alias("_n"))
    cut = rows.withColumn("_k", key).join(F.broadcast(sliced), "_k", "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    unit = F.conv(F.substring("_md5", 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    cut = cut.withColumn("_b", F.floor(unit * F.col("_n"))).drop("_n", "text")
    whole = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy("_k", "_b").agg(F.sum("bytes").alias("_c"))
    offsets = offsets.select("_k", "_b", F.coalesce(F.sum("_c").over(whole), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_k", "_b").orderBy("_md5", "bytes", "_x").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.join(counts, "_k", "left")
    placed = cut.withColumn("_in", F.coalesce(F.sum("bytes").over(inside), F.lit(0))).join(offsets, ["_k", "_b"])
    placed = placed.withColumn("block", F.floor((F.col("_before") + F.col("_in")) / block_bytes).cast("long"))
    placed = placed.drop("_b", "_before", "_in", "_md5", "_x")

    def slotted(df: DataFrame, block: str) -> DataFrame:
        df = df.withColumn("_nth", F.col(block) % F.col("_parts")).join(slots, ["_k", "_nth"], "left")
        slot = F.floor(F.col(block) / F.col("_parts")) * F.col("_period") + F.col("_slot")
        return df.withColumn("slot", slot.cast("long"))

    blocks = sizes.select(key.alias("_k"), (F.floor((F.col("bytes") - 1) / block_bytes) + 1).cast("long").alias("_blocks"))
    end = slotted(blocks.join(counts, "_k", "left"), "_blocks").agg(F.min("slot")).first()[0]
    inside = F.coalesce(F.col("slot") < F.lit(end), F.lit(False))
    return slotted(placed, "block").select("_doc", "doc_id", "source", "bytes", "block", "slot", inside.alias("in_mix"))


def in_order(docs: DataFrame, block_bytes: int = BLOCK_BYTES, parts: DataFrame | None = None) -> DataFrame:
    """``docs`` in the order of their slots in the mixture; only documents of a source without parts go.

    The slots of a source that has run out are passed over, so the others go on at their weights, and no source ends
    the mixture for the rest. Documents of one block keep the order of their source's stream.
    """
    placed = mix(docs, block_bytes, parts).where(F.col("slot").isNotNull())
    stream = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return placed.orderBy("slot", stream, "bytes").select("_doc.*")
