"""Repair of broken conversations by the cheapest edits, the least of which is found by prefix-doubling path ranking.

A conversation is good when the first letters of its roles read ``(s?(ua)+)?``. Its rows can be kept, given the role
user or assistant, or deleted, and empty rows of these two roles can be inserted. What has been read so far is in one
of four states: nothing, after the system row, after a user row, after an assistant row.
"""

from __future__ import annotations

import hashlib
import json
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import WHITE
from tidemark.session import cut_lineage

BLOCK_BITS = 12  # rows of a conversation that are solved together, as a power of two
ROWS_AT_ONCE = 1 << 16
FAR = 1 << 40
DELETE, REROLE, INSERT, CUT = 3, 2, 2, 1  # costs; CUT is added for a truncated row that stays

EDITS = "DIKR"  # in the order that settles ties
LINE = [2, 2, 3, 2]  # the state after an inserted or rerolled row: user, but assistant after user
CLOSING = ["", "II", "I", ""]  # what makes the end of a conversation good, by state
KEPT = [[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]]  # by state and initial (s, u, a, other)


def _codes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code (4 * fault + initial): the state after keeping the row, the cost of keeping and of a new role."""
    kept = np.full((16, 4), -1)
    keep, rerole = np.full(16, FAR), np.full(16, FAR)
    for fault in (0, 3):
        for initial in range(4):
            kept[4 * fault + initial] = [KEPT[s][initial] for s in range(4)]
            keep[4 * fault + initial] = CUT if fault else 0
            rerole[4 * fault + initial] = REROLE + (CUT if fault else 0)
    return kept, keep, rerole


KEEP_TO, KEEP_COST, REROLE_COST = _codes()
FLIP = np.array(LINE)


def damage(rows: DataFrame, live: str = "live") -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults set by crc32(``conv_id:turn``) % 20, nulls read as one space.

    0 drops the row (it comes back with ``live`` false), 1 empties its text, 2 removes its ``.!?``, 3 repeats it,
    4 gives it the role user.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat_ws(":", *named[:2])) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(named[3], ".!?", "")).otherwise(named[3])
    copies = F.when(kind == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(kind != 0))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(named[2]).alias("role"), text.alias("text"), F.explode(copies).alias(live)
    )


def _read(rows: DataFrame, live: Column) -> DataFrame:
    """(conv, turn, role, text, hash, live): nulls of role and text as one space."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    cols = [F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")]
    return rows.select(*cols, F.sha2(text, 256).alias("hash"), F.coalesce(live, F.lit(False)).alias("live"))


def _blocks(read: DataFrame) -> DataFrame:
    """(conv, block, codes, turn, role, hash): runs of at most 2**BLOCK_BITS rows in order, a letter for each row.

    Rows are dealt by ranges of the whole order, so a conversation with a third of all rows lies in many tasks; the
    last key, a row number of the scan, parts equal rows as well. No text takes part.
    """
    order = ["turn", "role", "hash"]
    tail = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.array_position(F.array(*map(F.lit, "sua")), F.substring("role", 1, 1))
    own = F.when(F.btrim(F.col("text"), F.lit(WHITE)) == "", 1).when(F.right(tail, F.lit(1)).isin(*".!?"), 0).otherwise(3)
    rows = read.where("live").select(
        "conv", *order, own.alias("fault"), F.when(initial > 0, initial - 1).otherwise(3).cast("int").alias("initial"),
        F.monotonically_increasing_id().alias("tie"),
    )
    keys = ["conv", *order, "tie"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    rows = cut_lineage(rows.withColumn("at", F.monotonically_increasing_id()))
    first = rows.groupBy("conv", "role", "hash").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    marked = rows.join(first, "at", "left")
    fault = F.when((F.col("fault") != 1) & F.col("first").isNull(), 2).otherwise(F.col("fault"))
    letter = F.char(F.lit(ord("A")) + 4 * fault + F.col("initial"))
    placed = marked.select("conv", F.shiftright("at", BLOCK_BITS).alias("block"), "at", *order, letter.alias("letter"))
    grouped = placed.groupBy("conv", "block").agg(
        F.array_sort(F.collect_list(F.struct("at", "letter"))).alias("letters"), F.min(F.struct(*order)).alias("key")
    )
    codes = F.concat_ws("", F.transform("letters", lambda x: x["letter"]))
    return grouped.select(F.col("conv").cast("string").alias("conv"), "block", codes.alias("codes"), F.to_json("key").alias("key"))


def _numbers(codes: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The codes of several blocks one after the other, and where each block begins (and the last ends)."""
    flat = np.frombuffer("".join(codes).encode(), np.uint8).astype(np.int64) - ord("A")
    return flat, np.concatenate([[0], np.cumsum([len(c) for c in codes])])


def costs_to_go(flat: np.ndarray, bounds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Least cost from each (row, state) to the end of its block, where state s costs ``ends[block, s]`` more.

    Blocks are solved side by side, from their last rows to their first. ``ends`` may have further axes.
    """
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = bounds[:-1][order], lengths[order]
    now = ends[order].copy()
    out = np.empty((len(flat), *now.shape[1:]), np.int64)
    wide = (slice(None), slice(None), *[None] * (now.ndim - 2))
    for i in range(int(sizes.max(initial=0)) - 1, -1, -1):
        m = int(np.searchsorted(-sizes, -i, side="left"))  # blocks that have a row i
        at = starts[:m] + i
        code, after = flat[at], now[:m]
        target = KEEP_TO[code]
        kept = np.take_along_axis(after, np.maximum(target, 0)[wide], axis=1) + KEEP_COST[code][:, None][wide]
        best = np.minimum(after + DELETE, np.where((target >= 0)[wide], kept, FAR))
        best = np.minimum(best, after[:, FLIP] + REROLE_COST[code][:, None][wide])
        for _ in range(2):  # no cheapest path inserts more than two rows in one place
            best = np.minimum(best, best[:, FLIP] + INSERT)
        now[:m] = np.minimum(best, FAR)
        out[at] = now[:m]
    return out


def ranked_paths(flat: np.ndarray, bounds: np.ndarray, ends: np.ndarray) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """For each block and entry state: the least of the cheapest audits, the state it ends in, and its cost.

    Nodes are the arcs (edits) that lie on cheapest paths. Round k ranks each by the first 2**k edits of the least audit
    that begins with it: a pair of its rank and that of the node its pointer leads to. Pointers are then doubled. At the
    end ranks compare whole audits; the least arc out of an entry begins its path, and the pointers fill in the rest.
    """
    cost = costs_to_go(flat, bounds, ends)
    rows, last = len(flat), bounds[1:] - 1
    after = np.empty_like(cost)
    after[:-1] = cost[1:]
    after[last] = ends
    keep_to = KEEP_TO[flat]
    state = np.arange(4)[None, :]
    target = np.stack([np.broadcast_to(state, (rows, 4)), np.broadcast_to(FLIP, (rows, 4)), keep_to, np.broadcast_to(FLIP, (rows, 4))], axis=2)
    kept = np.take_along_axis(after, np.maximum(keep_to, 0), axis=1) + KEEP_COST[flat][:, None]
    total = np.stack(
        [after + DELETE, cost[:, FLIP] + INSERT, np.where(keep_to >= 0, kept, FAR), after[:, FLIP] + REROLE_COST[flat][:, None]], axis=2
    )
    optimal = (total == cost[:, :, None]).reshape(-1, 4)
    arcs = np.flatnonzero(optimal.ravel())
    number = np.full(rows * 16, -1, np.int64)
    number[arcs] = np.arange(len(arcs))
    label, row, to = arcs % 4, arcs // 16, target.reshape(-1)[arcs]
    least = number[np.arange(rows * 4) * 4 + optimal.argmax(axis=1)]  # the arc with the least label out of each (row, state)
    final = np.zeros(rows, bool)
    final[last] = True
    over = (label != 1) & final[row]
    head = np.where(over, 0, (row + (label != 1)) * 4 + to)
    pointer = np.where(over, -1, least[head])
    rank, length, pointers = label, np.ones(len(arcs), np.int64), [pointer]
    while (pointer >= 0).any():
        further = np.maximum(pointer, 0)
        live = pointer >= 0
        rank = np.unique(rank * (len(arcs) + 5) + np.where(live, rank[further] + 1, 0), return_inverse=True)[1]
        length = length + np.where(live, length[further], 0)
        pointer = np.where(live, pointer[further], -1)
        pointers.append(pointer)
    out = number[(bounds[:-1, None, None] * 4 + np.arange(4)[None, :, None]) * 4 + np.arange(4)[None, None, :]]
    ranks = np.where(out >= 0, rank[np.maximum(out, 0)], len(arcs) + 5)
    entry = np.take_along_axis(out, ranks.argmin(axis=2)[:, :, None], axis=2)[:, :, 0].ravel()
    size = length[entry]
    stops = np.cumsum(size)
    node = np.repeat(entry, size)
    step = np.arange(stops[-1]) - np.repeat(stops - size, size)
    for k, jump in enumerate(pointers):
        some = (step >> k) & 1 == 1
        node[some] = jump[node[some]]
    text = np.frombuffer(EDITS.encode(), np.uint8)[label[node]].tobytes().decode()
    audits = [text[a:b] for a, b in zip((stops - size).tolist(), stops.tolist(), strict=True)]
    exits = to[node[stops - 1]].reshape(-1, 4)
    return [audits[k : k + 4] for k in range(0, len(audits), 4)], exits, cost[bounds[:-1]]


def _parts(codes: list[str]) -> Iterator[slice]:
    """Slices of blocks with about ROWS_AT_ONCE rows."""
    first, rows = 0, 0
    for k, c in enumerate(codes):
        rows += len(c)
        if rows >= ROWS_AT_ONCE:
            yield slice(first, k + 1)
            first, rows = k + 1, 0
    if first < len(codes):
        yield slice(first, len(codes))


def _matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks with the least costs from each state at their begin to each at their end."""
    unit = np.where(np.eye(4, dtype=bool), 0, FAR)
    for batch in batches:
        codes = batch["codes"].tolist()
        made: list[str] = []
        for part in _parts(codes):
            flat, bounds = _numbers(codes[part])
            cost = costs_to_go(flat, bounds, np.repeat(unit[None], len(bounds) - 1, axis=0))
            made += [json.dumps(m) for m in cost[bounds[:-1]].tolist()]
        yield batch.assign(matrix=made)


def _ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks with the least costs from their end to that of the conversation; blocks come last first."""
    conv, now = "", [INSERT * len(c) for c in CLOSING]
    for batch in batches:
        ends = []
        for own, matrix in zip(batch["conv"].fillna("null"), batch.pop("matrix"), strict=True):
            if own != conv:
                conv, now = own, [INSERT * len(c) for c in CLOSING]
            ends.append(json.dumps(now))
            now = [min(a + b for a, b in zip(row, now, strict=True)) for row in json.loads(matrix)]
        yield batch.assign(ends=ends)


def _paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks with, as JSON, what :func:`ranked_paths` finds, the counts of their faults and their outer initials."""
    for batch in batches:
        codes, ends = batch["codes"].tolist(), [json.loads(e) for e in batch["ends"]]
        found: list[str] = []
        for part in _parts(codes):
            flat, bounds = _numbers(codes[part])
            audits, exits, costs = ranked_paths(flat, bounds, np.array(ends[part], np.int64))
            for k, (audit, to, cost) in enumerate(zip(audits, exits.tolist(), costs.tolist(), strict=True)):
                own = flat[bounds[k] : bounds[k + 1]]
                initials = own % 4
                faults = np.bincount(own // 4, minlength=4)[1:].tolist()
                broken = int((~_follows(initials[:-1], initials[1:])).sum())
                found.append(json.dumps([audit, to, cost, faults, broken, [int(initials[0]), int(initials[-1])]]))
        yield batch[["conv", "block", "key"]].assign(found=found)


def _follows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """su, ua or au, for initials numbered s, u, a, other."""
    return ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))


def _merged(rows: DataFrame, live: Column) -> DataFrame:
    """Rows and solved blocks together by conversation, each block before the first of its rows.

    The texts cross this one shuffle only. A task reads a conversation as a stream and never holds it.
    """
    read = _read(rows, live)
    blocks = cut_lineage(_blocks(read))
    solved = blocks.mapInPandas(_matrices, "conv string, block long, codes string, key string, matrix string")
    solved = solved.repartition("conv").sortWithinPartitions("conv", F.desc("block"))
    solved = solved.mapInPandas(_ends, "conv string, block long, codes string, key string, ends string")
    solved = solved.repartition("conv", "block").mapInPandas(_paths, "conv string, block long, key string, found string")
    key = F.from_json("key", "turn long, role string, hash string")
    nothing = F.lit(None).cast("string")
    solved = solved.select("conv", key["turn"].alias("turn"), key["role"].alias("role"), key["hash"].alias("hash"), "block", "found", nothing.alias("text"), F.lit(True).alias("live"))
    own = read.select(F.col("conv").cast("string").alias("conv"), "turn", "role", "hash", F.lit((1 << 63) - 1).alias("block"), nothing.alias("found"), "text", "live")
    both = solved.unionByName(own).repartition("conv").sortWithinPartitions("conv", "turn", "role", "hash", "block")
    return both.select("conv", F.col("turn").cast("string").alias("turn"), "role", "found", "text", "live")


class _Conversation:
    """State of one conversation while its blocks and rows pass by."""

    def __init__(self) -> None:
        self.state = self.written = 0  # states: before the next block, and of the rows written
        self.waiting: deque[Iterator[str]] = deque()
        self.audit: list[str] = []
        self.cost: int | None = None
        self.faults = [0, 0, 0]
        self.illegal, self.initial = 0, -1
        self.turns: list[int] = []  # least, greatest, number of different

    def block(self, found: str) -> None:
        audits, exits, costs, faults, broken, (first, last) = json.loads(found)
        audit = audits[self.state]
        self.cost = costs[self.state] if self.cost is None else self.cost
        self.state = exits[self.state]
        self.audit.append(audit)
        self.waiting.append(iter(audit))
        self.faults = [a + b for a, b in zip(self.faults, faults, strict=True)]
        self.illegal += broken
        if self.initial >= 0:
            self.illegal += not _follows(np.array(self.initial), np.array(first))
        self.initial = last

    def _line(self) -> str:
        self.written = LINE[self.written]
        return "assistant" if self.written == 3 else "user"

    def row(self, turn: str | None, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the rows inserted before this one, and of itself."""
        if turn is not None:
            t = int(turn)
            if not self.turns:
                self.turns = [t, t, 1]
            elif t != self.turns[1]:
                self.turns[1:] = [t, self.turns[2] + 1]
        for edit in chain.from_iterable(self._edits()):
            if edit == "I":
                yield edit, self._line(), ""
                continue
            if edit == "K":
                self.written = 1 + "sua".index(role[0])
            yield edit, self._line() if edit == "R" else role, text
            return

    def _edits(self) -> Iterator[Iterator[str]]:
        while self.waiting:
            yield self.waiting[0]
            self.waiting.popleft()

    def close(self) -> Iterator[tuple[str, str, str]]:
        for edit in CLOSING[self.state]:
            self.audit.append(edit)
            yield edit, self._line(), ""

    def gaps(self) -> int:
        return min(self.turns[1] - self.turns[0] + 1 - self.turns[2], (1 << 63) - 1) if self.turns else 0


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str | None, _Conversation, Iterator[tuple[str, str, str]] | None]]:
    """(conv_id, its state, edited rows) for each row, and once with None in the end."""
    now: tuple[str | None, _Conversation] | None = None
    for batch in batches:
        ids = batch["conv"].astype(object).where(batch["conv"].notna(), None)
        turns = batch["turn"].astype(object).where(batch["turn"].notna(), None)
        for conv, turn, role, found, text, live in zip(ids, turns, batch["role"], batch["found"], batch["text"], batch["live"], strict=True):
            if now is None or now[0] != conv:
                if now is not None:
                    yield *now, now[1].close()
                    yield *now, None
                now = conv, _Conversation()
            if isinstance(found, str):
                now[1].block(found)
            elif live:
                yield *now, now[1].row(turn, role, text)
    if now is not None:
        yield *now, now[1].close()
        yield *now, None


def repaired(rows: DataFrame, live: Column | None = None) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows of the repaired conversations, and the deleted ones (place null).

    ``rows`` has conv_id, turn, role and text; other columns don't matter. They are read by turn (nulls first); rows of
    one turn by role and a hash of the text. Null roles and texts are read as one space, rows without conv_id are one
    conversation, and repeated rows are duplicates. Where ``live`` is not true a row only tells that its conversation
    exists. An empty table gives no rows.
    """

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        place: dict[int, int] = {}
        for conv, state, edited in _conversations(batches):
            if edited is None:
                place.clear()
                continue
            for edit, role, text in edited:
                at = place.get(id(state), 0)
                place[id(state)] = at + (edit != "D")
                held.append((conv, None if edit == "D" else str(at), edit, role, text))
            if len(held) >= 1_000:
                yield pd.DataFrame(held, columns=["conv_id", "place", "edit", "role", "text"])
                held = []
        yield pd.DataFrame(held, columns=["conv_id", "place", "edit", "role", "text"])

    merged = _merged(rows, F.lit(True) if live is None else live)
    found = merged.mapInPandas(lines, "conv_id string, place string, edit string, role string, text string")
    return found.withColumns({c: F.col(c).cast("long") for c in ("conv_id", "place")})


def summaries(rows: DataFrame, live: Column | None = None) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are read as in :func:`repaired`. The hash is taken of the repaired ``role:text`` lines as they pass. A
    conversation without live rows has zeros, an empty audit and the hash of nothing; an empty table gives no rows.
    """
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        digest, any_line = hashlib.sha256(), False
        for conv, state, edited in _conversations(batches):
            if edited is not None:
                for edit, role, text in edited:
                    if edit != "D":
                        digest.update(f"{'\n' if any_line else ''}{role}:{text}".encode())
                        any_line = True
                continue
            held.append((conv, state.gaps(), *state.faults, state.illegal, state.cost or 0, "".join(state.audit), digest.hexdigest()))
            digest, any_line = hashlib.sha256(), False
            if len(held) >= 1_000:
                yield pd.DataFrame(held, columns=columns)
                held = []
        yield pd.DataFrame(held, columns=columns)

    kinds = ["string", *["long"] * 6, "string", "string"]
    schema = ", ".join(f"{c} {k}" for c, k in zip(columns, kinds, strict=True))
    merged = _merged(rows, F.lit(True) if live is None else live)
    return merged.mapInPandas(lines, schema).withColumn("conv_id", F.col("conv_id").cast("long"))
