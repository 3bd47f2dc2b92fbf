"""Best-fit packing of tokenized documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import common
from tidemark.session import cut_lineage

CAPACITY = 1024
END = 2
FLUSH = 8 << 20


def added_tokens(tokenizer_path: str) -> list[str]:
    from tokenizers import Tokenizer

    return [t.content for t in Tokenizer.from_file(tokenizer_path).get_added_tokens_decoder().values()]


def encoder(tokenizer_path: str, ranks_path: str, pattern: str, added: list[str]) -> Callable[[str], bytes]:
    """A function from a text to its token ids as little-endian unsigned 32-bit bytes.

    ``ranks_path`` holds the vocabulary of ``tokenizer_path`` as ranks, ``pattern`` its cut into pre-tokens; the
    ids are the same and made several times faster. A text with one of the tokenizer's ``added`` tokens, or one
    that the fast way can't cut, goes to the tokenizer itself, which is loaded only then.
    """
    import base64

    import tiktoken

    slow = None
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> bytes:
        nonlocal slow
        if not any(a in text for a in added):
            try:
                return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
            except ValueError:  # very long runs of blanks exceed the stack of its pattern matcher
                pass
        if slow is None:
            from tokenizers import Tokenizer

            slow = Tokenizer.from_file(tokenizer_path)
        return np.array(slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    return encode


def token_pieces(
    docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, end_id: int = END, capacity: int = CAPACITY,
    place: str | None = None,
) -> DataFrame:
    """(doc_id, piece, start, length, ids): each document's ids and ``end_id``, cut only where over ``capacity``.

    ``ids`` are little-endian unsigned 32-bit numbers in one binary value. The first piece takes what does not
    fill a piece. Null text counts as empty: one piece with ``end_id`` alone. Texts are read whole.
    ``place``: a whole number of each document that its pieces keep.
    """
    last = np.array([end_id], "<u4").tobytes()
    added = added_tokens(tokenizer_path)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path, ranks_path, pattern, added)
        held: list[tuple] = []
        size = 0
        for batch in batches:
            kept = batch[place] if place else [None] * len(batch)
            for doc_id, text, at in zip(batch["doc_id"], batch["text"].fillna(""), kept, strict=True):
                ids = encode(text) + last
                total = len(ids) // 4
                size += len(ids)
                end, piece = (total - 1) % capacity + 1, 0
                start = 0
                while start < total:
                    held.append((doc_id, piece, start, end - start, ids[4 * start : 4 * end], at))
                    start, end, piece = end, end + capacity, piece + 1
                if size > FLUSH:
                    yield frame(held)
                    held, size = [], 0
        if held:
            yield frame(held)

    def frame(held: list[tuple]) -> pd.DataFrame:
        found = pd.DataFrame(held, columns=["doc_id", "piece", "start", "length", "ids", place or "_"])
        return found if place else found.drop(columns="_")

    common.small_batches(docs.sparkSession)
    schema = "doc_id string, piece int, start long, length long, ids binary" + (f", {place} long" if place else "")
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", *[place] * bool(place))  # pandas would round ids beside a null
    return rows.mapInPandas(cut, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, first bin, per bin, offset) that place all items, from counts by length alone.

    Lengths go from large to small. Items above a third of the capacity are matched greedily, at most two to a
    bin; smaller ones go to the tightest gap that holds them. Items of equal length are alike, so a run of them
    is placed into a run of equal bins in one step: the work depends on the capacity, not on the number of items.
    """
    open_bins: dict[int, list[tuple[int, int]]] = {}
    gaps: list[int] = []
    placed: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def keep(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in open_bins:
                open_bins[gap] = []
                bisect.insort(gaps, gap)
            open_bins[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        most = 2 if 3 * length > capacity else capacity
        while left:
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, n = open_bins[gap].pop()
                if not open_bins[gap]:
                    del open_bins[gap]
                    gaps.pop(at)
            else:
                gap, first = capacity, bins
                per = min(most, capacity // length)
                n = -(-left // per)
                bins += n
            per = min(most, gap // length)
            full, rest = divmod(min(left, n * per), per)
            placed.append((length, rank, first, per, capacity - gap))
            keep(gap - per * length, first, full)
            keep(gap - rest * length, first + full, 1 if rest else 0)
            keep(gap, first + full + (1 if rest else 0), n - full - (1 if rest else 0))
            rank += full * per + rest
            left -= full * per + rest
    return np.array(sorted(placed), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY, place: str | None = None) -> DataFrame:
    """``pieces`` with (sequence_id, offset): a place for each, gapless from 0 in its sequence.

    ``pieces`` needs doc_id, piece and length (1 to ``capacity``); other columns stay. It is read several times
    and is written to the shared folder first. The driver sees one count per length; items are numbered within
    their length by many tasks, and each looks its place up in the plan (a few thousand rows, a fixed bound).
    An empty table gives no rows. ``place``: a column whose least value in a sequence gives the sequences their order.
    """
    pieces = cut_lineage(pieces)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    steps = plan(counts, capacity)
    base = np.zeros(capacity + 2, np.int64)
    for length in sorted(counts):
        base[length + 1] = counts[length]
    base = np.cumsum(base)
    starts = base[steps[:, 0]] + steps[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        item = base[length.to_numpy()] + rank.to_numpy()
        step = np.searchsorted(starts, item, side="right") - 1
        nth = item - starts[step]
        _, _, first, per, offset = steps[step].T
        return pd.DataFrame({"sequence_id": first + nth // per, "offset": offset + nth % per * length.to_numpy()})

    order = [F.col("doc_id"), F.col("piece")]
    rows = pieces.select(F.struct("*").alias("_row"), "doc_id", "piece", "length")
    rows = common.ranked(rows, "length", common.unit_hash(*order), order, "_rank", small_groups=True)
    placed = rows.select("_row", look_up("length", "_rank").alias("_at"))
    placed = placed.select("_row.*", "_at.sequence_id", "_at.offset")
    return placed if place is None else _numbered(cut_lineage(placed), place)


def _numbered(placed: DataFrame, place: str) -> DataFrame:
    """``placed`` with its sequences numbered from 0 in the order of the least ``place`` in each."""
    firsts = placed.groupBy("sequence_id").agg(F.min(place).alias("_first")).orderBy("_first", "sequence_id")
    firsts = cut_lineage(firsts.select("sequence_id", F.monotonically_increasing_id().alias("_id")))
    task = F.shiftright("_id", 33)  # the upper bits name the task, the lower ones count its rows
    counts = sorted((r["task"], r["count"]) for r in firsts.groupBy(task.alias("task")).count().collect())
    before = np.cumsum([0, *[n for _, n in counts]]).tolist()
    if not counts:
        return placed
    offsets = F.create_map(*[F.lit(x) for (k, _), n in zip(counts, before, strict=False) for x in (k, n)])
    number = (offsets[task] + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")
    columns = [F.col("_number").alias(c) if c == "sequence_id" else F.col(c) for c in placed.columns]
    return placed.join(firsts.select("sequence_id", number.alias("_number")), "sequence_id").select(*columns)
