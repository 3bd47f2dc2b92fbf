"""Links between texts with similar sets of word shingles, found by a token-group matrix.

Similar sets are put into groups, and for every token it is known in which groups it occurs. A set that is linked to one
of another group has at least ``need`` of its tokens there: a set (or a whole group) with fewer tokens in any other group
is closed, and of two groups only those are opened whose token union holds enough of a set's tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.near_dedup import components
from tidemark.session import cut_lineage

SHINGLE, PERCENT = 5, 80
KEYS = 6  # finer group keys of a set
WORDS_AT_ONCE = 1 << 16
BLOCK_TOKENS = 1 << 20  # tokens of the sets that one request of the matrix holds
BUCKET_TOKENS = 1 << 22  # tokens of the matrix that one task holds
SLICE_TOKENS = 1 << 18  # of these, so many are sorted at once
OWNER = np.uint64(20)
CELL_SETS, CELL_TOKENS = 64, 1 << 16
BITMAP = 1 << 27  # bits, 16 MiB

STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit words (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * STEP)
TURNS = _mix(np.arange(1000, 1000 + 2 * KEYS, dtype=np.uint64) * STEP) | np.uint64(1)


class _Powers:
    """Powers of the base and of its inverse, as many as have been asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


POWERS = _Powers()


def shingles(raw: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``size`` words; a shorter text is one run, a blank one has none.

    Words are cut at blanks and U+0009..U+000D, A-Z is lower-cased. The hash is that of the words joined by one blank,
    from sums over its bytes, so a text takes a few passes over arrays. Long texts are read in parts.
    """
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    text = np.frombuffer(b" ".join(words), np.uint8)
    cuts = np.flatnonzero(text == 32)
    begin = np.concatenate([[0], cuts + 1])
    end = np.concatenate([cuts, [len(text)]])
    size = min(size, len(words))
    found = []
    for first in range(0, len(words) - size + 1, WORDS_AT_ONCE):
        s = begin[first : min(first + WORDS_AT_ONCE, len(words) - size + 1)]
        e = end[first + size - 1 :][: len(s)]
        part = text[s[0] : e[-1]]
        POWERS.reach(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(BYTE[part] * POWERS.up[: len(part)], out=sums[1:])
        found.append(np.unique(_mix((sums[e - s[0]] - sums[s - s[0]]) * POWERS.down[s - s[0]])))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def set_name(tokens: np.ndarray) -> str:
    """128 bits that tell a set; empty for the empty set."""
    return xxhash.xxh3_128_hexdigest(tokens.tobytes()) if len(tokens) else ""


def group_keys(tokens: np.ndarray) -> np.ndarray:
    """The least token in a random order, which the sets of a cell have in common, and KEYS finer ones, each of two orders."""
    least = (tokens[:, None] * TURNS).min(axis=0)
    return np.concatenate([least[:1], _mix(least[0::2] ^ _mix(least[1::2]))]).view(np.int64)


def _need(n: Column, percent: int) -> Column:
    """Tokens that a set of ``n`` shares at least with any set it is linked to."""
    return F.ceil(n * percent / 100).cast("long")


# The matrix in packed form. A cell is a group inside one request; requests go to buckets of tokens.
REQUEST = "bucket long, request long, cells binary, groups binary, counts binary, tokens binary, several binary, names string"


def _packed(request: int, members: list[tuple[str, np.ndarray]], buckets: int) -> Iterator[tuple]:
    """Rows that ask, bucket by bucket, for the tokens of the given sets, each token once for a group.

    What two groups of the request share is counted here and only sent as a token that several groups have.
    """
    names = list(dict.fromkeys(name for name, _ in members))
    number = {name: k for k, name in enumerate(names)}
    own = np.repeat(np.array([number[name] for name, _ in members], np.uint64), [len(t) for _, t in members])
    keys = np.unique(np.concatenate([t for _, t in members]) >> OWNER << OWNER | own)
    token, cell = keys >> OWNER, (keys & np.uint64((1 << 20) - 1)).astype(np.int64)
    first = np.concatenate([[True], token[1:] != token[:-1]])
    starts = np.flatnonzero(first)
    many = np.diff(np.append(starts, len(token))) > 1
    inside = np.repeat(many, np.diff(np.append(starts, len(token))))
    local = np.bincount(cell[inside], minlength=len(names)).astype(np.int64)
    least = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(least, [number[name] for name, _ in members], [len(t) for _, t in members])
    yield -request - 1, request, None, least.tobytes(), local.tobytes(), None, None, "\n".join(names)
    group = np.array([xxhash.xxh3_64_intdigest(name) for name in names], np.uint64).view(np.int64)
    single = ~inside
    parts = [(token[single], cell[single]), (token[starts[many]], None)]
    dealt = []
    for tokens, cells in parts:
        bucket = (tokens % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket if cells is None else bucket << 20 | cells, kind="stable")
        short = (tokens // np.uint64(buckets)).astype(np.uint32)[order]
        dealt.append((bucket[order], short, None if cells is None else cells[order]))
    (b, short, cells), (bm, several, _) = dealt
    for bucket in np.unique(np.concatenate([b, bm])).tolist():
        lo, hi = np.searchsorted(b, [bucket, bucket + 1])
        here, counts = np.unique(cells[lo:hi], return_counts=True)
        ml, mh = np.searchsorted(bm, [bucket, bucket + 1])
        yield (
            bucket, request, here.astype(np.uint32).tobytes(), group[here].tobytes(), counts.astype(np.uint32).tobytes(),
            short[lo:hi].tobytes(), several[ml:mh].tobytes(), None,
        )


def _requests(rows: DataFrame, buckets: int, read: Callable[[pd.DataFrame], Iterator[tuple[str, np.ndarray]]]) -> DataFrame:
    """Packed requests of all sets that ``read`` takes from ``rows``, which have to come in the same order again if read anew."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        request = TaskContext.get().partitionId() << 20
        columns = [c.split()[0] for c in REQUEST.split(", ")]
        held: list[tuple[str, np.ndarray]] = []
        tokens = 0
        for batch in batches:
            for name, own in read(batch):
                held.append((name, own))
                tokens += len(own)
                if tokens >= BLOCK_TOKENS or len(held) == 1 << 20:
                    yield pd.DataFrame(list(_packed(request, held, buckets)), columns=columns)
                    held, tokens, request = [], 0, request + 1
        if held:
            yield pd.DataFrame(list(_packed(request, held, buckets)), columns=columns)

    return rows.mapInPandas(ask, REQUEST)


def _shared(token: np.ndarray, owner: np.ndarray, group: np.ndarray, several: np.ndarray) -> np.ndarray:
    """How many tokens of each owner also another group has, or are in ``several`` (sorted).

    Tokens are compared residue by residue, about SLICE_TOKENS at a time, so the sorted copy of a bucket never exists.
    """
    shared = np.zeros(len(group), np.int64)
    slices = np.uint32(-(-len(token) // SLICE_TOKENS))
    for part in range(slices):
        here = np.flatnonzero(token % slices == part)
        if not len(here):
            continue
        keys = token[here].astype(np.uint64) << np.uint64(32) | owner[here]
        keys.sort()
        own = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        keys >>= np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        by = group[own]
        differ = np.minimum.reduceat(by, starts) != np.maximum.reduceat(by, starts)
        differ |= np.isin(keys[starts], several)
        shared += np.bincount(own[np.repeat(differ, np.diff(np.append(starts, len(keys))))], minlength=len(group))
    return shared


ANSWER = "request long, cells binary, shared binary, least binary, names string"


def _counted(batch: pd.DataFrame) -> pd.DataFrame:
    """Answers of one bucket to all its requests."""
    columns = [c.split()[0] for c in ANSWER.split(", ")]
    if batch["bucket"].iloc[0] < 0:
        row = batch.iloc[0]
        return pd.DataFrame([(row["request"], None, row["counts"], row["groups"], row["names"])], columns=columns)
    cells = [np.frombuffer(c, np.uint32) for c in batch["cells"]]
    ends = np.cumsum([0, *map(len, cells)])
    group = np.concatenate([np.frombuffer(g, np.int64) for g in batch["groups"]])
    token = np.concatenate([np.frombuffer(t, np.uint32) for t in batch["tokens"]])
    counts = np.concatenate([np.frombuffer(c, np.uint32) for c in batch["counts"]])
    several = np.unique(np.concatenate([np.frombuffer(s, np.uint32) for s in batch["several"]]))
    requests = batch["request"].tolist()
    del batch
    if not len(token):
        return pd.DataFrame([], columns=columns)
    shared = _shared(token, np.repeat(np.arange(len(group), dtype=np.uint32), counts), group, several)
    found = []
    for request, own, lo, hi in zip(requests, cells, ends[:-1], ends[1:], strict=True):
        some = shared[lo:hi] > 0
        if some.any():
            found.append((request, own[some].tobytes(), shared[lo:hi][some].tobytes(), None, None))
    return pd.DataFrame(found, columns=columns)


def _answers(requests: DataFrame) -> DataFrame:
    """What each bucket answers to each request, a row for every request with tokens that other groups have as well.

    ``cells`` are the numbers of the cells in the request and ``shared`` how many such tokens each has. A request's own
    row comes with them, with all its cells.
    """
    return requests.groupBy("bucket").applyInPandas(_counted, ANSWER)


def _open(requests: DataFrame, percent: int) -> DataFrame:
    """(name): groups that may be linked to another group, as other groups have enough of their tokens."""

    def added(batch: pd.DataFrame) -> pd.DataFrame:
        own = batch[batch["names"].notna()].iloc[0]
        shared, least = np.frombuffer(own["shared"], np.int64).copy(), np.frombuffer(own["least"], np.int64)
        for row in batch[batch["names"].isna()].itertuples():
            shared[np.frombuffer(row.cells, np.uint32)] += np.frombuffer(row.shared, np.int64)
        enough = shared >= -(-least * percent // 100)
        return pd.DataFrame({"name": np.array(own["names"].split("\n"), object)[enough]})

    return _answers(requests).groupBy("request").applyInPandas(added, "name string").distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the ``pairs`` (a, b) of sets that are linked, by their whole sets."""
    a = sets.select(F.col("id").alias("a"), F.col("n").alias("an"), F.col("tokens").alias("at"))
    b = sets.select(F.col("id").alias("b"), F.col("n").alias("bn"), F.col("tokens").alias("bt"))
    both = F.size(F.array_intersect("at", "bt")).cast("long")
    joined = pairs.join(a, "a").join(b, "b").withColumn("both", both)
    return joined.where(100 * F.col("both") >= percent * (F.col("an") + F.col("bn") - F.col("both"))).select("a", "b")


def _pair(one: str, other: str) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _leaders(sets: DataFrame) -> DataFrame:
    """(a, b): each set with the first and the last set that has a group key in common, so a pair or two for a key."""
    keyed = sets.select("id", F.posexplode("keys").alias("turn", "key"))
    ends = keyed.groupBy("turn", "key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    found = keyed.join(ends, ["turn", "key"]).select("id", F.explode(F.array("low", "high")).alias("other")).where("id <> other")
    return found.select(*_pair("id", "other")).distinct()


def _across(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between sets of different roots, at least one for any two roots. ``sets`` has id, root, n, keys, tokens.

    Tokens that only one root has come first in every set, then those of few sets. Two linked sets have a token in common
    among the first of the larger and the first of the smaller one. Similar sets (one group key) are dealt into cells of
    about CELL_SETS, and these tokens lead from cell to cell, so near copies meet block by block and not pair by pair.
    """
    tokens = sets.select("id", "root", F.col("n").cast("int").alias("n"), F.element_at("keys", 1).alias("key"), F.explode("tokens").alias("token"))
    columns = tokens.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").cast("int").alias("sets"))
    shared = tokens.join(columns.where("low <> high").select("token", "sets"), "token")
    ordered = shared.groupBy("id", "root", "n", "key").agg(F.array_sort(F.collect_list(F.struct("sets", "token"))).alias("tokens"))
    ordered = ordered.withColumn("tokens", F.transform("tokens", lambda s: s["token"])).withColumn("n", F.col("n").cast("long"))
    need = _need(F.col("n"), percent)
    ordered = ordered.where(F.size("tokens") >= need)
    full = F.greatest(F.ceil(F.count("*") / CELL_SETS), F.ceil(F.sum(F.size("tokens")) / CELL_TOKENS))
    dealt = ordered.join(ordered.groupBy("key").agg(full.alias("cells")), "key")
    dealt = dealt.withColumn("cell", F.xxhash64("key", F.pmod(F.xxhash64("id"), F.col("cells"))))
    ordered = cut_lineage(dealt.select("id", "root", "cell", "n", "tokens"))
    even = F.ceil(F.col("n") * 2 * percent / (100 + percent)).cast("long")  # tokens shared with a set of equal size

    def first(least: Column, side: str) -> DataFrame:
        alone = F.col("n") - F.size("tokens")  # these come before all tokens that are left
        taken = F.explode(F.slice("tokens", 1, F.greatest(F.col("n") - least + 1 - alone, F.lit(0)).cast("int"))).alias("token")
        rows = ordered.select("root", F.col("cell").alias(side), "n", taken).groupBy("token", side)
        named = {"least": F.min("n"), "most": F.max("n"), "low": F.min("root"), "high": F.max("root")}
        return rows.agg(*[c.alias(f"{side}_{k}") for k, c in named.items()])

    x, y = first(need, "x"), first(even, "y")
    sizes = (F.col("x_most") >= F.col("y_least")) & (100 * F.col("y_most") >= percent * F.col("x_least"))
    one_root = (F.col("x_low") == F.col("x_high")) & (F.col("y_low") == F.col("y_high")) & (F.col("x_low") == F.col("y_low"))
    found = x.join(y, "token").where(sizes & ~one_root).select(*_pair("x", "y")).distinct()
    fields = {"id": "array<long>", "root": "array<long>", "n": "array<long>", "length": "array<int>", "tokens": "array<long>"}
    rows = ordered.select("cell", F.struct("id", "root", "n", F.size("tokens").alias("length"), "tokens").alias("set"))
    blocks = rows.groupBy("cell").agg(F.collect_list("set").alias("sets"))
    blocks = blocks.select("cell", *[(F.flatten if k == "tokens" else (lambda c: c))(F.col(f"sets.{k}")).alias(k) for k in fields])
    joined = found
    for side in "ab":
        named = blocks.select(F.col("cell").alias(side), *[F.col(k).alias(f"{side}_{k}") for k in fields])
        joined = joined.join(named, side)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            links = [link for row in batch.to_dict("records") for link in _opened(*[[row[f"{s}_{k}"] for k in fields] for s in "ab"], percent)]
            if links:
                yield pd.DataFrame(links, columns=["a", "b"])

    return joined.drop("a", "b").mapInPandas(compare, "a long, b long").distinct()


def _opened(x: list[np.ndarray], y: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A link for any two roots of two cells that have one. Each cell is (ids, roots, sizes, lengths, tokens).

    A set is only compared if the union of the other cell holds as many of its tokens as a link to the smallest set
    there takes; then all remaining sets are compared at once, by the product of their incidence matrices.
    """
    union = np.intersect1d(x[4], y[4])
    sides = []
    for (ids, roots, sizes, lengths, tokens), other in ((x, y), (y, x)):
        place = np.minimum(np.searchsorted(union, tokens), max(len(union) - 1, 0))
        inside = union[place] == tokens if len(union) else np.zeros(len(tokens), bool)
        owner = np.repeat(np.arange(len(ids)), lengths)
        least = np.maximum(other[2].min(), -(-sizes * percent // 100))
        open_ = np.bincount(owner[inside], minlength=len(ids)) * (100 + percent) >= percent * (sizes + least)
        kept = inside & open_[owner]
        matrix = np.zeros((int(open_.sum()), len(union)), np.float32)
        matrix[(np.cumsum(open_) - 1)[owner[kept]], place[kept]] = 1
        sides.append((ids[open_], roots[open_], sizes[open_], matrix))
    (ia, ra, na, a), (ib, rb, nb, b) = sides
    if not len(ia) or not len(ib):
        return []
    both = (a @ b.T).astype(np.int64)
    i, j = np.nonzero((100 * both >= percent * (na[:, None] + nb[None, :] - both)) & (ra[:, None] != rb[None, :]))
    pairs = np.stack([np.minimum(ra[i], rb[j]), np.maximum(ra[i], rb[j])], axis=1)
    first = np.unique(pairs, axis=0, return_index=True)[1]
    return [(min(p, q), max(p, q)) for p, q in zip(ia[i[first]].tolist(), ib[j[first]].tolist(), strict=True)]


def _bitmap(names: DataFrame) -> np.ndarray:
    """Bits that are set for all ``names``: sixteen a name, and never more than BITMAP, however many names there are."""
    bits = max(64, min(BITMAP, 1 << (16 * names.count()).bit_length()))
    place = F.conv(F.substring("name", 1, 15), 16, 10).cast("long") % bits
    words = names.select(F.shiftright(place, 6).cast("int").alias("word"), F.expr("1L").alias("one"), (place % 64).cast("int").alias("bit"))
    set_bits = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits"))
    found = np.zeros(bits // 64, np.int64)
    for row in set_bits.toLocalIterator():
        found[row["word"]] = row["bits"]
    return found.view(np.uint64)


def similar(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per document.

    Two documents are linked when 100 * intersection >= ``percent`` * union of their sets of ``size``-word shingles
    (see :func:`shingles`). component_id is the smallest doc_id reachable over links. Null and blank texts have no
    shingle and are linked with nothing. Rows without id take part and are never the smallest unless their component
    has no other; repeated rows are linked as equal texts. Empty tables give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(raw or b"", size) for raw in batch.pop("text")]
            yield batch.assign(n=[len(s) for s in sets], name=[set_name(s) for s in sets])

    listed = rows.mapInPandas(describe, "doc_id string, n long, name string")
    listed = cut_lineage(listed.withColumn("doc_id", F.col("doc_id").cast("long")))
    total = listed.agg(F.sum("n")).first()[0] or 0

    def own(batch: pd.DataFrame) -> Iterator[tuple[str, np.ndarray]]:
        for raw in batch["text"]:
            if len(tokens := shingles(raw or b"", size)):
                yield set_name(tokens), tokens

    active = cut_lineage(_open(_requests(rows.select("text"), -(-total // BUCKET_TOKENS) or 1, own), percent))
    marked = _bitmap(active)

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[str] = set()  # a task sends one of its copies
        for batch in batches:
            found = []
            for raw in batch["text"]:
                tokens = shingles(raw or b"", size)
                if (name := set_name(tokens)) and name not in seen:
                    at = int(name[:15], 16) % (64 * len(marked))
                    if int(marked[at >> 6]) >> (at & 63) & 1:
                        seen.add(name)
                        found.append((name, len(tokens), group_keys(tokens), tokens.view(np.int64)))
            if found:
                yield pd.DataFrame(found, columns=["name", "n", "keys", "tokens"])

    taken = rows.select("text").mapInPandas(take, "name string, n long, keys array<long>, tokens array<long>")
    sets = taken.join(active, "name", "left_semi").dropDuplicates(["name"])
    sets = cut_lineage(sets.withColumn("id", F.monotonically_increasing_id()))
    links = cut_lineage(_linked(_leaders(sets), sets, percent))
    grouped = _rooted(sets.select("id", "n", "keys", "tokens"), links).sortWithinPartitions("id")  # in one order, however often it is read
    total = sets.agg(F.sum("n")).first()[0] or 0

    def held(batch: pd.DataFrame) -> Iterator[tuple[str, np.ndarray]]:
        for root, tokens in zip(batch["root"], batch["tokens"], strict=True):
            yield f"{root:x}", np.asarray(tokens, np.int64).view(np.uint64)

    still = _open(_requests(grouped.select("root", "tokens"), -(-total // BUCKET_TOKENS) or 1, held), percent)
    still = still.select(F.conv("name", 16, 10).cast("long").alias("root"))
    links = cut_lineage(links.unionAll(_across(grouped.join(still, "root", "left_semi"), percent)))
    classes = listed.where("n > 0").groupBy("name").agg(F.min("doc_id").alias("least"))
    named = cut_lineage(classes.join(_rooted(sets.select("name", "id"), links).drop("id"), "name", "left"))
    least = named.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("first"))
    by_name = named.join(least, "root", "left").select("name", F.coalesce("first", "least").alias("component_id"))
    alone = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return listed.join(by_name, "name", "left").select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))


def _rooted(sets: DataFrame, links: DataFrame) -> DataFrame:
    """``sets`` with root: the smallest id that links reach."""
    roots = components(links)
    return sets.join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id")).drop("node")
