"""Conversation repair, ranked search and the Jaccard join against brute force, and on rows with every oddity."""

import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import oracle
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversations, fingerprints, jaccard, language, packing, queries, search, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TURNS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string"


def cheapest(rows):
    """Of rows after damage (turn, role, text): the counts, the least of the cheapest audits and the repaired lines."""
    seen, faults = set(), []
    for _, role, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("b" if not found else "d" if (role, text) in seen else "" if found[-1] in ".!?" else "t")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    step = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    names = {"u": "user", "a": "assistant"}

    def inserted(ways):
        for _ in range(3):
            for s, (cost, audit, lines) in list(ways.items()):
                for n in "ua":
                    way = (cost + 2, audit + "I", (*lines, (names[n], "")))
                    if (s, n) in step and (n not in ways or way[:2] < ways[n][:2]):
                        ways[n] = way
        return ways

    ways = inserted({"0": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = collections.defaultdict(list)
        for s, (cost, audit, lines) in ways.items():
            after[s].append((cost + 3, audit + "D", lines))
            if fault in ("", "t"):
                late = int(fault == "t")
                if (s, role[:1]) in step:
                    after[step[s, role[:1]]].append((cost + late, audit + "K", (*lines, (role, text))))
                for n in "ua":
                    if (s, n) in step:
                        after[n].append((cost + 2 + late, audit + "R", (*lines, (names[n], text))))
        ways = inserted({s: min(w, key=lambda x: x[:2]) for s, w in after.items()})
    cost, audit, lines = min((ways[s] for s in ("0", "a") if s in ways), key=lambda x: x[:2])
    counts = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit)
    return counts, lines


def brute_repair(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        by_conv.setdefault(conv, []).extend([(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1))
    out = {}
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        counts, lines = cheapest(own)
        out[conv] = (*counts, hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest(), lines)
    return out


def odd_turns():
    rng = random.Random(5)
    rows = []
    for conv in range(250):
        for turn in range(rng.randrange(1, 14)):
            role = rng.choice(["user", "assistant", "system", "tool", None, "assistant", "user", ""])
            text = rng.choice(["a.", "b", "", " ", "hi!", None, "x. ", "ü? \n", "dup.", "日本"])
            rows.append((None if conv == 7 else conv, rng.choice([turn, turn, turn, turn + 1, None]), role, text))
    hot = [(9999, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", f"c {t}.", f"d {t}"])) for t in range(400)]
    return rows + hot + rows[:9]


@pytest.mark.parametrize("bits", [2, conversations.BLOCK_BITS])
def test_repair_of_odd_rows(spark, monkeypatch, bits):
    """Small blocks: a conversation lies in a hundred of them, and paths go on from block to block."""
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rows = odd_turns()
    df = conversations.damage(spark.createDataFrame(rows, TURNS).withColumn("live_", F.lit("clash")))
    want = brute_repair(rows)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.summaries(df, F.col("live")).collect()}
    assert got == {conv: w[:-1] for conv, w in want.items()}


def test_repaired_rows(spark):
    rows = odd_turns()
    lines = collections.defaultdict(list)
    for r in conversations.repaired(conversations.damage(spark.createDataFrame(rows, TURNS)), F.col("live")).collect():
        if r.edit != "D":
            lines[r.conv_id].append((r.place, r.role, r.text))
    for conv, want in brute_repair(rows).items():
        assert [(role, text) for _, role, text in sorted(lines[conv])] == list(want[-1])
        assert [place for place, _, _ in sorted(lines[conv])] == list(range(len(want[-1])))


def test_repair_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in queries.QUERIES["op12_conversation_repair"](spark, data).collect()}
    assert got == {conv: w[:-1] for conv, w in brute_repair(rows).items()}


def test_no_conversations(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversations.summaries(empty).count() == 0 and conversations.repaired(empty).count() == 0
    gone = spark.createDataFrame([(1, 1, "user", "x", False)], TURNS + ", live boolean")
    assert [tuple(r) for r in conversations.summaries(gone, F.col("live")).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_search_equals_sql(spark, data):
    con = oracle.connection(data)
    assert oracle.spark_rows(queries.QUERIES["op11_ranked_search"](spark, data)) == oracle.duck_rows(con, queries.SEARCH_SQL)


def brute_search(docs, items, top):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    counts = [(i, collections.Counter(terms(t))) for i, t in docs]
    n, length = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    out = []
    for item, text in items:
        scores = []
        for i, c in counts:
            score = 0
            for term in terms(text):
                df = sum(term in o for _, o in counts)
                if c[term]:
                    damping = 75 + 25 * c.total() * n // length
                    score += int(np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1)))) * (10**9 * c[term] // (1000 * c[term] + 12 * damping))
            if score:
                scores.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def test_search_of_odd_rows(spark, monkeypatch):
    docs = [(1, None), (2, ""), (3, "Äpfel, äpfel x_1 A"), (None, "a b"), (4, "a b"), (4, "a b"), (5, "b " * 5_000), (2**60 + 1, "a\x00b é")]
    docs += [(10 + k, "a tie here") for k in range(30)]
    items = [(1, "A b é"), (1, "tie Tie"), (None, "x 1"), (2, None), (3, "nothing here?"), (4, "Äpfel b b b")]
    df = spark.createDataFrame([(*d, 0) for d in docs], DOCS + ", rank int")
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in search.ranked(df, asked, 5).collect()), key=str)
    assert got == brute_search(docs, items, 5)
    monkeypatch.setattr(search, "ITEMS_PER_PASS", 2)
    monkeypatch.setattr(search, "EXACT", 1 << 36)  # weights take several rows, vocabularies several cuts
    monkeypatch.setattr(search, "TILE_ITEMS", 1)
    assert sorted((tuple(r) for r in search.ranked(df, asked, 5).collect()), key=str) == got
    assert search.ranked(df.limit(0), asked).count() == 0 and search.ranked(df, asked.limit(0)).count() == 0


def brute_links(rows):
    """(n_shingles, component) of each (id, text), ids distinct and not null."""
    sets = {}
    for i, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    least = {i: i for i in sets}
    linked = [(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    moved = True
    while moved:
        moved = False
        for i, j in linked:
            if least[i] != least[j]:
                moved = True
                least[i] = least[j] = min(least[i], least[j])
    return {i: (len(s), least[i]) for i, s in sets.items()}


def near_copies(seed, groups, copies, words, edits):
    rng = random.Random(seed)
    rows = []
    passage = [f"p{k}" for k in range(40)]
    for g in range(groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(words)] + passage * (g % 2)
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_shingles():
    rng = random.Random(2)
    for n in (0, 1, 4, 5, 6, 300):
        words = [rng.choice(["a", "B", "é", "ab", "x y"]) for _ in range(n)]
        low = [w.translate(LOWER) for w in words]
        want = len({tuple(low[k : k + 5]) for k in range(max(1, n - 4))}) if n else 0
        assert len(jaccard.shingles("\n\t ".join(words).encode())) == want
    assert jaccard.shingles(b" \t\n").size == 0


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{k % 701}" for k in range(5_000)).encode()
    whole = jaccard.shingles(text)
    monkeypatch.setattr(jaccard, "WORDS_AT_ONCE", 64)
    assert np.array_equal(jaccard.shingles(text), whole)


@pytest.mark.parametrize("cell", [4, 64])
def test_links_of_near_copies(spark, monkeypatch, cell):
    """Groups whose copies differ by up to six words: some are linked, many just fail; several requests and buckets."""
    monkeypatch.setattr(jaccard, "CELL_SETS", cell)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 2_000)
    monkeypatch.setattr(jaccard, "BUCKET_TOKENS", 5_000)
    rows = near_copies(cell, 4, 50, 110, 6) + near_copies(cell + 1, 12, 3, 60, 2)
    rows = [(i, text) for i, (_, text) in enumerate(rows)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == brute_links(rows)


def test_links_of_odd_rows(spark):
    long = " ".join(f"word{i % 9_773} is" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One\ttwo"), (6, "one two three"), (7, long), (8, long + " end"), (2**60 + 1, "x")]
    more = [(None, "one two"), (4, "one two"), (None, "no other"), (None, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows + more], DOCS + ", name string")
    got = jaccard.similar(df).collect()
    want = brute_links(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert sorted((r.n_shingles, str(r.component_id)) for r in got if r.doc_id is None) == [(0, "None"), (1, "4"), (1, "None")]
    assert len(got) == len(rows) + len(more)
    assert jaccard.similar(df.limit(0)).count() == 0


def test_two_million_blanks_are_encoded():
    from tokenizers import Tokenizer

    names = queries.byte_bpe()
    encode = packing.encoder(*names, packing.added_tokens(names[0]))
    text = "a" + " " * 2_000_000 + "b"
    want = Tokenizer.from_file(names[0]).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encode(text), "<u4").tolist() == want


def test_numerals_are_no_letters(spark):
    rows = [(1, "½ ² ①", "en"), (2, "Ⅷ", "en"), (3, "the house ½", "en"), (4, "das Haus Ⅷa", "de"), (5, "x²y", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(df, F.lit(False)).collect()}
    assert {i for i, (lang, _) in found.items() if lang == "und"} == {1, 2} and found[1] == ("und", 0.0)
    assert sorted(r.doc_id for r in language.accepted(df, F.lit(False)).collect()) == [3, 4, 5]


@pytest.mark.parametrize("doc_id", [7, None])
def test_repeated_rows_fill_all_shards(spark, doc_id):
    df = spark.createDataFrame([(doc_id, "the same text")] * 800 + [(k, f"text {k}") for k in range(80)], DOCS)
    sizes = collections.Counter()
    slots = collections.defaultdict(list)
    for r in sharding.kd_shards(df, shards=8).collect():
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 3 * 14
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_fingerprint_ranges_follow_the_rows(spark, monkeypatch):
    """A third of the rows without id, crowded ids and one far away: small ranges, and every row meets its next one."""
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", 10)
    rng = random.Random(6)
    ids = [*rng.sample(range(3000), 500), *range(10**6, 10**6 + 500), 2**60, -(2**40)]
    rows = [(i, f"text {n} {'ab' * rng.randrange(20)}") for n, i in enumerate(ids)]
    rows += [(None, f"no id {n} {'cd' * rng.randrange(20)}") for n in range(500)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    sizes = [r["count"] for r in fingerprints._ranged(docs).groupBy("_q", "_p").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 40 and len(sizes) > 75
    hashed = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashed[r[1]]))
    got = {(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in fingerprints.compare_with_next(docs).collect()}
    want = set()
    for n, (i, text) in enumerate(order):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + order[(n + 1) % len(order)][1][:cut]
        want.add((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert got == want


def test_answers_are_a_row_for_a_bucket_and_request_and_not_for_a_cell(spark):
    """60 sets in several requests and buckets; two sets of other requests share 9 of 10 tokens, the rest nothing."""
    mixed = jaccard._mix(np.arange(600, dtype=np.uint64) * jaccard.STEP).reshape(60, 10)
    mixed[59, :9] = mixed[0, :9]
    names = [f"{k:x}" for k in range(60)]
    frame = spark.createDataFrame([(n, t.view(np.int64).tolist()) for n, t in zip(names, mixed, strict=True)], "name string, tokens array<long>").coalesce(1)

    def read(batch):
        for name, tokens in zip(batch["name"], batch["tokens"], strict=True):
            yield name, np.asarray(tokens, np.int64).view(np.uint64)

    halves = [frame.where(F.conv("name", 16, 10).cast("int") < 30), frame.where(F.conv("name", 16, 10).cast("int") >= 30)]
    requests = jaccard._requests(halves[0].unionAll(halves[1]), 4, read)
    assert requests.count() > 2 and jaccard._answers(requests).count() <= requests.count()
    assert sorted(r["name"] for r in jaccard._open(requests, 80).collect()) == ["0", "3b"]
    assert jaccard._open(requests, 91).count() == 0


def test_a_bucket_of_the_matrix_is_never_sorted_as_a_whole():
    rng = np.random.default_rng(3)
    cells, per_cell, n = 200, 5_000, 1_000_000
    tokens = rng.integers(0, 400_000, n, dtype=np.uint32)
    groups = np.arange(cells, dtype=np.int64) // 2
    several = np.unique(rng.integers(0, 400_000, 1_000, dtype=np.uint32))
    where = collections.defaultdict(set)
    for k, token in enumerate(tokens.tolist()):
        where[token].add(k // per_cell // 2)
    known = set(several.tolist())
    want = np.zeros(cells, np.int64)
    for k, token in enumerate(tokens.tolist()):
        want[k // per_cell] += len(where[token]) > 1 or token in known
    whole = tokens.reshape(10, -1)
    batch = [
        (0, r, np.arange(20, dtype=np.uint32).tobytes(), groups[20 * r :][:20].tobytes(), np.full(20, per_cell, np.uint32).tobytes(),
         whole[r].tobytes(), several.tobytes() if r == 4 else b"", None)
        for r in range(10)
    ]
    frame = pd.DataFrame(batch, columns=[c.split()[0] for c in jaccard.REQUEST.split(", ")])
    tracemalloc.start()
    answers = jaccard._counted(frame)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = np.zeros(cells, np.int64)
    for r in answers.itertuples():
        got[20 * r.request + np.frombuffer(r.cells, np.uint32)] = np.frombuffer(r.shared, np.int64)
    assert got.tolist() == want.tolist()
    assert peak < 40 * n  # bytes; the whole bucket sorted at once took 61 a token
