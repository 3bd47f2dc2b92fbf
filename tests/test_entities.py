import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import entities as en

NAMES = ["acme", "acme corp", "big blue box", "blue"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def brute(text, names):
    words = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[\w']+", text.lower())]
    found = []
    for i in range(len(words)):
        for n in range(1, 4):
            if i + n <= len(words):
                name = " ".join(w for w, _, _ in words[i : i + n])
                if name in names:
                    found.append((name, words[i][1], words[i + n - 1][2]))
    return found


def texts(n=60):
    rng = random.Random(3)
    vocabulary = ["acme", "Corp", "big", "blue", "box", "x", "the", "acme's"]
    gaps = [" ", ", ", ".\n", "  - "]
    return ["".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.randint(0, 25))) for _ in range(n)] + ["", " ... "]


def test_mentions_orgs_and_spans_equal_brute_force(spark):
    all_texts = texts()
    df = frame(spark, all_texts)
    cols = [en.mentions(F.col("text"), NAMES).alias("m"), en.orgs(F.col("text"), NAMES).alias("o")]
    got = {r["id"]: r for r in df.select("id", *cols).collect()}
    spans = df.select("id", F.inline(en.entity_spans(F.col("text"), NAMES))).collect()
    for i, text in enumerate(all_texts):
        want = brute(text, NAMES)
        assert got[i]["m"] == [w[0] for w in want]
        assert got[i]["o"] == list(dict.fromkeys(w[0] for w in want))
        assert sorted((r["text"], r["start"], r["end"]) for r in spans if r["id"] == i) == sorted(want)


def test_spans_of_single_words(spark):
    df = frame(spark, ["Thing, nothing\nTHING", "none"])
    rows = df.select("id", F.inline(en.entity_spans(F.col("text")))).collect()
    assert [tuple(r) for r in rows] == [(0, "thing", "ORG", 0, 5), (0, "thing", "ORG", 15, 20)]


def test_docs_with_orgs_leaves_out_the_others(spark):
    rows = en.docs_with_orgs(frame(spark, ["x", "a thing", ""]), "id", F.col("text")).collect()
    assert [(r["id"], r["orgs"]) for r in rows] == [(1, ["thing"])]


def test_table_gazetteer_equals_list(spark):
    df = frame(spark, texts())
    table = spark.createDataFrame([(n,) for n in NAMES + NAMES], "org string")
    joined = {tuple(r) for r in en.match_table(df, "id", F.col("text"), table).collect()}
    listed = df.select("id", F.explode(en.orgs(F.col("text"), NAMES)))
    assert joined == {tuple(r) for r in listed.collect()}


def test_case_kept_on_request(spark):
    df = frame(spark, ["Acme acme"])
    assert df.select(en.mentions(F.col("text"), ["acme"], lowercase=False)).first()[0] == ["acme"]


def test_own_extractor(spark):
    def load():
        return lambda batch: [[w for w in t.split() if w.startswith("x")] for t in batch]

    rows = en.extract_with_model(frame(spark, ["X1 y x1 X2", "y"]), "id", "text", load, batch_size=1).collect()
    assert sorted((r["id"], r["orgs"]) for r in rows) == [(0, ["x1", "x2"]), (1, [])]


def test_refined_names(spark):
    found = spark.createDataFrame([("acme corp",), ("other",), ("acme corp",)], "org string")
    assert {r["org"] for r in en.refine_orgs(found, ["acme"]).collect()} == {"acme"}


def test_empty_input_gives_empty_union(spark):
    assert en.distinct_orgs(frame(spark, []), F.col("text")).count() == 0


def test_names_of_many_words(spark):
    names = ["new york", "bank of new york", "the bank of new york mellon"]
    df = spark.createDataFrame([(1, "the bank of new york fell"), (2, "the bank of new york mellon"), (3, "york new")], "id int, text string")
    table = spark.createDataFrame([(n,) for n in names], "org string")
    want = {(1, names[0]), (1, names[1]), (2, names[0]), (2, names[1]), (2, names[2])}
    assert {tuple(r) for r in en.match_table(df, "id", F.col("text"), table).collect()} == want
    listed = df.select("id", F.explode(en.orgs(F.col("text"), names)).alias("org"))
    assert {tuple(r) for r in listed.collect()} == want


def test_ngrams_are_in_reading_order(spark):
    df = spark.createDataFrame([("a b c",), ("",)], "text string")
    got = [r[0] for r in df.select(en.ngrams(F.expr("filter(split(text, ' '), x -> x <> '')"), 3)).collect()]
    assert got == [["a", "a b", "a b c", "b", "b c", "c"], []]


def brute_hits(text, names):
    spans = [m.span() for m in re.finditer(r"(?:[^\W_]|')+", text.lower())]
    words = [text.lower()[a:b] for a, b in spans]
    runs = [(i, j) for i in range(len(words)) for j in range(i, len(words)) if " ".join(words[i : j + 1]) in names]
    return sorted((" ".join(words[i : j + 1]), spans[i][0], spans[j][1]) for i, j in runs)


@pytest.mark.parametrize("held", [0, 1_000])
def test_overlapping_names_of_any_width(spark, held):
    names = {"a", "a b", "b", "b c d", "a b c d e f g", "c", "d a", "über b", "it's"}
    texts = ["A b, c d e F g a", "über b\nc; it's d_a", "b b b c d", "", None, "x " * 500 + "a b", "ab"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, "a")], "id long, text string")
    table = spark.createDataFrame([(n,) for n in [*names, "a", "", None]], "org string")
    got = sorted(tuple(r) for r in en.find_names(df.where("id IS NOT NULL"), "id", F.col("text"), table, held).collect())
    assert got == sorted((i, *hit) for i, text in enumerate(texts) if text for hit in brute_hits(text, names))
    assert [r["org"] for r in en.find_names(df.where("id IS NULL"), "id", F.col("text"), table, held).collect()] == ["a"]
    assert en.find_names(df, "id", F.col("text"), table.limit(0), held).count() == 0


def test_trie_is_linear_in_a_wide_name():
    trie = en.NameTrie([" ".join("ab"[k % 2] for k in range(n)) for n in (1, 2, 400)])
    words = ["a", "b"] * 5_000
    assert sum(1 for i, j in trie.hits(words) if i == j) == 5_000
    assert sum(1 for i, j in trie.hits(words) if j - i == 399) == (10_000 - 400) // 2 + 1


def test_walked_names_equal_sifted_names(spark):
    names = ["acme", "acme corp", "big blue box", "blue", "acme corp big blue box the", "x x", "the"]
    df = frame(spark, [*texts(), "the " + "x , x " * 3_000 + "acme corp"])
    table = spark.createDataFrame([(n,) for n in names], "org string")
    found = sorted(tuple(r) for r in en.find_names(df, "id", F.col("text"), table).collect())
    assert found == sorted(tuple(r) for r in en.walk_names(df, "id", F.col("text"), names).collect()) and len(found) > 6_000
