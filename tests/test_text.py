"""Hand rows and brute force for the text functions."""

import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import text as tx

CLEAN = [
    ("hi @bob @ https://x.y http", "hi @user @ http http"),
    ("httpd is up", "http is up"),
    ("a  b ", "a  b "),
    ("one\ntwo", "onetwo"),
    ("see\nhttp://x", "seehttp://x"),
    ("http://x\ntail end", "http end"),
    ("a\tb\rc", "ab\rc"),
    ("ok\U0001f600!", "ok!"),
    ("x中y가z", "xyz"),
    ("é ñ а • –", "é ñ а • –"),
    ("a‍b⌚c⏏d⏩e", "abcde"),
    ("@@ @a@b x@c", "@user @user x@c"),
    ("@http x", "@user x"),
    ("", ""),
    (None, None),
]


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in sorted(df.select("i", function(F.col("v"))).collect())]


def test_clean_hand_rows(spark):
    assert apply(spark, tx.clean_text, [a for a, _ in CLEAN]) == [b for _, b in CLEAN]


def test_other_strips(spark):
    assert apply(spark, tx.strip_wide, ["ñéöß"]) == ["éß"]
    assert apply(spark, tx.strip_profile_prefix, ["https://twitter.com/ann"]) == ["ann"]


def test_filters(spark):
    words = ["abc", "abc123", "n't", "'s", "1st", "été"]
    assert apply(spark, tx.starts_with_letter, words) == [True, True, True, False, False, False]
    assert apply(spark, tx.is_ascii_word, ["abc", "abc123", "don't", ""]) == [True, False, False, False]
    assert apply(spark, tx.ascii_letters_or_empty, ["abc", "a1", ""]) == [True, False, True]


def test_sentences(spark):
    assert [len(s) for s in apply(spark, tx.sentences, ["Hi there! Ok. ", "...", "a. \n. b", ""])] == [2, 0, 2, 0]


def by_hand(text):
    out = []
    for t in text.split(" "):
        if t[:1] == "@" and len(t) > 1:
            t = "@user"
        elif t[:4] == "http":
            t = "http"
        out.append(t)
    kept = [c for c in " ".join(out) if c not in "\n\t" and not (ord(c) in (0x200D, 0x231A, 0x23CF, 0x23E9) or ord(c) >= 0x24C2)]
    return "".join(kept)


ALPHABET = st.sampled_from(list("ab'@ .!?\n\t\r1é") + ["http", "@x", "‍", "Ⓛ", "Ⓜ", "中", "\U0001f600", "ß", "İ"])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=14).map("".join), min_size=1, max_size=25))
def test_clean_tokens_pieces_equal_brute_force(spark, texts):
    assert apply(spark, tx.clean_text, texts) == [by_hand(t) for t in texts]
    plain = [t.replace("İ", "i") for t in texts]
    split = [[w for w in re.split(r"[^\w']+|_", t.lower()) if w] for t in plain]
    assert apply(spark, tx.tokens, plain) == split
    assert ["".join(p) for p in apply(spark, tx.pieces, plain)] == [t.lower() for t in plain]


@pytest.mark.parametrize("word,text,found", [("thing", "a thing.", True), ("thing", "nothing", False), ("a.b", "x a.b y", True), ("a.b", "x acb y", False)])
def test_whole_word(spark, word, text, found):
    assert apply(spark, lambda c: c.rlike(tx.whole_word([word])), [text]) == [found]
