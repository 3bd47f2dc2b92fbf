"""Pieces of DuckDB SQL shared by the check queries. They follow the definitions, not the Spark code."""

from __future__ import annotations

from collections.abc import Iterable

from tidemark.functions import text as tx
from tidemark.operators import entities as en, sentiment as st, words as wd


def names(items: Iterable[str]) -> str:
    return ", ".join(f"'{i}'" for i in items)


def clean(x: str) -> str:
    masked = (
        f"array_to_string(list_transform(string_split({x}, ' '), lambda t: CASE "
        "WHEN starts_with(t, '@') AND length(t) > 1 THEN '@user' WHEN starts_with(t, 'http') THEN 'http' ELSE t END), ' ')"
    )
    return rf"regexp_replace(regexp_replace({masked}, '[{tx.SYMBOL_CLASS}]', '', 'g'), '[\n\t]', '', 'g')"


def tokens(x: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}\p{{N}}'']+'), lambda t: t <> '')"


#: (doc_id, lang, source, word): one row per counted word.
DOC_WORDS = f"""
SELECT * FROM (
  SELECT doc_id, lang, source, unnest({tokens(clean('text'))}) AS word FROM documents
) WHERE regexp_matches(word, '^[a-zA-Z]') AND word NOT IN ({names(wd.STOP_WORDS)})"""

WORD_COUNT = f"SELECT word, count(*) AS count FROM ({DOC_WORDS}) GROUP BY word"

TAG = """CASE WHEN regexp_matches(word, '(tion|ness|ment|ity)$') THEN 'N'
  WHEN regexp_matches(word, '(ing|ed)$') THEN 'V' ELSE 'X' END"""

#: (doc_id, source, word, pos): noun and verb tokens in ASCII letters.
KEPT_TOKENS = f"""
SELECT doc_id, source, word, pos FROM (
  SELECT doc_id, source, unnest(toks) AS word, unnest(range(1, len(toks) + 1)) AS pos
  FROM (SELECT doc_id, source, {tokens('text')} AS toks FROM documents)
) WHERE regexp_matches(word, '^[a-zA-Z]*$') AND word NOT IN ({names(wd.STOP_WORDS)}) AND {TAG} IN ('N', 'V')"""


def hits(toks: str, words: Iterable[str]) -> str:
    return f"len(list_filter({toks}, lambda t: t IN ({names(words)})))::DOUBLE"


DOCUMENTS = "SELECT doc_id, text FROM documents"


def scores(texts: str) -> str:
    """Sentiment scores of (doc_id, text)."""
    return f"""
SELECT doc_id, exp(n - m) / (exp(n - m) + exp(1.0 - m) + exp(p - m)) AS negative,
  exp(1.0 - m) / (exp(n - m) + exp(1.0 - m) + exp(p - m)) AS neutral,
  exp(p - m) / (exp(n - m) + exp(1.0 - m) + exp(p - m)) AS positive
FROM (
  SELECT doc_id, n, p, greatest(n, 1.0, p) AS m FROM (
    SELECT doc_id, {hits('toks', st.NEGATIVE)} AS n, {hits('toks', st.POSITIVE)} AS p
    FROM (SELECT doc_id, {tokens(clean('text'))} AS toks FROM ({texts}))))"""


def mentions(texts: str) -> str:
    """(doc_id, org): every mention in (doc_id, text)."""
    return f"""
SELECT * FROM (SELECT doc_id, unnest({tokens('text')}) AS org FROM ({texts}))
WHERE org IN ({names(en.ORGANISATIONS)})"""


def pairs(texts: str) -> str:
    """(doc_id, company, negative, neutral, positive): one row per text and organisation."""
    return f"""
SELECT s.doc_id, o.org AS company, s.negative, s.neutral, s.positive
FROM ({scores(texts)}) s JOIN (SELECT DISTINCT doc_id, org FROM ({mentions(texts)})) o ON s.doc_id = o.doc_id"""


SCORES, MENTIONS, PAIRS = scores(DOCUMENTS), mentions(DOCUMENTS), pairs(DOCUMENTS)

EMOTION_COUNTS = (
    "SELECT doc_id, "
    + ", ".join(f"{hits('toks', ws)} AS {e}" for e, ws in st.EMOTIONS.items())
    + f" FROM (SELECT doc_id, {tokens(clean('text'))} AS toks FROM documents)"
)

POST_TIMES = "SELECT event_id // 10 AS doc_id, min(ts) AS created_utc FROM events GROUP BY 1"

ROLLUP = """round(avg(positive), 6) AS positive, round(avg(negative), 6) AS negative,
  round(avg(neutral), 6) AS neutral, round((avg(positive) - avg(negative) + 1) / 2, 6) AS normalize_score,
  count(*) AS count"""
