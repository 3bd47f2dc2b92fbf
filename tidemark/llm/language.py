"""Language identification by cross-parsing: the language whose text explains a document in the fewest phrases."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidemark.llm import common

SAMPLE_DOCS = 400
SAMPLE_WORDS = 6_000
CACHED = 100_000
UNDETERMINED = "und"
LANE = 40


def fit(docs: DataFrame, held_out: Column, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS) -> dict[str, list[str]]:
    """Language -> words of its labelled text, most frequent first. Rows under ``held_out`` are not read.

    Bounded sample, documented parameters: about ``sample_docs`` whole documents a language, chosen by a hash of
    the id, and of their words the ``sample_words`` most frequent. Rows without text, letter or label are left out.
    """
    common.small_batches(docs.sparkSession)
    usable = docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    usable = usable.select(F.col("lang").cast("string").alias("lang"), "text", common.unit_hash("doc_id").alias("_u"))
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return {}
    rate = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, sample_docs / n)])
    sample = usable.where(F.col("_u") < rate[F.col("lang")])
    letters = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    counted = sample.select("lang", F.explode(letters).alias("word")).groupBy("lang", "word").count()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))
    model: dict[str, list[str]] = {lang: [] for lang in sorted(sizes, key=lambda x: (-sizes[x], x))}
    for r in counted.withColumn("_r", rank).where(F.col("_r") <= sample_words).orderBy("lang", "_r").collect():
        model[r["lang"]].append(r["word"])
    return {lang: words for lang, words in model.items() if words}


def suffix_automaton(words: list[str]) -> list[dict[str, int]]:
    """Transitions of the smallest automaton that accepts every substring of every word; state 0 is the root."""
    step: list[dict[str, int]] = [{}]
    link, size = [-1], [0]

    def clone(state: int, letter: str, target: int) -> int:
        new = len(step)
        step.append(dict(step[target]))
        size.append(size[state] + 1)
        link.append(link[target])
        link[target] = new
        while state >= 0 and step[state].get(letter) == target:
            step[state][letter] = new
            state = link[state]
        return new

    for word in words:
        last = 0
        for letter in word:
            target = step[last].get(letter)
            if target is not None:
                last = target if size[target] == size[last] + 1 else clone(last, letter, target)
                continue
            new = len(step)
            step.append({})
            size.append(size[last] + 1)
            link.append(0)
            state = last
            while state >= 0 and letter not in step[state]:
                step[state][letter] = new
                state = link[state]
            if state >= 0:
                target = step[state][letter]
                link[new] = target if size[target] == size[state] + 1 else clone(state, letter, target)
            last = new
    return step


def phrases(word: str, step: list[dict[str, int]]) -> int:
    """Number of phrases when ``word`` is parsed from the left, each phrase the longest match in the automaton."""
    count, state = 0, 0
    for letter in word:
        target = step[state].get(letter)
        if target is None:
            count += state != 0
            target = step[0].get(letter, 0)
            count += target == 0
        state = target
    return count + (state != 0)


def predicted(text: Column, model: dict[str, list[str]]) -> Column:
    """struct(lang, score, rate) of a text; ``und`` with score 0 for null, letterless texts or an empty model.

    A word is parsed between two marks, by itself, so each distinct word is parsed once a task. The cross-parsing
    entropy of a language is its number of phrases times the bits to point into its text, over the letters; the
    smallest wins, and of equal ones the language with more labelled rows. score is the share of the runner-up's
    entropy in both, 0.5 to 1; ``rate`` is the winner's phrases a letter.
    """
    langs = list(model)

    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automata = [suffix_automaton([f" {w} " for w in model[lang]]) for lang in langs]
        bits = [math.log2(sum(len(w) + 2 for w in model[lang])) for lang in langs]
        runs = re.compile(r"[^\W\d_]+")
        mask = (1 << LANE) - 1
        known: dict[str, int] = {}
        older: dict[str, int] = {}

        def lanes(token: str) -> int:
            total = 0
            found = runs.findall(token)
            if not all(map(str.isalpha, found)):  # numerals such as ½ and Ⅷ are no letters
                found = "".join(c if c.isalpha() else " " for c in token).split()
            for word in found:
                framed = f" {word} "
                total += len(word)
                for k, step in enumerate(automata, 1):
                    total += phrases(framed, step) << (LANE * k)
            return total

        for batch in batches:
            out = []
            for text in batch:
                tokens = text.lower().split() if text else []
                if len(known) > CACHED // 2:
                    known, older = {}, known  # words in use move on, the others go with the next change
                for token in set(tokens):
                    if token not in known:
                        value = older.pop(token, None)
                        known[token] = lanes(token) if value is None else value
                total = sum([known[t] for t in tokens])
                letters = total & mask
                if not letters or not langs:
                    out.append((UNDETERMINED, 0.0, None))
                    continue
                counts = [total >> (LANE * k) & mask for k in range(1, len(langs) + 1)]
                cost = [c * b for c, b in zip(counts, bits, strict=True)]
                best = min(range(len(langs)), key=cost.__getitem__)
                rest = min((c for k, c in enumerate(cost) if k != best), default=None)
                score = 1.0 if rest is None else rest / (rest + cost[best])
                out.append((langs[best], score, counts[best] / letters))
            yield pd.DataFrame(out, columns=["lang", "score", "rate"])

    return F.pandas_udf(parse, "lang string, score double, rate double")(text)


def identify(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): one row per document; learns only from rows not held out."""
    model = fit(docs, held_out)
    rows = docs.select("doc_id", held_out.alias("held_out"), predicted(F.col("text"), model).alias("_p"))
    return rows.select("doc_id", "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"), F.col("_p.rate").alias("phrases_per_letter"))


def accepted(docs: DataFrame, held_out: Column) -> DataFrame:
    """``docs`` without the rows whose language is undetermined; all other rows and all columns stay.

    Without any labelled row there is no language to tell, and only texts without a letter go.
    """
    model = fit(docs, held_out)
    if not model:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    rows = docs.select(F.struct("*").alias("_doc"), predicted(F.col("text"), model).alias("_p"))
    return rows.where(F.col("_p.lang") != UNDETERMINED).select("_doc.*")
