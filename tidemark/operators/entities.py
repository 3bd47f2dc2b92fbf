"""Organisation mentions from a gazetteer."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import text as tx, vectors as vx

# The built-in gazetteer of organisation names.
ORGANISATIONS = ("thing", "thble", "ering", "attion", "oning", "eriner", "estion", "blend")
LABEL = "ORG"
HELD_NAMES = 200_000  # names that are broadcast
NAME_BITS = 1 << 24  # the largest bitmap, 2 MiB


def _width(gazetteer: Sequence[str]) -> int:
    return max((len(name.split(" ")) for name in gazetteer), default=1)


def ngrams(toks: Column, width: int) -> Column:
    """All runs of 1..width tokens, ordered by where they start, then by length.

    The tokens are computed once; runs of n + 1 tokens are runs of n with the token that follows, so the work
    is linear in the text for every width.
    """
    if width == 1:
        return toks

    def grow(t: Column, runs: Column, found: Column, n: int) -> Column:
        if n > width:
            return F.flatten(found)
        longer = F.zip_with(runs, F.slice(t, n, F.size(t)), lambda a, b: F.concat(a, F.lit(" "), b))

        def append(g: Column) -> Column:
            return F.zip_with(found, g, lambda some, run: F.when(run.isNull(), some).otherwise(F.array_append(some, run)))

        return vx.with_value(longer, lambda g: vx.with_value(append(g), lambda more: grow(t, g, more, n + 1)))

    return vx.with_value(toks, lambda t: grow(t, t, F.transform(t, lambda x: F.array(x)), 2))


def mentions(text: Column, gazetteer: Sequence[str] = ORGANISATIONS, lowercase: bool = True) -> Column:
    """Every gazetteer hit of a text in reading order; the text is used whole and uncleaned."""
    toks = tx.tokens(text) if lowercase else F.array_remove(F.split(text, tx.WORD_GAP, -1), "")
    return F.filter(ngrams(toks, _width(gazetteer)), lambda t: t.isin(list(gazetteer)))


def orgs(text: Column, gazetteer: Sequence[str] = ORGANISATIONS) -> Column:
    """Distinct organisations of a text, first seen first."""
    return F.array_distinct(mentions(text, gazetteer))


def docs_with_orgs(df: DataFrame, id_col: str, text: Column, gazetteer: Sequence[str] = ORGANISATIONS) -> DataFrame:
    """(id, orgs) of the texts that name an organisation.

    The test sits inside a generator. As a filter on the list it would be pushed to the scan
    and every text would be searched twice.
    """
    found = F.array(F.struct(F.col(id_col), orgs(text, gazetteer).alias("orgs")))
    return df.select(F.inline(F.filter(found, lambda d: F.size(d["orgs"]) > 0)))


def entity_spans(text: Column, gazetteer: Sequence[str] = ORGANISATIONS, label: str = LABEL) -> Column:
    """array<struct<text,label,start,end>>: hits with 0-based character offsets.

    One fold over the words and gaps of the text carries the running offset and the last
    words seen, so nothing is shuffled. Texts without a hit are left out before the fold.
    """
    folded = _fold_spans(text, list(gazetteer), _width(gazetteer), label)
    return F.when(F.size(mentions(text, gazetteer)) > 0, folded)


def _fold_spans(text: Column, names: list[str], width: int, label: str) -> Column:
    span = "struct<text:string,label:string,start:int,end:int>"
    none = F.array().cast(f"array<{span}>")

    def spans_of(name: Column, start: Column, end: Column) -> Column:
        found = F.struct(name.alias("text"), F.lit(label).alias("label"), start.alias("start"), end.alias("end"))
        return F.when(name.isin(names), F.array(found)).otherwise(none)

    def one_word(acc: Column, piece: Column) -> Column:
        end = acc["at"] + F.length(piece)
        spans = F.when(piece.isin(names), F.concat(acc["spans"], spans_of(piece, acc["at"], end)))
        return F.struct(end.alias("at"), F.coalesce(spans, acc["spans"]).alias("spans"))

    def more_words(acc: Column, piece: Column) -> Column:
        end = acc["at"] + F.length(piece)
        # The words up to this one, newest last; a gap leaves words and spans as they are.
        words = F.concat(acc["words"], F.array(F.struct(piece.alias("word"), acc["at"].alias("start"))))
        runs = []
        for n in range(1, width + 1):
            run = F.slice(words, F.size(words) - n + 1, n)
            name = F.array_join(F.transform(run, lambda w: w["word"]), " ")
            runs.append(F.when(F.size(words) >= n, spans_of(name, F.get(run, F.lit(0))["start"], end)).otherwise(none))
        recent = F.when(F.size(words) >= width, F.slice(words, F.size(words) - width + 2, width - 1)).otherwise(words)
        is_word = piece.rlike(r"^[\p{L}\p{N}']")
        return F.struct(
            end.alias("at"),
            F.when(is_word, F.concat(acc["spans"], *runs)).otherwise(acc["spans"]).alias("spans"),
            F.when(is_word, recent).otherwise(acc["words"]).alias("words"),
        )

    start = [F.lit(0).alias("at"), none.alias("spans")]
    if width > 1:
        start.append(F.array().cast("array<struct<word:string,start:int>>").alias("words"))
    step = one_word if width == 1 else more_words
    return F.aggregate(tx.pieces(text), F.struct(*start), step, lambda acc: acc["spans"])


class NameTrie:
    """Names as word lists in a trie with failure links: all hits of a text in one pass over its words.

    A node is a run of words that begins a name. ``follow`` goes on from the longest such run that ends at the word before;
    ``lengths`` are the numbers of words of all names that end there, so the work is linear in words and hits.
    """

    def __init__(self, names: Iterable[str]) -> None:
        self.step: list[dict[str, int]] = [{}]
        self.back = [0]
        self.lengths: list[tuple[int, ...]] = [()]
        for name in names:
            words = name.split(" ")
            node = 0
            for word in words:
                if word not in self.step[node]:
                    self.step[node][word] = len(self.step)
                    self.step.append({})
                    self.back.append(0)
                    self.lengths.append(())
                node = self.step[node][word]
            self.lengths[node] = (len(words),)
        level = list(self.step[0].values())
        while level:  # from short runs to long ones
            below = []
            for node in level:
                for word, child in self.step[node].items():
                    self.back[child] = self.follow(self.back[node], word)
                    self.lengths[child] += self.lengths[self.back[child]]
                    below.append(child)
            level = below

    def follow(self, node: int, word: str) -> int:
        while node and word not in self.step[node]:
            node = self.back[node]
        return self.step[node].get(word, 0)

    def hits(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """(first word, last word) of every hit, by the last word, long names first."""
        node = 0
        for k, word in enumerate(words):
            node = self.follow(node, word)
            for n in self.lengths[node]:
                yield k - n + 1, k


#: Words as :func:`tidemark.functions.text.tokens` cuts them: letters and numbers of any script, and apostrophes.
WORD = r"(?:[^\W_]|')+"


def _searched(df: DataFrame, id_col: str, text: Column, search: Callable[[], Callable[[list[str]], Iterator[tuple[int, int]]]]) -> DataFrame:
    """(id, org, start, end) of the runs of words that ``search``, made once a task, finds in the lower-cased texts."""
    import re

    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find, word = search(), re.compile(WORD)
        for pdf in batches:
            found: list[tuple] = []
            for key, text in zip(pdf["key"], pdf["text"], strict=True):
                if not isinstance(text, str):
                    continue
                spans = [m.span() for m in word.finditer(text)]
                words = [text[a:b] for a, b in spans]
                found += [(key, " ".join(words[i : j + 1]), spans[i][0], spans[j][1]) for i, j in find(words)]
            if found:
                yield pd.DataFrame(found, columns=["key", "org", "start", "end"])

    lowered = df.select(F.col(id_col).cast("string").alias("key"), F.lower(text).alias("text"))
    hits = lowered.mapInPandas(run, "key string, org string, start int, end int")
    return hits.select(F.col("key").cast(df.schema[id_col].dataType).alias(id_col), "org", "start", "end")


def walk_names(df: DataFrame, id_col: str, text: Column, names: Sequence[str]) -> DataFrame:
    """What :func:`find_names` gives, for a list of names: a trie travels with the tasks and walks the texts in Arrow batches.

    Linear in words and hits for names of any width.
    """
    listed = [name for name in dict.fromkeys(names) if name]
    return _searched(df, id_col, text, lambda: NameTrie(listed).hits)


def _sift(names: DataFrame, count: int) -> tuple[Column, int]:
    """A bitmap as a constant array of 64-bit words, and its number of bits, never more than NAME_BITS.

    It knows each name's first word, its first and last word with its width, and the name.
    """
    bits = max(64, min(NAME_BITS, 1 << (48 * count).bit_length()))
    words = F.split("org", " ")
    ends = F.concat_ws(" ", F.size(words).cast("string"), F.get(words, F.lit(0)), F.element_at(words, -1))
    marks = F.array(F.concat(F.lit("1st "), F.get(words, F.lit(0))), F.concat(F.lit("ends "), ends), F.concat(F.lit("all "), "org"))
    places = names.select(F.explode(F.transform(marks, lambda m: F.crc32(m) % F.lit(bits))).alias("place"))
    cells = places.select(F.expr("CAST(place DIV 64 AS INT)").alias("cell"), F.expr("shiftleft(1L, CAST(place % 64 AS INT))").alias("bit"))
    found = ["0"] * (bits // 64)
    for row in cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        found[row["cell"]] = str(row["bits"])
    return F.split(F.lit(",".join(found)), ",").cast("array<bigint>"), bits


def _candidates(words: Column, widths: Column, known: Callable[[str, Column], Column]) -> Column:
    """array<struct<i,n,org>>: the runs of words that the bitmap knows; i is the first word's position."""

    def runs(i: Column, first: Column) -> Column:
        fitting = F.filter(widths, lambda n: i + n <= F.size(words))
        ends = F.filter(fitting, lambda n: known("ends ", F.concat_ws(" ", n.cast("string"), first, F.get(words, i + n - 1))))
        named = F.transform(ends, lambda n: F.struct(i.alias("i"), n.alias("n"), F.array_join(F.slice(words, i + 1, n), " ").alias("org")))
        return F.filter(named, lambda c: known("all ", c["org"]))

    begun = F.array_compact(F.transform(words, lambda w, i: F.when(known("1st ", w), i)))
    return F.flatten(F.transform(begun, lambda i: runs(i, F.get(words, i))))


def _total(lengths: Column, first: Column, n: Column) -> Column:
    return F.aggregate(F.slice(lengths, first + 1, n), F.lit(0), lambda a, x: a + x)


def _placed(found: Column, parts: Column) -> Column:
    """``found`` with offsets. Words and gaps take turns in ``parts``, so word i is piece 2 * i, or the one after it.

    The lengths of the pieces are added up by blocks of about the root of their number, so no hit adds up the whole text.
    """
    lead = F.when(F.get(parts, F.lit(0)).rlike(r"^[\p{L}\p{N}']"), 0).otherwise(1)
    step = F.greatest(F.lit(16), F.sqrt(F.size(parts)).cast("int"))

    def befores(lengths: Column, step: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.size(parts) - 1, step), lambda first: _total(lengths, first, step))
        return F.aggregate(sums, F.array(F.lit(0)), lambda a, n: F.array_append(a, F.element_at(a, -1) + n))

    def hit(c: Column, at: Column, known: Column) -> Column:
        first = lead + 2 * c["i"]
        block = F.floor(first / known["step"]).cast("int")
        start = F.get(at, block) + _total(known["lengths"], block * known["step"], first % known["step"])
        size = _total(known["lengths"], first, 2 * c["n"] - 1)
        return F.struct(c["org"].alias("org"), start.alias("start"), size.alias("size"))

    def placed(known: Column) -> Column:
        return vx.with_value(befores(known["lengths"], known["step"]), lambda at: F.transform(found, lambda c: hit(c, at, known)))

    lengths = F.transform(parts, lambda x: F.length(x))
    return F.when(F.size(found) > 0, vx.with_value(F.struct(lengths.alias("lengths"), step.alias("step")), placed))


def _sifted(df: DataFrame, id_col: str, gazetteer: DataFrame, held: int, runs: Callable[[Callable[[Column], Column]], Column]) -> DataFrame:
    """The fields of ``runs``, joined with the names; its argument makes the candidates of an array of words."""
    names = gazetteer.where(F.col("org") != "").select("org").distinct()
    count, wide = names.agg(F.count("*"), F.sort_array(F.collect_set(F.size(F.split("org", " "))))).first()
    bitmap, bits = _sift(names, count)
    widths = F.array(*map(F.lit, wide)).cast("array<int>")

    def known(kind: str, mark: Column) -> Column:
        place = F.crc32(F.concat(F.lit(kind), mark)).bitwiseAND(F.lit(bits - 1))
        cell = F.get(bitmap, F.shiftright(place, 6).cast("int"))
        return F.getbit(cell, place.bitwiseAND(F.lit(63)).cast("int")) == 1

    found = df.select(id_col, F.inline(runs(lambda words: vx.with_value(words, lambda w: _candidates(w, widths, known)))))
    return found.join(F.broadcast(names) if count <= held else names, "org")


def find_names(df: DataFrame, id_col: str, text: Column, gazetteer: DataFrame, held: int = HELD_NAMES) -> DataFrame:
    """(id, org, start, end): every hit of a gazetteer table (column ``org``) of any size, overlapping ones as well.

    start and end are 0-based offsets in the lower-cased text, end exclusive. A bitmap of bounded size goes with the plan;
    only runs of words of a name's width whose first word, ends and whole text it knows leave the scan, and are joined with
    the names. Up to ``held`` names are broadcast, the join with more is Spark's choice. Null texts and names have no hit.
    """

    def runs(candidates: Callable[[Column], Column]) -> Column:
        def hits(parts: Column) -> Column:
            words = F.filter(parts, lambda x: x.rlike(r"^[\p{L}\p{N}']"))
            return vx.with_value(candidates(words), lambda found: _placed(found, parts))

        return vx.with_value(tx.pieces(text), hits)

    named = _sifted(df, id_col, gazetteer, held, runs)
    return named.select(id_col, "org", "start", (F.col("start") + F.col("size")).alias("end"))


def match_table(df: DataFrame, id_col: str, text: Column, gazetteer: DataFrame, held: int = HELD_NAMES) -> DataFrame:
    """(id, org) distinct hits against a gazetteer table (column ``org``) of any size; see :func:`find_names`."""

    def runs(candidates: Callable[[Column], Column]) -> Column:
        return F.array_distinct(F.transform(candidates(tx.tokens(text)), lambda c: F.struct(c["org"].alias("org"))))

    return _sifted(df, id_col, gazetteer, held, runs).select(id_col, "org").distinct()


def extract_with_model(
    df: DataFrame,
    id_col: str,
    text_col: str,
    load_model: Callable[[], Callable[[list[str]], Sequence[Sequence[str]]]],
    batch_size: int = 128,
) -> DataFrame:
    """(id, orgs) from a caller's extractor over the lower-cased whole text, loaded once per task."""
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for pdf in batches:
            for at in range(0, len(pdf), batch_size):
                part = pdf.iloc[at : at + batch_size]
                found = [list(dict.fromkeys(names)) for names in model(part["text"].tolist())]
                yield pd.DataFrame({id_col: part[id_col].tolist(), "orgs": found})

    lowered = df.select(id_col, F.lower(text_col).alias("text"))
    return lowered.mapInPandas(run, f"{id_col} {df.schema[id_col].dataType.simpleString()}, orgs array<string>")


def mention_counts(df: DataFrame, text: Column, gazetteer: Sequence[str] = ORGANISATIONS) -> DataFrame:
    """(org, mentions): every mention counts."""
    return df.select(F.explode(mentions(text, gazetteer)).alias("org")).groupBy("org").agg(F.count("*").alias("mentions"))


def distinct_orgs(df: DataFrame, text: Column, gazetteer: Sequence[str] = ORGANISATIONS) -> DataFrame:
    """The union of the organisation sets of all texts."""
    return df.select(F.explode(orgs(text, gazetteer)).alias("org")).distinct()


def refine_orgs(found: DataFrame, gazetteer: Sequence[str] = ORGANISATIONS) -> DataFrame:
    """Run the extractor again over the distinct names themselves and keep what it confirms."""
    return distinct_orgs(found.select("org").distinct(), F.col("org"), gazetteer)
