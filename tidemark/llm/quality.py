"""Quality rules: text statistics and a decision list learned from labels by sequential covering."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import common
from tidemark.session import cut_lineage

WINDOW = 5
SYMBOLS = "#*$%&|<>"  # fixed value
BINS = 24
MAX_RULES = 8
MAX_TERMS = 3
LEAST_COVERED = 4
PRECISION = 0.97
FEATURES = ("chars_per_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "distinct_share", "words")


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once a row."""
    return F.transform(F.array(value), f)[0]


def repeated(words: Column) -> Column:
    """Number of words that lie in a window of WINDOW words found at least twice in the text.

    Windows are compared by a 64-bit hash. Each is packed into one number, upper hash bits before its place, with as
    many bits for the place as the text needs; after sorting, equal windows are neighbours, and their whole
    hashes are compared. Linear but for the sort, with no window held twice.
    """

    def joined(left: Column, right: Column) -> Column:
        return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))

    def tail(values: Column, skip: int) -> Column:
        return F.slice(values, skip + 1, F.greatest(F.size(values) - skip, F.lit(0)))

    def head(values: Column, n: Column) -> Column:
        return F.slice(values, 1, F.greatest(n, F.lit(0)))

    def windows(h: Column) -> Column:  # hashes of 1, 2, 4 and then 5 words
        return bound(joined(head(h, F.size(h) - 1), tail(h, 1)), lambda two: bound(
            joined(head(two, F.size(two) - 2), tail(two, 2)),
            lambda four: joined(head(four, F.size(four) - 1), tail(h, 4)),
        ))

    def covered(g: Column) -> Column:
        width = F.length(F.bin(F.size(g).cast("long")))
        low = F.call_function("shiftleft", F.lit(1).cast("long"), width) - 1
        packed = F.transform(g, lambda x, i: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")))

        def places(at: Column) -> Column:
            same = F.zip_with(head(at, F.size(at) - 1), tail(at, 1), lambda a, b: F.get(g, a) == F.get(g, b))
            return bound(same, lambda eq: F.sort_array(F.filter(at, lambda p, i: F.coalesce(F.get(eq, i), F.lit(False)) | F.coalesce(F.get(eq, i - 1), F.lit(False)))))

        def union(at: Column) -> Column:
            steps = F.zip_with(head(at, F.size(at) - 1), tail(at, 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
            return F.when(F.size(at) > 0, F.aggregate(steps, F.lit(WINDOW), lambda s, x: s + x)).otherwise(0)

        ordered = F.transform(F.sort_array(packed), lambda x: x.bitwiseAND(low).cast("int"))
        return bound(bound(ordered, places), union)

    def counted(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(covered(g))

    many = bound(windows(F.transform(words, lambda w: F.xxhash64(w))), counted)
    return F.when(F.size(words) > WINDOW, many).otherwise(0).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_distinct, n_lines of whole texts.

    Null text: all zero. Words are runs without blanks and U+0009..U+000D. One row per document.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("_text"), common.words(text).alias("_words"))
    bare = F.col("_text")
    for symbol in SYMBOLS:
        bare = F.replace(bare, F.lit(symbol), F.lit(""))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(common.WHITE)) != "")
    duplicates = bound(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    found = rows.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.octet_length("_text") - F.octet_length(bare)).cast("long").alias("n_symbols"),
        duplicates.alias("_lines"),
        repeated(F.col("_words")).alias("n_repeat_words"),
        (F.char_length("_text") - F.char_length(F.regexp_replace("_text", r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
    )
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", (F.col("_lines.n") - F.col("_lines.d")).cast("long").alias("n_dup_lines"),
        "n_repeat_words", "n_upper", "n_distinct", F.col("_lines.n").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    values = (
        F.col("word_chars") / n,
        F.col("n_symbols") / n,
        F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        F.col("n_repeat_words") / n,
        F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
        F.col("n_distinct") / n,
        F.col("n_words").cast("double"),
    )
    return dict(zip(FEATURES, values, strict=True))


Term = tuple[str, bool, float]  # feature, whether above, threshold
Rule = list[Term]


def condition(rule: Rule) -> Column:
    """The rule's conjunction as a Spark condition over the statistics."""
    values, out = features(), F.lit(True)
    for name, above, threshold in rule:
        out = out & (values[name] > threshold if above else values[name] <= threshold)
    return out


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional expression: the first rule that holds rejects."""
    out = None
    for rule in rules:
        out = F.when(condition(rule), F.lit(False)) if out is None else out.when(condition(rule), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def learn(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """Ordered rules that reject rows labelled quality 0, by sequential covering (grow, prune, remove what is covered).

    All labelled rows take part: two thirds (by a hash of the id) grow a rule, the others prune it. A term is a
    feature above or up to one of BINS quantiles of the labelled rows; the term with most information gain is added
    until no good row is covered or MAX_TERMS. Last terms are then dropped while that does not lower the precision on
    the pruning rows. A rule counts if it rejects at least LEAST_COVERED bad rows with PRECISION over all rows; the
    first that does not ends the list, as does MAX_RULES. Each step is one aggregate of sums by feature and bin (a
    fixed number of rows to the driver). Null labels and ids, and rows that fail the base rules, are left out;
    without bad or good rows there is no rule. Repeated labels of an id: it is bad if any is 0.
    """
    marked = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("_q"))
    values = [F.struct(F.lit(name).alias("f"), v.alias("v")) for name, v in features().items()]
    rows = stats.where(~base_failed()).join(marked, "doc_id")
    grown = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(9)), F.lit(3)) > 0
    rows = cut_lineage(rows.select(*[c for c in stats.columns if c != "doc_id"], (F.col("_q") == 0).alias("_bad"), grown.alias("_grow")))
    steps = [k / BINS for k in range(BINS)]
    cuts = rows.agg(*[F.percentile_approx(v, steps, 10_000).alias(name) for name, v in features().items()]).first()
    thresholds = {name: sorted(set(cuts[name] or [])) for name in FEATURES}
    bins = F.create_map(*[x for name in FEATURES for x in (F.lit(name), F.array(*map(F.lit, thresholds[name])).cast("array<double>"))])
    rules: list[Rule] = []

    def sums(where: Column) -> dict[tuple[str, int], tuple[int, int]]:
        """(feature, number of thresholds below the value) -> bad and good rows."""
        each = rows.where(where).select("_bad", F.inline(F.array(*values)))
        below = F.size(F.filter(bins[F.col("f")], lambda t: t < F.col("v")))
        counts = each.groupBy("f", below.alias("b")).agg(F.sum(F.col("_bad").cast("long")), F.count("*")).collect()
        return {(r[0], r[1]): (r[2], r[3] - r[2]) for r in counts}

    def totals(rule: Rule, where: Column) -> list[tuple[int, int]]:
        """Bad and good rows covered by each beginning of the rule."""
        parts = [condition(rule[: k + 1]) for k in range(len(rule))]
        sides = [F.sum((p & b).cast("long")) for p in parts for b in (F.col("_bad"), ~F.col("_bad"))]
        found = rows.where(where).agg(*sides).first()
        return [(found[2 * k] or 0, found[2 * k + 1] or 0) for k in range(len(rule))]

    def gain(bad: int, good: int, before: tuple[int, int]) -> float:
        if not bad:
            return 0.0
        return bad * (math.log2(bad / (bad + good)) - math.log2(before[0] / sum(before)))

    while len(rules) < MAX_RULES:
        left = F.lit(True)
        for rule in rules:
            left = left & ~condition(rule)
        rule, covered = [], left & F.col("_grow")
        while len(rule) < MAX_TERMS:
            found = sums(covered)
            now = tuple(sum(x[k] for (f, _), x in found.items() if f == FEATURES[0]) for k in (0, 1))
            if not now[0] or not now[1]:
                break
            best = max(((gain(*side, now), name, above, t) for name, above, t, side in _terms(found, thresholds)), default=(0.0,))
            if best[0] <= 0:
                break
            rule.append(best[1:])
            covered = left & F.col("_grow") & condition(rule)
        if not rule:
            break
        checked, everything = totals(rule, left & ~F.col("_grow")), totals(rule, left)
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in checked]
        keep = max(range(len(rule)), key=lambda k: (worth[k], -k))
        bad, good = everything[keep]
        if bad < LEAST_COVERED or bad < PRECISION * (bad + good):
            bad, good = everything[-1]
            keep = len(rule) - 1
        if bad < LEAST_COVERED or bad < PRECISION * (bad + good):
            break
        rules.append(rule[: keep + 1])
    return rules


def _terms(found: dict, thresholds: dict[str, list[float]]):
    """(feature, above, threshold, (bad, good)) of every possible next term."""
    for name, cuts in thresholds.items():
        rows = [found.get((name, b), (0, 0)) for b in range(len(cuts) + 1)]
        for k, t in enumerate(cuts):
            up = tuple(sum(r[i] for r in rows[k + 1 :]) for i in (0, 1))
            down = tuple(sum(r[i] for r in rows[: k + 1]) for i in (0, 1))
            yield name, True, t, up
            yield name, False, t, down


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of every document with base_failed and kept (false if base_failed, else the list's verdict)."""
    stats = cut_lineage(statistics(docs))
    rules = learn(stats, labels)
    failed = base_failed()
    return stats.select("*", failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
