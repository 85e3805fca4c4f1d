"""Quality rules as a short-circuit cascade, with DataFrame functions only.

Every rule is a column that is true where a text is rejected, made from measures of the text. On a bounded hash sample each
rule's cost (seconds of the measures that aren't columns yet) and selectivity are estimated; the cascade asks the rules in
order of rejection per cost, among the rows that the rules before let pass, and stops at the first that rejects, so the
measures of later rules are not computed there. The order changes what a run costs, never what it keeps.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let, sampled, words

#: Words in a window of n_repeat_words.
WINDOW = 8
#: Timings of a measure, and the seconds of a rule that computes nothing.
TIMINGS, FREE = 5, 1e-3
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


Measure = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """rejects: from a function that gives a measure by its name, the column that is true for a bad text."""

    name: str
    rejects: Callable[[Measure], Column]


#: Integer arithmetic only, so that any engine agrees.
RULES = (
    Rule("too_short", lambda m: m("n_words") < 20),
    Rule("repeats", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words")),
    Rule("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 15 * m("n_words"))),
    Rule("symbols", lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("duplicate_lines", lambda m: 10 * m("n_dup_lines") > 3 * m("n_lines")),
    Rule("capitals", lambda m: 2 * m("n_capitals") > m("word_chars")),
    Rule("shouting", lambda m: 4 * m("n_shouts") > m("n_words")),
)


def repeated_words(w: Column) -> Column:
    """How many words of the array stand in windows of WINDOW words that the array has twice or more."""

    def covered(h: Column) -> Column:
        by_hash = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def at(s: Column) -> Column:
            twin = F.filter(s, lambda x, j: (F.get(s, j - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, j + 1)["h"].eqNullSafe(x["h"])))
            return F.array_sort(F.transform(twin, lambda x: x["i"]))

        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(let(by_hash, at), start, lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n")), lambda a: a["n"])

    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(found)


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


#: Each measure of a text on its own, long; the text is never null.
MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": lambda t: _count(t, WORD),
    "word_chars": lambda t: F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("long"),
    "n_symbols": lambda t: _count(t, "[#*$%&|<>]"),
    "n_dup_lines": lambda t: let(_lines(t), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    "n_repeat_words": lambda t: let(words(t), lambda w: repeated_words(w).cast("long")),
    "n_lines": lambda t: F.size(_lines(t)).cast("long"),
    "n_capitals": lambda t: _count(t, "[A-Z]"),
    "n_shouts": lambda t: _count(t, "!"),
}


def with_measures(docs: DataFrame) -> DataFrame:
    """docs and the columns of BASE, all long, in one pass over the words and one over the lines. Null text: zeros."""
    text = F.coalesce(F.col("text"), F.lit(""))
    of_words = let(
        words(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    names = [c for c in docs.columns if c not in BASE]
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")  # so that names of docs can't clash with ours
    out = docs.select(row, of_words.alias("w"), MEASURES["n_symbols"](text).alias("n_symbols"), MEASURES["n_dup_lines"](text).alias("n_dup_lines"))
    of = lambda c: F.col("w").getField(c) if c in ("n_words", "word_chars", "n_repeat_words") else F.col(c)
    return out.select(*[F.col("row").getField(c).alias(c) for c in names], *[of(c).alias(c) for c in BASE])


def measures_of(rule: Rule) -> set[str]:
    """The names of the measures that a rule asks for."""
    asked: set[str] = set()

    def note(name: str) -> Column:
        asked.add(name)
        return F.lit(0)

    rule.rejects(note)
    return asked


def surveyed(docs: DataFrame, rules: tuple[Rule, ...] = RULES, known: tuple[str, ...] = (), sample_rows: int = 2_000, sample_bytes: int = 16_000_000) -> tuple[list[float], dict[int, int]]:
    """(seconds of each rule, rows of each set of rejecting rules as bits), from about sample_rows hash-chosen rows that hold sample_bytes at most.

    A rule costs what its measures cost that aren't known: the cascade computes these anew wherever it reaches the rule. Each is
    timed alone, TIMINGS times; the median is rounded to a power of two, so that noise doesn't change the order.
    """
    sample = sampled(docs, sample_rows, sample_bytes).persist()
    try:
        sample.count()
        alone = lambda name: MEASURES[name](F.col("text"))

        def timed(value: Column) -> float:
            began = time.perf_counter()
            sample.agg(F.sum(value)).first()
            return time.perf_counter() - began

        def seconds(value: Column) -> float:
            timed(value)  # compiles
            return median(timed(value) for _ in range(TIMINGS))

        idle = seconds(F.lit(0))
        dear = {m: 2.0 ** round(math.log2(max(FREE, seconds(alone(m)) - idle))) for m in sorted({m for r in rules for m in measures_of(r)} - {*known})}
        costs = [FREE + sum(dear[m] for m in measures_of(r) - {*known}) for r in rules]
        bits = F.lit(0).cast("long")
        for k, r in enumerate(rules):
            bits = bits + F.when(r.rejects(alone), 1 << k).otherwise(0)
        return costs, {r["bits"]: r["n"] for r in sample.select(bits.alias("bits")).groupBy("bits").agg(F.count("*").alias("n")).collect()}  # 2 ** len(rules) rows at most
    finally:
        sample.unpersist()


def rated(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2_000, sample_bytes: int = 16_000_000, known: tuple[str, ...] = ()) -> list[tuple[Rule, float, float]]:
    """(rule, share rejected, seconds) of each rule alone."""
    costs, sets = surveyed(docs, rules, known, sample_rows, sample_bytes)
    n = max(1, sum(sets.values()))
    return [(r, sum(m for bits, m in sets.items() if bits >> k & 1) / n, costs[k]) for k, r in enumerate(rules)]


def cascade_order(rates: list[tuple[Rule, float, float]]) -> list[Rule]:
    """By rejection per cost; of equal ones, the cheaper first."""
    return [r for r, share, seconds in sorted(rates, key=lambda x: (-x[1] / x[2], x[2]))]


def survivors_order(rules: tuple[Rule, ...], costs: list[float], sets: dict[int, int]) -> list[Rule]:
    """The rules one by one, each the one that rejects most per cost of the rows that those before it let pass; of equal ones the cheaper, then the earlier."""
    left, out = list(range(len(rules))), []
    while left:
        rates = [(rules[k], sum(n for bits, n in sets.items() if bits >> k & 1), costs[k]) for k in left]
        best = left[[r[0] for r in rates].index(cascade_order(rates)[0])]
        out.append(rules[best])
        left.remove(best)
        sets = {bits: n for bits, n in sets.items() if not bits >> best & 1}
    return out


def quality_cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2_000, known: tuple[str, ...] = ()) -> DataFrame:
    """docs, failed_rule (the first in the cascade's order that rejects; null: none) and kept.

    known: measures that docs has as columns already, which the cascade then reads; all others are computed where a rule is
    reached. Which of several failing rules is named depends on the order; kept does not. Null or empty text: no words, so
    rejected. Equal rows get equal verdicts. Columns of these names in docs are replaced. Empty: no rows.
    """
    docs = docs.drop("failed_rule", "kept")
    text = F.coalesce(F.col("text"), F.lit(""))
    lazy = lambda name: F.col(f"`{name}`") if name in known else MEASURES[name](text)
    chain = None
    for r in survivors_order(rules, *surveyed(docs, rules, known, sample_rows)):
        chain = (F if chain is None else chain).when(r.rejects(lazy), F.lit(r.name))
    out = docs.withColumn("failed_rule", F.lit(None).cast("string") if chain is None else chain)
    return out.withColumn("kept", F.col("failed_rule").isNull())


def with_verdict(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2_000) -> DataFrame:
    """docs, BASE, base_failed (under 20 words, or over 30 % of them repeated), failed_rule and kept (false if base_failed)."""
    out = quality_cascade(with_measures(docs.drop("base_failed")), rules, sample_rows, known=BASE)
    base = F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    return out.withColumn("base_failed", base).withColumn("kept", F.col("kept") & ~F.col("base_failed"))
