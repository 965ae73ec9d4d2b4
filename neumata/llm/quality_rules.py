"""Quality rules as a short-circuit cascade, in built-in column functions only.

Each rule is a predicate over measures of the text. On a bounded sample every measure is
timed, and it is noted which rules reject which documents. The first rule is the one of
most rejection per cost; each next one is the best for the documents that the rules
before it leave over, and pays only for measures that none before has taken. Rules that
are nearly as good as the best go in the order they are listed in. They stand in one
CASE expression in that order, so a document stops at the first rule that rejects it,
measures no rule has asked for are not taken, and the dear rules see few documents. The
order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neumata.llm.shared import Scratch, let, words_of

GRAM = 5
SAMPLE_ROWS = 1_000
#: Seconds below which measures cost the same, runs, of which the shortest counts, and how far below the best a rule is nearly as good.
LEAST_COST, TRIES, NEARLY = 0.02, 2, 4.0

Measured = Callable[[str], Column]


def repeated_words(words: Column) -> Column:
    """Words covered by GRAM-word windows that occur twice or more in the same text."""
    gram = lambda hashes: F.transform(
        F.sequence(F.lit(0), F.size(hashes) - GRAM), lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(GRAM)))
    )
    return F.when(F.size(words) < GRAM, F.lit(0)).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: let(gram(hashes), _covered))
    ).cast("long")


def _covered(grams: Column) -> Column:
    ordered = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(pairs: Column) -> Column:
        same = lambda k, x: F.coalesce(F.get(pairs, k)["h"] == x["h"], F.lit(False))
        twice = F.filter(pairs, lambda x, k: same(k + 1, x) | F.when(k > 0, same(k - 1, x)).otherwise(False))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def total(starts: Column) -> Column:
        reach = F.transform(starts, lambda p, k: F.least(F.coalesce(F.get(starts, k + 1) - p, F.lit(GRAM)), F.lit(GRAM)))
        return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(
        let(ordered, lambda pairs: let(positions(pairs), total))
    )


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


#: name -> measure of (text, words)
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, words: F.size(words).cast("long"),
    "word_chars": lambda text, words: F.length(F.array_join(words, "")).cast("long"),
    "n_symbols": lambda text, words: F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
    "n_marks": lambda text, words: F.regexp_count(text, F.lit(r"[!?]")).cast("long"),
    "n_lines": lambda text, words: F.size(_lines(text)).cast("long"),
    "n_dup_lines": lambda text, words: let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    "n_repeat_words": lambda text, words: repeated_words(words),
}


@dataclass(frozen=True)
class Rule:
    """rejects: whether, over the measures of a text, which ``measures`` names."""

    name: str
    rejects: Callable[[Measured], Column]
    measures: tuple[str, ...]


RULES = (
    Rule("few_words", lambda m: m("n_words") < 10, ("n_words",)),
    Rule("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 15 * m("n_words")), ("word_chars", "n_words")),
    Rule("symbols", lambda m: 10 * m("n_symbols") > m("n_words"), ("n_symbols", "n_words")),
    Rule("marks", lambda m: 2 * m("n_marks") > m("n_words"), ("n_marks", "n_words")),
    Rule("dup_lines", lambda m: 2 * m("n_dup_lines") > m("n_lines"), ("n_dup_lines", "n_lines")),
    Rule("repeats", lambda m: 100 * m("n_repeat_words") > 20 * m("n_words"), ("n_repeat_words", "n_words")),
)
BASE = ("few_words", "repeats")


def verdict(m: Measured, rules: tuple[Rule, ...]) -> Column:
    """The name of the first rule that rejects, in the given order; null where none does."""
    first = F.when(rules[0].rejects(m), F.lit(rules[0].name))
    for rule in rules[1:]:
        first = first.when(rule.rejects(m), F.lit(rule.name))
    return first


def measured_costs(sample: DataFrame, names: list[str], tries: int = TRIES) -> dict[str, float]:
    """Seconds that each measure takes over a sample, beyond reading it and splitting its words, which every document is spared or
    pays once: the shortest of ``tries`` runs, and LEAST_COST at least."""
    text = F.col("text")

    def seconds(column: Column) -> float:
        began = time.perf_counter()
        sample.agg(F.max(column)).collect()
        return time.perf_counter() - began

    of = lambda name: let(words_of(text), lambda words: MEASURES[name](text, words) if name else F.size(words))
    runs = {name: min(seconds(of(name)) for _ in range(tries)) for name in ("", *names)}
    return {name: max(runs[name] - runs[""], LEAST_COST) for name in names}


def measured_cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """The rules in order, each with its cost in seconds over the sample and the share of the documents that come to it it rejects.

    The sample is about ``sample_rows`` documents chosen by a hash of doc_id, twice as many
    at most, written to the shared folder once. An empty sample leaves the given order. Costs
    are measured, so the order of rules that differ by NEARLY or so may change between runs.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    share = min(1.0, sample_rows / max(1, docs.count()))
    drawn = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    sample = scratch.keep(drawn.limit(2 * sample_rows), "sample")
    of = lambda rule, words: rule.rejects(lambda name: MEASURES[name](F.col("text"), words))
    judged = let(words_of(F.col("text")), lambda words: F.struct(*(of(rule, words).alias(rule.name) for rule in rules)))
    flags = sample.groupBy(judged.alias("r")).agg(F.count("*").alias("n")).select("r.*", "n").collect()  # 2 ** rules rows at most
    cost = measured_costs(sample, sorted({name for rule in rules for name in rule.measures})) if flags else {}
    scratch.drop()
    order, left, taken = [], [row.asDict() for row in flags], set()
    rest = list(rules)
    while rest:
        seen = sum(row["n"] for row in left)
        caught = {rule.name: sum(row["n"] for row in left if row[rule.name]) for rule in rest}
        dear = {rule.name: max(sum(cost.get(name, 0.0) for name in rule.measures if name not in taken), LEAST_COST) for rule in rest}
        worth = {rule.name: caught[rule.name] / dear[rule.name] for rule in rest}
        best = next(rule for rule in rest if worth[rule.name] * NEARLY >= max(worth.values()))
        order.append((best, dear[best.name], caught[best.name] / seen if seen else 0.0))
        rest.remove(best)
        taken |= set(best.measures)
        left = [row for row in left if not row[best.name]]
    return order


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    return tuple(rule for rule, _, _ in measured_cascade(docs, rules))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns as they are.

    Null, empty and very short texts are rejected; texts of any length are read whole.
    Repeated rows are judged alike, and all stay or go. An empty table gives an empty
    result. Columns of any names stay. The cascade is evaluated lazily within the filter.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    order = cascade_order(docs, rules)
    reason = let(words_of(text), lambda words: verdict(lambda name: MEASURES[name](text, words), order))
    return docs.where(reason.isNull())


#: The measures that ``judged`` gives of every document.
GIVEN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: doc_id, the GIVEN measures, base_failed, rejected_by (the first rule that does, null if none) and kept.

    GIVEN measures are results, so they are taken of every row; the cascade asks for the
    others only of documents that come as far. A null text counts as empty: all measures
    0, base_failed true. Texts of any length are read whole. Repeated rows repeat; an empty
    table gives an empty result. Columns beyond doc_id and text are ignored, whatever their names.
    """
    order = cascade_order(docs, rules)
    text = F.coalesce(F.col("text"), F.lit(""))
    base = [r for r in rules if r.name in BASE]

    def of(words: Column) -> Column:
        given = F.struct(*(MEASURES[n](text, words).alias(n) for n in GIVEN))

        def result(q: Column) -> Column:
            m = lambda name: q[name] if name in GIVEN else MEASURES[name](text, words)
            failed = base[0].rejects(m)
            for rule in base[1:]:
                failed = failed | rule.rejects(m)
            return F.struct(*(q[n].alias(n) for n in GIVEN), failed.alias("base_failed"), verdict(m, order).alias("rejected_by"))

        return let(given, result)

    rows = docs.select("doc_id", let(words_of(text), of).alias("quality"))
    return rows.select("doc_id", "quality.*").withColumn("kept", F.col("rejected_by").isNull())
