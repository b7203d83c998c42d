"""Quality rules as a short-circuit cascade (SQL functions only).

A document is kept if no rule rejects it, so the verdict does not depend on
the order; only the work does. The order is chosen from a sample: each rule's
cost (time per row) and its rejection rate are measured and rules run by
falling rejection per cost. In the cascade expression a later rule is not
evaluated for a document that an earlier one rejected. The words, which most
rules need, are cut once per document and bound around the cascade; the lines and
the letter counts are made where a rule asks for them. A rule's cost is what it
adds to the words.

Edge cases: a null text is the empty text, which ``few_words`` rejects. A
repeated row is judged like the first. Extra columns pass through untouched;
an empty table gives an empty result and keeps the declared order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gridmart.llm.common import WS_CHARS, let, release, staged, words

SYMBOLS = "[#*$%&|<>]+"

#: Bound of the sample that the order is estimated on (rows).
SAMPLE_ROWS = 1000


def _without(text: Column, pattern: str) -> Column:
    return F.char_length(F.regexp_replace(text, F.lit(pattern), F.lit("")))


def _lines(text: Column) -> Column:
    """Lines that hold at least one word."""
    return F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(WS_CHARS)) != "")


def _repeat_words(ws: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, each word once.

    Windows are sorted by hash, so equal ones are neighbours; their positions
    are then sorted and each adds at most the three words not yet covered.
    """
    hashes = F.transform(
        F.slice(ws, F.lit(1), F.greatest(F.size(ws) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)),
    )

    def positions(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"],
        )))

    def covered(pos: Column) -> Column:
        return F.aggregate(
            pos,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
            lambda a, p: F.struct(
                (a["n"] + F.least(p - a["last"], F.lit(3))).alias("n"), p.alias("last")
            ),
            lambda a: a["n"],
        )

    return let(hashes, lambda hs: F.when(
        F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")
    ).otherwise(covered(positions(hs))))


@dataclass(frozen=True)
class Counts:
    """The measurable quantities of a text, each a column expression."""

    n_words: Column
    word_chars: Column
    n_symbols: Column
    n_lines: Column
    n_dup_lines: Column
    n_repeat_words: Column
    n_upper: Column
    n_lower: Column


#: The counts that ``judge`` reports.
REPORTED = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def text_counts(text: Column, ws: Column, ls: Column) -> Counts:
    """Counts of a text that is not null, from its words and its lines with a word."""
    n = F.char_length(text)
    long = lambda c: c.cast("long")
    return Counts(
        n_words=long(F.size(ws)),
        word_chars=long(F.char_length(F.array_join(ws, ""))),
        n_symbols=long(n - _without(text, SYMBOLS)),
        n_lines=long(F.size(ls)),
        n_dup_lines=long(F.size(ls) - F.size(F.array_distinct(ls))),
        n_repeat_words=_repeat_words(ws),
        n_upper=long(n - _without(text, "[A-Z]+")),
        n_lower=long(n - _without(text, "[a-z]+")),
    )


@dataclass(frozen=True)
class Rule:
    """A named rejection; ``reject`` is never null. ``lines``: it looks at the lines."""

    name: str
    reject: Callable[[Counts], Column]
    lines: bool = False


#: All in integer arithmetic, so that any engine gives the same verdicts.
RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda c: c.n_words < 50),
    Rule("repeated_windows", lambda c: 100 * c.n_repeat_words > 50 * c.n_words),
    Rule("symbols", lambda c: 10 * c.n_symbols > c.n_words),
    Rule("duplicate_lines", lambda c: 10 * c.n_dup_lines > 6 * c.n_lines, lines=True),
    Rule("word_length", lambda c: (c.word_chars < 2 * c.n_words) | (c.word_chars > 15 * c.n_words)),
    Rule("shouting", lambda c: c.n_upper > c.n_lower),
)
BASE_RULES = ("few_words", "repeated_windows")


def rejects(rule: Rule, text: Column, ws: Column) -> Column:
    """Whether a rule rejects a text with these words."""
    if rule.lines:
        return let(_lines(text), lambda ls: rule.reject(text_counts(text, ws, ls)))
    return rule.reject(text_counts(text, ws, F.array()))


@dataclass(frozen=True)
class RuleStats:
    name: str
    cost: float  # seconds per sampled row above the scan that cuts the words
    rejection: float  # share of sampled rows

    @property
    def value(self) -> float:
        return self.rejection / self.cost


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
             sample_rows: int = SAMPLE_ROWS) -> list[RuleStats]:
    """Measure every rule on one stored sample of about ``sample_rows`` rows."""
    total = docs.count()
    if not total:
        return [RuleStats(r.name, 1.0, 0.0) for r in rules]
    sample = docs.select(F.col(text).alias("text"))
    if total > sample_rows:
        sample = sample.sample(fraction=sample_rows / total, seed=11)
    # A shuffle of the sampled rows only; coalesce(1) would scan the table in one task.
    sample = staged(sample.repartition(1))
    shown = F.coalesce("text", F.lit(""))

    def timed(reject: Callable[[Column], Column]) -> tuple[float, int, int]:
        query = sample.agg(F.count_if(let(words(shown), reject)).alias("r"), F.count(F.lit(1)).alias("n"))
        best, row = float("inf"), None
        for _ in range(3):  # the first run also compiles
            began = time.perf_counter()
            row = query.first()
            best = min(best, time.perf_counter() - began)
        return best, row["r"], row["n"]

    shared, _, n = timed(lambda ws: F.size(ws) < 0)
    out = []
    for rule in rules:
        seconds, rejected, _ = timed(lambda ws: rejects(rule, shown, ws))  # noqa: B023
        out.append(RuleStats(rule.name, max(seconds - shared, 1e-4) / max(n, 1), rejected / max(n, 1)))
    release(sample)
    return out


def order_rules(rules: Sequence[Rule], stats: Sequence[RuleStats]) -> list[Rule]:
    """Rules by falling rejection per cost; ties keep the declared order."""
    value = {s.name: s.value for s in stats}
    return sorted(rules, key=lambda r: -value[r.name])


def cascade(conditions: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first condition that holds, in the given order; null if none does."""
    out = None
    for name, condition in conditions:
        out = (F if out is None else out).when(condition, F.lit(name))
    return out if out is not None else F.lit(None).cast("string")


def apply_rules(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, columns unchanged.

    Without ``rules``, RULES in the order estimated on ``docs``.
    """
    ordered = order_rules(RULES, estimate(docs, text=text)) if rules is None else rules
    shown = F.coalesce(text, F.lit(""))
    return docs.where(let(words(shown), lambda ws: cascade(
        [(r.name, rejects(r, shown, ws)) for r in ordered])).isNull())


def judge(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text",
          key: str = "doc_id") -> DataFrame:
    """``key``, the counts that the base report wants, and ``rejected_by`` of every row.

    The reported counts are made for every row (words cut once, lines cut once), so
    the rules on them are comparisons; the letter counts are made inside the cascade,
    only for rows that no earlier rule rejects.
    """
    ordered = order_rules(RULES, estimate(docs, text=text)) if rules is None else rules
    shown = F.coalesce(text, F.lit(""))
    named = lambda c, names: F.struct(*[getattr(c, k).alias(k) for k in names])
    rows = docs.select(
        F.col(key).alias("key"), shown.alias("text"),
        let(words(shown), lambda ws: named(text_counts(shown, ws, F.array()), ("n_words", "word_chars", "n_repeat_words"))).alias("w"),
        let(_lines(shown), lambda ls: named(text_counts(shown, F.array(), ls), ("n_lines", "n_dup_lines"))).alias("l"),
        text_counts(shown, F.array(), F.array()).n_symbols.alias("n_symbols"))
    late = text_counts(F.col("text"), F.array(), F.array())
    made = Counts(F.col("w.n_words"), F.col("w.word_chars"), F.col("n_symbols"), F.col("l.n_lines"), F.col("l.n_dup_lines"),
                  F.col("w.n_repeat_words"), late.n_upper, late.n_lower)
    return rows.select(F.col("key").alias(key), *[getattr(made, k).alias(k) for k in REPORTED],
                       cascade([(r.name, r.reject(made)) for r in ordered]).alias("rejected_by"))
