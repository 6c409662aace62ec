"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule rejects a text.  Its cost and the share it rejects are estimated on a sample, and the
rules are evaluated in the order of rejections per second: a text that one rule rejects does not
reach the next.  The order changes the work, never the verdict.

Words are ``[^\\x20\\x09-\\x0D]+``.  A NULL text has no words; an empty or NULL text is rejected by
``too_short``.  Rows are judged one by one, so repeated rows get the same verdict, an empty table
gives an empty table, and other columns of the input pass through untouched.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.llm.common import bounded_sample, let, window_hashes

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 0.30
SAMPLE_ROWS = 2_000
"""Rows on which cost and selectivity of the rules are estimated."""


@dataclass(frozen=True)
class Rule:
    """A text is rejected where ``fails`` is true."""

    name: str
    fails: Column


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def repeated_positions(tokens: Column, width: int = WINDOW) -> Column:
    """Number of words inside windows of ``width`` words (a power of two) that the text holds twice
    or more.

    Windows are hashed; equal hashes are found by sorting, so the work is linear in the words but
    for that sort.
    """

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts,
            lambda p, k: F.coalesce(F.least(F.get(starts, k + 1) - p, F.lit(width)), F.lit(width)),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def twice(ordered: Column) -> Column:
        return F.filter(
            ordered,
            lambda x, k: F.coalesce(F.get(ordered, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ordered, k + 1)["h"] == x["h"], F.lit(False)),
        )

    def from_windows(windows: Column) -> Column:
        pairs = F.array_sort(
            F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        starts = let(pairs, lambda s: F.array_sort(F.transform(twice(s), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(starts, covered)
        )

    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    return let(window_hashes(hashes, width), from_windows).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(
        F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    )
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_line_share(text: Column) -> Column:
    lines = F.filter(
        F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    )
    return let(
        lines, lambda x: 1 - F.size(F.array_distinct(x)) / F.greatest(F.size(x), F.lit(1))
    )


def char_count(text: Column, pattern: str) -> Column:
    """Code points of the text that match ``pattern``, a class of single characters."""
    whole = F.coalesce(text, F.lit(""))
    return (F.length(whole) - F.length(F.regexp_replace(whole, pattern, ""))).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")).cast("long")


def symbols(text: Column) -> Column:
    return char_count(text, r"[#*$%&|<>]")


def stutter(text: Column) -> Column:
    """Share of words that equal the word before them."""

    def share(tokens: Column) -> Column:
        again = F.filter(
            tokens, lambda w, i: F.coalesce(F.get(tokens, i - 1) == w, F.lit(False))
        )
        return F.size(again) / F.greatest(F.size(tokens), F.lit(1))

    return let(words(text), share)


def default_rules(text: Column) -> list[Rule]:
    """Rules for running text in any language; the limits leave ordinary prose alone."""
    count = F.size(words(text))
    return [
        Rule("too_short", count < MIN_WORDS),
        Rule(
            "repeated_passages",
            let(
                words(text),
                lambda w: F.lit(100) * repeated_positions(w)
                > F.lit(round(100 * MAX_REPEATED)) * F.size(w),
            ),
        ),
        Rule("symbols", symbols(text) * 10 > count),
        Rule("repeated_lines", repeated_line_share(text) > 0.4),
        Rule("stutter", stutter(text) > 0.2),
        Rule(
            "shouting",
            F.lit(2) * char_count(text, r"\p{Lu}")
            > F.greatest(char_count(text, r"\p{L}"), F.lit(1)),
        ),
    ]


def ordered_by_yield(
    df: DataFrame, rules: list[Rule], rows: int = SAMPLE_ROWS
) -> list[tuple[Rule, float, float]]:
    """Rules by rejections per second, with seconds and rejected share on a bounded sample."""
    sample = bounded_sample(df, rows, *_hashable(df)).cache()
    try:
        size = max(sample.count(), 1)
        sample.count()  # the sample is in memory from here on
        measured = []
        for rule in rules:
            begin = time.perf_counter()
            hits = sample.agg(F.count_if(rule.fails)).first()[0]
            measured.append((rule, time.perf_counter() - begin, hits / size))
    finally:
        sample.unpersist()
    return sorted(measured, key=lambda m: (-m[2] / max(m[1], 1e-9), m[0].name))


def _hashable(df: DataFrame) -> list[str]:
    return [f"`{n.replace('`', '``')}`" for n, t in df.dtypes if "map<" not in t][:8]


def rejected_by(rules: list[Rule]) -> Column:
    """First rule in the given order that rejects, NULL if none does; later ones are not run."""
    verdict: Column | None = None
    for rule in rules:
        fails = F.coalesce(rule.fails, F.lit(False))
        verdict = F.when(fails, rule.name) if verdict is None else verdict.when(fails, rule.name)
    return F.lit(None).cast("string") if verdict is None else verdict


def cascade(df: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> Column:
    """Name of the rejecting rule, the rules in the order that a sample of ``df`` gives."""
    rules = default_rules(F.col(text)) if rules is None else rules
    return rejected_by([m[0] for m in ordered_by_yield(df.select(text), rules)])


def keep_good(df: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """Rows that no rule rejects."""
    return df.where(cascade(df, text, rules).isNull())
