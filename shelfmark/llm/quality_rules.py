"""Quality rules: a table of thresholds compiled into one projection over built-in functions.

Each text is measured once (words, symbols, lines, stop words, repeated windows); a
rule is a ratio of two measures with a lower and an upper bound. All rules become
one boolean expression of the same projection: no shuffle, no user function.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import SPACE, WORD, free_name, without

# Words of a window whose repetition counts.
WINDOW = 8

# Frequent function words of the languages served.
STOP_WORDS = (
    "the of and to in is that it for on with as was be by this are from or an at have not you he she "
    "der die das und ist nicht ein eine zu den von mit auf für im dem des sich auch als "
    "le la les de des et en un une du que qui pour dans est pas sur au par plus "
    "el los las y que en un una por con para es del se lo no su al como"
).split()


class Rule(NamedTuple):
    """Keeps a text whose ``above / below`` lies within the bounds (``None``: open)."""

    name: str
    above: str
    below: str
    least: float | None
    most: float | None


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 12.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    Rule("stop_word_share", "n_stop_words", "n_words", 0.02, None),
    Rule("capital_share", "n_capitals", "word_chars", None, 0.4),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", None, 0.5),
    Rule("repeated_word_share", "n_repeat_words", "n_words", None, 0.3),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window found twice or more; windows are compared by a 64-bit hash within one text."""
    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
            return F.sort_array(F.transform(same, lambda x: x["i"]))

        def total(p: Column) -> Column:
            steps = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
                      let(let(ordered, places), total)).otherwise(F.lit(0).cast("long"))

    def windows(numbers: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(numbers) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(numbers, i, WINDOW)))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > WINDOW, let(let(hashed, windows), covered)).otherwise(F.lit(0).cast("long"))


def measures(text: Column) -> Column:
    """All measures of one text as a struct; a null text has no words."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, f"[{SPACE}]+"), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD))
    stops = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})

    def counted(w: Column, n: Column, t: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
            (F.size(n) - F.size(F.array_distinct(n))).cast("long").alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            F.size(n).cast("long").alias("n_lines"),
            F.size(F.filter(w, lambda x: x.isin(stops))).cast("long").alias("n_stop_words"),
            (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}", ""))).cast("long").alias("n_capitals"),
        )

    return let(whole, lambda t: let(words, lambda w: let(lines, lambda n: counted(w, n, t))))


def passes(rule: Rule, measure: Callable[[str], Column]) -> Column:
    ratio = measure(rule.above) / F.greatest(measure(rule.below), F.lit(1))
    tests = [ratio >= rule.least] if rule.least is not None else []
    tests += [ratio <= rule.most] if rule.most is not None else []
    return tests[0] if len(tests) == 1 else tests[0] & tests[1]


def judge(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, rules: tuple[Rule, ...] = RULES,
          min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """Adds the measures of each whole text, ``base_failed``, ``failed_rules`` and ``kept``.

    A null or empty text has measures of zero and fails; repeated rows are judged
    alike; ids and further columns are never looked at.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_capitals")
    added = {*names, "base_failed", "failed_rules", "kept"}
    carried = [F.col(f"`{c}`") for c in without(keep or df.columns, added)]
    own = free_name(df.columns, "_measures")
    measured = df.select(*carried, measures(F.col(f"`{text_col}`")).alias(own))

    def measure(name: str) -> Column:
        return F.col(own)[name]

    base_failed = (measure("n_words") < min_words) | (100 * measure("n_repeat_words") > max_repeat_percent * measure("n_words"))
    failed = F.concat_ws(",", *[F.when(~passes(rule, measure), F.lit(rule.name)) for rule in rules])
    return measured.select(
        *carried, *[measure(n).alias(n) for n in names], base_failed.alias("base_failed"), failed.alias("failed_rules"),
        (~base_failed & (failed == "")).alias("kept"))
