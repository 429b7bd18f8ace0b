"""Quality rules: a threshold table compiled into one projection of text statistics.

Everything is a Column expression; no user function runs. ``measure`` adds one
statistic column per metric, ``quality_rules`` adds the verdict of the table.

The stop-word and word-length rules fit the languages of ``STOP_WORDS_OF``. They apply where a
text is written in their letters: if more than FOREIGN of its letters are others, both
ratios are null, no rule fails on them, and the text is judged by the other rules. Prose in
a language without a list that uses only these letters may still fail the stop-word rule;
give its words in the table.

Defined cases: a null text counts as empty; an empty text has no words, so all its
counts and ratios are 0 and the base rule rejects it; no text is too long; repeated rows are
judged one by one; columns of the input that bear the name of a result are replaced, all
others are kept under any name; nulls in other columns pass through; an empty table stays
empty.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm.common import WHITE, clash_free

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words, by language.
STOP_WORDS_OF = {
    "en": "the of and to in is that it for on with as was be by this are or an at from",
    "fr": "de la le et les des en un une du que qui pour dans par sur au est avec pas",
    "de": "der die das und zu den mit von ein eine nicht auf für sich dem auch es",
    "es": "el y los se las por con no su para al lo una",
    "it": "di il che è non per della sono un con come più nel alla",
    "pt": "o os as do da dos das em um uma não com mais como ao",
    "nl": "het een van ik dat niet zijn op te met voor er maar ook aan",
    "sv": "och att det som är på av för inte med den till ett har",
    "da": "og at det som er på af for ikke med den til et har",
}
STOP_WORDS = sorted({w for words in STOP_WORDS_OF.values() for w in words.split()})
# Letters of these languages; the share of other letters from which on the rules for them do not apply.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿŒœŸ"
FOREIGN = 0.02


class Rule(NamedTuple):
    """A text passes if ``low <= metric <= high``; a bound of None does not restrict."""

    metric: str
    low: float | None
    high: float | None


THRESHOLDS = (
    Rule("n_words", MIN_WORDS, None),
    Rule("mean_word_chars", 2.5, 12.0),
    Rule("symbol_ratio", None, 0.1),
    Rule("stop_word_ratio", 0.04, None),
    Rule("upper_ratio", None, 0.3),
    Rule("digit_ratio", None, 0.3),
    Rule("dup_line_ratio", None, 0.5),
    Rule("bullet_line_ratio", None, 0.9),
    Rule("ellipsis_line_ratio", None, 0.5),
)


def _words(text: Column) -> Column:
    core = F.btrim(text, F.lit(WHITE))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, "[ \t-\r]+"))


def _with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_repeat_words``: words covered by 3-word windows that occur at least twice.

    A text whose window hashes are all distinct repeats nothing. In the others the windows
    are sorted with their positions, so equal ones are neighbours: n log n in the length
    of the text, whatever it repeats. Words are compared, hashes only order them.
    """
    words, win, hashes, ordered = (F.col(c) for c in ("__words", "__win", "__hash", "__ordered"))
    n = F.size(words)
    windows = F.slice(
        F.arrays_zip(words.alias("a"), F.slice(words, 2, n).alias("b"), F.slice(words, 3, n).alias("c"), F.sequence(F.lit(1), n).alias("at")),
        1,
        F.greatest(n - 2, F.lit(0)),
    )
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    pairs = F.filter(
        F.arrays_zip(ordered.alias("x"), F.slice(ordered, 2, F.size(ordered)).alias("y")),
        lambda p: (p["x"]["h"] == p["y"]["h"])
        & (p["x"]["w"]["a"] == p["y"]["w"]["a"])
        & (p["x"]["w"]["b"] == p["y"]["w"]["b"])
        & (p["x"]["w"]["c"] == p["y"]["w"]["c"]),
    )
    positions = F.flatten(
        F.transform(pairs, lambda p: F.flatten(F.array(*(F.array(*(p[e]["w"]["at"] + i for i in range(3))) for e in "xy"))))
    )
    return (
        docs.withColumn("__win", F.when(n > 3, windows))
        .withColumn("__hash", F.transform(win, lambda w: F.xxhash64(w["a"], w["b"], w["c"])))
        .withColumn("__ordered", F.when(repeats, F.sort_array(F.arrays_zip(hashes.alias("h"), win.alias("w")))))
        .withColumn("n_repeat_words", F.coalesce(F.when(ordered.isNotNull(), F.size(F.array_distinct(positions))), F.lit(0)).cast("long"))
        .drop("__win", "__hash", "__ordered")
    )


def _either(words: list[str]) -> str:
    """A pattern for any of ``words`` that reads each letter once: a prefix tree written as a regular expression."""
    ends, after = "" in words, {}
    for w in filter(None, words):
        after.setdefault(w[0], []).append(w[1:])
    if not after:
        return ""
    branches = [re.escape(first) + _either(rest) for first, rest in sorted(after.items())]
    return ("(?:" + "|".join(branches) + ")") + ("?" if ends else "")


# a stop word after white space, before white space or a mark
_STOP_PATTERN = r"[ \t-\r]" + _either(sorted(set(STOP_WORDS))) + r"(?=[ \t-\r.,;:!?])"


def _without(value: Column, pattern: str) -> Column:
    """Characters of ``value`` that runs of ``pattern`` hold."""
    return (F.length(value) - F.length(F.regexp_replace(value, pattern, ""))).cast("long")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


STATISTICS = (
    "n_repeat_words", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_upper", "n_digits", "n_foreign",
    "n_bullet_lines", "n_ellipsis_lines", "mean_word_chars", "symbol_ratio", "stop_word_ratio", "upper_ratio", "digit_ratio",
    "dup_line_ratio", "bullet_line_ratio", "ellipsis_line_ratio",
)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics that rules may name."""
    safe, names = clash_free(docs)
    kept = [F.col(new).alias(old) for old, new in names.items() if old not in STATISTICS]
    return _measured(safe, names[text]).select(*kept, *STATISTICS)


def _measured(docs: DataFrame, text: str) -> DataFrame:
    value = F.coalesce(F.col(text), F.lit(""))
    words, lines = F.col("__words"), F.col("__lines")
    n_words, n_lines = F.size(words).cast("long"), F.size(lines)
    padded = F.concat(F.lit(" "), F.lower(value), F.lit(" "))
    split = docs.withColumns(
        {
            "__words": _words(value),
            "__lines": F.filter(F.split(value, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != ""),
        }
    )
    counted = _with_repeats(split).withColumns(
        {
            "n_words": n_words,
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": _without(value, "[#*$%&|<>]+"),
            "n_lines": n_lines.cast("long"),
            "n_dup_lines": (n_lines - F.size(F.array_distinct(lines))).cast("long"),
            "n_stop_words": F.regexp_count(padded, F.lit(_STOP_PATTERN)).cast("long"),
            "n_upper": _without(value, "[A-Z]+"),
            "n_digits": _without(value, "[0-9]+"),
            "n_foreign": _without(value, rf"[\p{{L}}&&[^{LETTERS}]]+"),
            "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^[ \t-\r]*[-*•]"))).cast("long"),
            "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.endswith("...") | x.endswith("…"))).cast("long"),
        }
    )
    listed = F.col("n_foreign") <= FOREIGN * F.col("word_chars")
    return counted.drop("__words", "__lines").withColumns(
        {
            "mean_word_chars": F.when(listed, _ratio(F.col("word_chars"), F.col("n_words"))),
            "symbol_ratio": _ratio(F.col("n_symbols"), F.col("n_words")),
            "stop_word_ratio": F.when(listed, _ratio(F.col("n_stop_words"), F.col("n_words"))),
            "upper_ratio": _ratio(F.col("n_upper"), F.col("word_chars")),
            "digit_ratio": _ratio(F.col("n_digits"), F.col("word_chars")),
            "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
            "bullet_line_ratio": _ratio(F.col("n_bullet_lines"), F.col("n_lines")),
            "ellipsis_line_ratio": _ratio(F.col("n_ellipsis_lines"), F.col("n_lines")),
        }
    )


def compile_rules(rules: tuple[Rule, ...] = THRESHOLDS) -> dict[str, Column]:
    """The table as a Column for each rule: true where it fails."""
    failed = {}
    for r in rules:
        tests = [F.col(r.metric) < r.low] if r.low is not None else []
        tests += [F.col(r.metric) > r.high] if r.high is not None else []
        if tests:
            failed[r.metric] = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    return failed


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = THRESHOLDS, text: str = "text") -> DataFrame:
    """``docs`` with statistics, ``base_failed``, ``failed_rules`` (array of metric names) and ``kept``."""
    results = ("base_failed", "failed_rules", "kept")
    measured = measure(docs.drop(*(r for r in results if r != text)), text)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    names = [F.when(test, F.lit(metric)) for metric, test in compile_rules(rules).items()]
    failed = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return measured.withColumns({"base_failed": base, "failed_rules": failed}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = THRESHOLDS) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only.

    Rows go through an explode of one element or none: a filter would be pushed below the
    statistics, and every rule would then compute its own from the text.
    """
    safe, names = clash_free(docs)
    passed = F.when(F.col("kept"), F.array(F.lit(True)))
    kept = quality_rules(safe, rules, text=names["text"]).select(*names.values(), F.explode(passed).alias("passed"))
    return kept.select(*(F.col(new).alias(old) for old, new in names.items()))
