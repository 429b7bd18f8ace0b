"""Rule evaluation: all matches, and the last match that names the event."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.functions.predicates import quoted
from vigilog.functions.timestamps import wall_clock
from vigilog.operators.rate import (
    constant_tests,
    counted_sources,
    edges_of_cells,
    must_count,
    outcome_keys,
    rate_candidates,
    rate_firings,
    rate_outcomes,
    rate_rules,
    with_rate_tests,
)
from vigilog.session import materialize
from vigilog.sources.rules import Rule

# Writes a table under a name and reads it back.
Store = Callable[[DataFrame, str], DataFrame]


def _matched_array(rules: Sequence[Rule], tests: Sequence[str]) -> str:
    """SQL for ``[(rule_ord, rule, rule_severity), …]`` of the rules that hold."""
    rows = ", ".join(
        f"CASE WHEN {test} THEN named_struct('rule_ord', {i}, 'rule', {quoted(r.name)}, 'rule_severity', {_string(r.severity)}) END"
        for i, (r, test) in enumerate(zip(rules, tests))
    )
    return f"array_compact(array({rows}))"


def _only_sources(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Events of the sources that the rules name; all events if some rule names none."""
    sources = {r.source for r in rules}
    return events if None in sources else events.where(F.col("source").isin(sorted(sources)))


def _string(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else quoted(value)


def rule_matches(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All (event, rule) pairs whose conditions on the single event hold; rates are not counted."""
    if not rules:
        return events.select("*", F.lit(0).alias("rule_ord"), F.lit("").alias("rule"), F.lit("").alias("rule_severity")).where(F.lit(False))
    return _only_sources(events, rules).select("*", F.expr(f"inline({_matched_array(rules, [r.condition for r in rules])})"))


def outcomes_of(events: DataFrame, rated: Sequence[Rule]) -> DataFrame:
    """What fires the rate rules."""
    return rate_outcomes(rate_firings(edges_of_cells(rate_candidates(events, rated), rated), rated), rated)


def spread_tests(rules: Sequence[Rule], rated_tests: Sequence[str]) -> list[str]:
    """Tests of the rate rules at their places among all rules."""
    remaining = iter(rated_tests)
    return ["true" if r.rate is None else next(remaining) for r in rules]


def all_matches(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All (event, rule) pairs whose conditions hold, rates included."""
    if not rules:
        return rule_matches(events, rules)
    columns, rated = events.columns, rate_rules(rules)
    joined, tests = _only_sources(events, rules), constant_tests(rated)
    if must_count(rated):
        # where every rule has a rate to be counted, only events with an outcome can match
        how = "inner" if len(rated) == len(rules) and "true" not in tests else "left"
        joined, tests = with_rate_tests(joined, outcomes_of(joined, rated), rated, how=how)
    full = [f"{r.condition} AND {t}" for r, t in zip(rules, spread_tests(rules, tests))]
    return joined.select(*columns, F.expr(f"inline({_matched_array(rules, full)})"))


def last_match(rules: Sequence[Rule], held: Sequence[str], keep: Callable[[Rule], bool] = lambda r: True) -> str:
    """SQL for the position of the last rule that holds, NULL if none.

    Rules are grouped by the source they ask for, so an event is only tried
    against the rules that can match it, last rule first.
    """
    def chain(numbers: Sequence[int]) -> str:
        cases = " ".join(f"WHEN {rules[i].condition_in_source} AND {held[i]} THEN {i}" for i in reversed(numbers))
        return f"CASE {cases} END" if cases else "CAST(NULL AS INT)"

    kept = [i for i, r in enumerate(rules) if keep(r)]
    sources = sorted({rules[i].source for i in kept} - {None})
    anywhere = chain([i for i in kept if rules[i].source is None])
    if not sources:
        return anywhere
    branches = " ".join(f"WHEN {quoted(s)} THEN {chain([i for i in kept if rules[i].source in (None, s)])}" for s in sources)
    return f"CASE source {branches} ELSE {anywhere} END"


def _lookup(position: str, values: Sequence[str | None]) -> str:
    return f"get(array({', '.join(map(_string, values))}), {position})"


def apply_rules(events: DataFrame, rules: Sequence[Rule], held: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Name and severity from the last match; a rule without severity leaves the one before it."""
    severities = [r.severity for r in rules]
    ranked = events.select("*", F.expr(last_match(rules, held)).alias("_rule"))
    severity = "_rule"
    if None in severities:
        severity = "_sev"
        ranked = ranked.select("*", F.expr(last_match(rules, held, lambda r: r.severity is not None)).alias(severity))
    changed = {
        "rule_triggered": _lookup("_rule", [r.name for r in rules]),
        "severity": f"coalesce({_lookup(severity, severities)}, severity)",
    }
    return ranked.select(*[F.expr(changed[c]).alias(c) if c in changed else c for c in columns])


# Outcomes that are broadcast: rows and the places listed in them, about 20 bytes each.
LIGHT_OUTCOMES = 500_000
# Bits of the filter on the keys of outcomes: 4 MB, whatever their number.
FILTER_BITS = 1 << 25


def _weight(outcomes: DataFrame) -> int:
    listed = [F.size(c) for c in outcomes.columns if c.startswith("_at")]
    return outcomes.agg(F.sum(sum(listed, F.lit(1)))).first()[0] or 0


def _slot_of_key() -> Column:
    return F.pmod(F.xxhash64("_ip", "_bucket"), F.lit(FILTER_BITS))


def _filter_words(outcomes: DataFrame) -> DataFrame:
    """One row with the bits of all outcome keys, 64 a number."""
    slots = outcomes.select(_slot_of_key().alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("id")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("word"))
    every = outcomes.sparkSession.range(FILTER_BITS // 64).join(words, "id", "left").select("id", F.coalesce("word", F.lit(0).cast("long")).alias("word"))
    return every.agg(F.sort_array(F.collect_list(F.struct("id", "word")))["word"].alias("words"))


def _may_fire(outcomes: DataFrame, store: Store = materialize) -> Column:
    """Whether an event's outcome key may be there: no false no, a false yes as often as the filter is full."""
    words = store(_filter_words(outcomes), "filter").scalar()
    slot = _slot_of_key()
    word = F.element_at(words, (F.shiftright(slot, 6) + 1).cast("int"))
    return F.call_function("shiftrightunsigned", word, slot.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1


def decide(
    events: DataFrame, rules: Sequence[Rule], outcomes: DataFrame, columns: Sequence[str], clock: str = "ts", store: Store | None = None
) -> DataFrame:
    """``events`` with the last rule that holds, given what fires the rate rules.

    Events of sources that no rate counts are not joined, so they are in no shuffle. With
    a ``store``, which writes a table and reads it back, the outcomes are written first: they
    are broadcast if they are few; else a filter on their keys keeps all other events out of
    the join, too.
    """
    rated = rate_rules(rules)
    if store is not None:
        outcomes = store(outcomes, "outcomes")
    if store is not None and _weight(outcomes) <= LIGHT_OUTCOMES:
        joined, tests = with_rate_tests(events, F.broadcast(outcomes), rated, clock)
        return apply_rules(joined, rules, spread_tests(rules, tests), columns)
    sources = counted_sources(rated)
    loud = F.lit(True) if sources is None else F.coalesce(F.col("source").isin(sources), F.lit(False))
    keyed = events
    if store is not None:
        keyed = outcome_keys(events, rated, clock)
        loud = loud & _may_fire(outcomes, store)
    joined, tests = with_rate_tests(keyed.where(loud).select(*events.columns), outcomes, rated, clock)
    decided = apply_rules(joined, rules, spread_tests(rules, tests), columns)
    if sources is None and store is None:
        return decided
    silent = ["false" if t not in ("true", "false") else t for t in tests]
    quiet = apply_rules(keyed.where(~loud).select(*events.columns), rules, spread_tests(rules, silent), columns)
    return decided.unionByName(quiet)


def detect_events(events: DataFrame, rules: Sequence[Rule], staged: bool = False) -> DataFrame:
    """Events with ``rule_triggered`` and ``severity`` set by the last rule that matches.

    With ``staged``, what fires the rate rules is found and written first. Its size
    is then known: if it is small, the events, with their long raw lines, are not
    shuffled at all; if not, only those that may fire are.
    """
    if not rules:
        return events.withColumn("rule_triggered", F.lit(None).cast("string"))
    columns = events.columns if "rule_triggered" in events.columns else [*events.columns, "rule_triggered"]
    rated = rate_rules(rules)
    if not must_count(rated):
        return apply_rules(events, rules, spread_tests(rules, constant_tests(rated)), columns)
    outcomes = outcomes_of(events, rated)
    return decide(events, rules, outcomes, columns, store=materialize if staged else None)


def detect_between(events: DataFrame, rules: Sequence[Rule], start: datetime, end: datetime) -> DataFrame:
    """Detection for ``start <= ts <= end`` only; reads no more than that and the longest rate window before it."""
    context = timedelta(seconds=max([r.rate[1] for r in rate_rules(rules)], default=0))
    in_reach = events.where((F.col("ts") >= wall_clock(start - context)) & (F.col("ts") <= wall_clock(end)))
    return detect_events(in_reach, rules).where(F.col("ts") >= wall_clock(start))


def detect_versions(events: DataFrame, versions: Sequence[tuple[datetime | None, Sequence[Rule]]], staged: bool = False) -> DataFrame:
    """Detection by rules that change: each event is judged by the version in force at its time.

    ``versions`` are (time from which it holds, rules) in order, None the beginning. A
    version reads its own time and the longest of its rate windows before it. Events
    before the first version are judged by no rule.
    """
    if not versions or versions[0][0] is not None:
        versions = [(None, []), *versions]
    ends = [start for start, _ in versions[1:]] + [None]
    parts = []
    for (start, rules), end in zip(versions, ends):
        context = timedelta(seconds=max([r.rate[1] for r in rate_rules(rules)], default=0))
        own = events if end is None else events.where(F.col("ts") < wall_clock(end))
        own = own if start is None else own.where(F.col("ts") >= wall_clock(start - context))
        found = detect_events(own, rules, staged)
        parts.append(found if start is None else found.where(F.col("ts") >= wall_clock(start)))
    return reduce(DataFrame.unionByName, parts)


def rate_detection(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Every event that fires a rate rule: ``(rule, seq, ts, ip)`` plus event columns."""
    return all_matches(events, rate_rules(rules))


def detections_by_ip(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Offenders: how often each address fired each rate rule, and when first and last."""
    return rate_detection(events, rules).groupBy("ip", "rule").agg(
        F.count("*").alias("firings"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


def detection_mitre(detected: DataFrame, rules: DataFrame) -> DataFrame:
    """Detected events with id and technique of their rule."""
    dimension = rules.select(F.col("name").alias("rule_triggered"), "rule_id", "mitre_id", "mitre_tactic")
    return detected.join(dimension, "rule_triggered", "left")
