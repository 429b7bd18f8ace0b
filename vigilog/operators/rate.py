"""Rate conditions: at least N candidates of one (rule, ip) in the closed last W seconds.

An event fires iff the candidate N-1 places before it, in (time, seq) order, is
not older than W seconds. Time is cut into cells no longer than W, and three
facts keep this exact and every group small, whatever the stamps:

* From the N-th candidate of a cell on, all of the cell fire: N of them lie
  within W. So only the first N must be decided one by one.
* What a later cell can reach back to are the last N-1 candidates of a cell. So
  the first and last N of every (rule, ip, cell) stand for all; they are found
  by ``row_number() <= N``, which Spark plans as a limit in each task, before
  the shuffle.
* Whether an event fires depends on the last W seconds only. SLOT_CELLS cells
  form a slot, and rows of a slot's last W seconds are copied into the next
  one, where they serve as context.

A window group has at most 2 N rows for each of SLOT_CELLS + 3 cells: it is cut by
number, not by the resolution of the stamps or the share of one address. Cells
are powers of two of microseconds, so those of different rules nest.

The outcome is one row for an (ip, bucket), the bucket being the shortest cell:
for each rule the place from which on all fire, and the places before it that do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.functions.timestamps import epoch_micros
from vigilog.sources.rules import Rule

_SLOT_BITS = 4
SLOT_CELLS = 1 << _SLOT_BITS
# Spark limits groups before the shuffle only below this many rows per group
# (default of spark.sql.optimizer.windowGroupLimitThreshold).
_GROUP_LIMIT = 1000
_SPREAD = 64
_SECOND = 1_000_000
_MOST_CELL_BITS = 55
# of a bucket: further join key, see with_rate_tests
_COARSE_BITS = 4


def rate_rules(rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if r.rate is not None]


def must_count(rules: Sequence[Rule]) -> bool:
    """Whether the outcome of any rate depends on the events."""
    return any(_always(r) is None for r in rules)


def constant_tests(rules: Sequence[Rule]) -> list[str]:
    """Tests of rates of which none must be counted."""
    return [str(_always(r)).lower() for r in rules]


# Events without an address share one bucket, named None.
_IP_KEY = "coalesce(ip, 'None')"


def _always(rule: Rule) -> bool | None:
    """Outcome of a degenerate rate: nothing to count, or no time to count in."""
    threshold, window = rule.rate
    if threshold <= 0:
        return True
    return False if window < 0 else None


def _per_rule(values: Sequence[int], kind: str = "BIGINT") -> str:
    """SQL for the value that belongs to ``rule_no``."""
    return f"element_at(array({', '.join(f'CAST({v} AS {kind})' for v in values)}), rule_no + 1)"


def _cell_bits(rule: Rule) -> int:
    """log2 of the cell in microseconds: the longest that fits into the window; an instant for a window of 0."""
    return min(max(rule.rate[1] * _SECOND, 1).bit_length() - 1, _MOST_CELL_BITS)


def _bucket_bits(rules: Sequence[Rule]) -> int:
    """The shortest cell that is longer than an instant."""
    return min((_cell_bits(r) for r in rules if _always(r) is None and r.rate[1] > 0), default=_SECOND.bit_length())


def counted_sources(rules: Sequence[Rule]) -> list[str] | None:
    """Sources whose events the rates must count; None stands for all."""
    sources = {r.source for r in rules if _always(r) is None}
    return None if None in sources else sorted(sources)


def rate_candidates(events: DataFrame, rules: Sequence[Rule], clock: str = "ts") -> DataFrame:
    """``(rule_no, ip_key, us, seq)`` of events that meet the other conditions of a rate rule."""
    counted = [(i, r) for i, r in enumerate(rules) if _always(r) is None]
    sources = counted_sources(rules)
    if sources is not None:
        # reaches the scan: other sources are neither read (partitioned table) nor parsed (raw lines)
        events = events.where(F.col("source").isin(sources))
    hits = ", ".join(f"CASE WHEN {r.condition} THEN {i} END" for i, r in counted)
    return events.select(
        F.expr(f"explode(array_compact(array({hits})))").alias("rule_no"),
        F.expr(_IP_KEY).alias("ip_key"),
        epoch_micros(clock).alias("us"),
        "seq",
    )


def edges_of_cells(candidates: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The first N and the last N candidates of every (rule, ip, cell); one may come twice."""
    thresholds = [r.rate[0] for r in rules]
    limit, columns = max(thresholds), candidates.columns
    cell = f"shiftright(us, {_per_rule([_cell_bits(r) for r in rules], 'INT')}) AS _cell"
    rows = candidates.select(*columns, F.explode(F.array(F.lit(1), F.lit(-1))).alias("way")).selectExpr("*", cell, "way * us AS at", "way * seq AS place")

    def head(df: DataFrame, *by: Column) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("rule_no", "ip_key", "_cell", "way", *by).orderBy("at", "place"))
        kept = f"_rank <= {limit} AND _rank <= {_per_rule(thresholds)}"
        return df.select("*", rank.alias("_rank")).where(kept).drop("_rank")

    if limit >= _GROUP_LIMIT:
        rows = head(rows, F.pmod(F.xxhash64("seq"), F.lit(_SPREAD)))
    return head(rows).select(columns)


def rate_firings(edges: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule_no, ip_key, us, seq, rank, last): those of the first N of a cell that fire, their rank, and the cell's last time."""
    bits = [_cell_bits(r) for r in rules]
    cell_bits, slot_bits = (_per_rule([b + more for b in bits], "INT") for more in (0, _SLOT_BITS))
    window_us = _per_rule([max(r.rate[1], 0) * _SECOND for r in rules])
    reach = f"us >= shiftleft(_own + 1, {slot_bits}) - {window_us}"
    placed = (
        edges.select("*", F.expr(f"shiftright(us, {cell_bits})").alias("_cell"), F.expr(f"shiftright(us, {slot_bits})").alias("_own"))
        .select("*", F.expr(f"explode(array_compact(array(_own, CASE WHEN {reach} THEN _own + 1 END)))").alias("_slot"))
        .repartition("rule_no", "ip_key", "_slot")  # serves what follows, so that it moves rows once
        .dropDuplicates(["rule_no", "ip_key", "_slot", "us", "seq"])
    )
    # cells follow each other in time, so one sort serves both windows
    by_time = Window.partitionBy("rule_no", "ip_key", "_slot").orderBy("_cell", "us", "seq")
    in_cell = Window.partitionBy("rule_no", "ip_key", "_slot", "_cell")
    counted = [(i, r) for i, r in enumerate(rules) if _always(r) is None]
    distances = sorted({r.rate[0] for _, r in counted})
    lagged = placed.select(
        "*",
        *[F.lag("us", n - 1).over(by_time).alias(f"_lag{n}") for n in distances],
        F.row_number().over(in_cell.orderBy("us", "seq")).alias("rank"),
        F.max("us").over(in_cell).alias("last"),
    )
    nth_before = " ".join(f"WHEN {i} THEN _lag{r.rate[0]}" for i, r in counted)
    fires = f"_slot = _own AND rank <= {_per_rule([r.rate[0] for r in rules])} AND CASE rule_no {nth_before} END >= us - {window_us}"
    return lagged.where(fires).select("rule_no", "ip_key", "us", "seq", "rank", "last")


def rate_outcomes(firings: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(_ip, _bucket, _from0, _at0, …): for each rule the place from which on all fire, and single places that do.

    A cell of several buckets has its open end in each of them, up to its last candidate.
    Of a window of 0 the places are those from which on all of the same instant fire.
    """
    bits = _bucket_bits(rules)
    all_after = f"rank = {_per_rule([r.rate[0] for r in rules])} AND {_per_rule([r.rate[1] for r in rules])} > 0"
    spread = f"explode(sequence(shiftright(us, {bits}), shiftright(CASE WHEN {all_after} THEN last ELSE us END, {bits})))"
    dealt = firings.select("rule_no", F.col("ip_key").alias("_ip"), F.struct("us", "seq").alias("p"), F.expr(all_after).alias("open"), F.expr(spread).alias("_bucket"))
    columns = []
    for i, r in enumerate(rules):
        if _always(r) is None:
            columns.append(F.expr(f"min(CASE WHEN rule_no = {i} AND open THEN p END)").alias(f"_from{i}"))
            columns.append(F.expr(f"collect_list(CASE WHEN rule_no = {i} AND NOT open THEN p END)").alias(f"_at{i}"))
    return dealt.groupBy("_ip", "_bucket").agg(*columns)


def outcome_keys(events: DataFrame, rules: Sequence[Rule], clock: str = "ts") -> DataFrame:
    """``events`` with the key of their outcome.

    The key is never null by its type: else an inner join would test it for null, and the
    test, pushed down, would run the parsing of the time once more for each column.
    """
    micros = F.coalesce(epoch_micros(clock), F.lit(0).cast("long"))
    keyed = events.select("*", F.expr(_IP_KEY).alias("_ip"), micros.alias("_us"))
    return keyed.select("*", F.shiftright("_us", _bucket_bits(rules)).alias("_bucket"))


def with_rate_tests(events: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], clock: str = "ts", how: str = "left") -> tuple[DataFrame, list[str]]:
    """Events joined with their outcomes, and per rate rule the test that the rate holds.

    The join has a coarse time as a further key, which the grouping of the outcomes has
    not. The grouped side is therefore exchanged once more, small as it is, and
    both join inputs are plain exchanges: the form in which adaptive execution
    splits a hot (ip, bucket) of the event side.
    """
    coarse = F.shiftright("_bucket", _COARSE_BITS).alias("_coarse")
    keyed = outcome_keys(events, rules, clock).select("*", coarse)
    joined = keyed.join(outcomes.select("*", coarse), ["_ip", "_bucket", "_coarse"], how)
    return joined, [_test(i, r) for i, r in enumerate(rules)]


def _test(i: int, rule: Rule) -> str:
    if (always := _always(rule)) is not None:
        return str(always).lower()
    if rule.rate[1] == 0:
        return f"coalesce(exists(_at{i}, p -> p.us = _us AND p.seq <= seq), false)"
    after = f"_us > _from{i}.us OR (_us = _from{i}.us AND seq >= _from{i}.seq)"
    return f"(coalesce({after}, false) OR coalesce(array_contains(_at{i}, named_struct('us', _us, 'seq', seq)), false))"
