"""Rate conditions against a plain simulation, and the plans that keep them scalable."""

import random
from collections import defaultdict, deque
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from test_rules import make_events
from vigilog import Rule, detect_events
from vigilog.operators import detect
from vigilog.operators.detect import all_matches
from vigilog.operators.rate import SLOT_CELLS, edges_of_cells, outcome_keys, rate_candidates

START = datetime(2026, 5, 1, 22, 59, 30)


def rate_rule(name, threshold, window, **conditions):
    return Rule(name, "CRITICAL", {**conditions, "rate": {"threshold": threshold, "window_seconds": window}})


def simulate(events, rules, holds):
    """One queue of times per rule and address, events in (time, seq) order."""
    queues, fired = defaultdict(deque), set()
    for seq, ts, ip, action in sorted(events, key=lambda e: (e[1], e[0])):
        for rule in rules:
            if holds(rule, action):
                threshold, window = rule.rate
                queue = queues[rule.name, ip]
                queue.append(ts)
                while queue and queue[0] < ts - timedelta(seconds=window):
                    queue.popleft()
                if len(queue) >= threshold:
                    fired.add((seq, rule.name))
    return fired


def check(spark, events, rules):
    frame = make_events(spark, *[dict(seq=s, ts=t, ip=ip, action=a) for s, t, ip, a in events])
    actual = {(r.seq, r.rule) for r in all_matches(frame, rules).select("seq", "rule").collect()}
    expected = simulate(events, rules, lambda rule, action: rule.conditions.get("action") in (None, action))
    assert actual == expected
    return expected


@pytest.mark.parametrize("unit", [1, 0.25, 0.000001], ids=["seconds", "fractions", "micros"])
def test_random_events(spark, unit):
    rng = random.Random(7)
    span = 400 if unit >= 0.25 else 90_000_000
    events = [
        (seq, START + timedelta(seconds=rng.randrange(span) * unit), rng.choice(["a", "a", "a", "b", None]), rng.choice(["x", "y"]))
        for seq in rng.sample(range(10_000), 1500)
    ]
    rules = [
        rate_rule("r5_60", 5, 60, action="x"), rate_rule("r10_30", 10, 30, action="x"), rate_rule("r40_10", 40, 10),
        rate_rule("r3_1", 3, 1, action="y"), rate_rule("r2_0", 2, 0), rate_rule("r1_5", 1, 5, action="y"),
    ]
    assert check(spark, events, rules)


def test_closed_window_and_repeated_firing(spark):
    events = [(i, START + timedelta(seconds=s), "a", "x") for i, s in enumerate([0, 30, 60, 61, 90, 121, 300])]
    fired = check(spark, events, [rate_rule("three", 3, 60)])
    assert {seq for seq, _ in fired} == {2, 3, 4, 5}


def test_addresses_are_counted_apart_and_missing_ones_together(spark):
    events = [(i, START, ip, "x") for i, ip in enumerate(["a", "b", None, "a", None, "b", None])]
    assert check(spark, events, [rate_rule("three", 3, 60)]) == {(6, "three")}


def test_one_instant_holds_most_events(spark):
    """More events of one address in one instant than any threshold, some of them above the pre-shuffle limit."""
    events = [(i, START + timedelta(seconds=i // 3000), "a", "x") for i in range(4500)]
    fired = check(spark, events, [rate_rule("small", 5, 10), rate_rule("large", 1200, 10), rate_rule("huge", 4400, 1)])
    assert sum(name == "huge" for _, name in fired) == 101


def test_slot_borders(spark):
    """Bursts around every border of the time slots."""
    width, rng = 8 * 10, random.Random(3)
    base = datetime(1970, 1, 1) + timedelta(seconds=width * 22_000_000)
    events = [(i, base + timedelta(seconds=width * rng.randrange(-2, 3) + rng.choice([-10, -9, -1, 0, 1, 9, 10, 11])), "a", "x") for i in range(300)]
    assert check(spark, events, [rate_rule("r", 6, 10), rate_rule("s", 25, 10)])


def test_times_before_1970(spark):
    events = [(i, datetime(1969, 12, 31, 23, 59, 50) + timedelta(seconds=i), "a", "x") for i in range(20)]
    assert check(spark, events, [rate_rule("r", 4, 3)])


def plan(frame, mode="formatted"):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_candidates_are_limited_before_the_shuffle(spark):
    text = plan(detect_events(make_events(spark, dict(ip="a")), [rate_rule("r", 5, 60)]))
    partial = [line for line in text.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert partial


def test_hot_instant_is_split_in_the_join(spark):
    """With the event side skewed, adaptive execution splits it; results stay whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    rows = spark.range(60_000).selectExpr(
        "id AS seq", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('ip', id % 500) END AS ip",
        "TIMESTAMP_NTZ'2026-05-01 00:00:00' + make_dt_interval(0, 0, 0, CASE WHEN id % 3 = 0 THEN 0 ELSE id DIV 1000 END) AS ts",
        "'auth' AS source", "'x' AS action", "CAST(NULL AS STRING) AS rule_triggered", "'INFO' AS severity", "repeat(uuid(), 3) AS raw",
    ).repartition(8)
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = detect_events(rows, [Rule("r", "CRITICAL", {"action": "x", "rate": {"threshold": 100, "window_seconds": 10}})])
        out = found.select("seq", "ip", "raw", "rule_triggered").toPandas()
        assert len(out) == 60_000
        assert (out[out.ip == "hot"].rule_triggered == "r").sum() == 20_000 - 99
        final = found.select("seq", "ip", "raw", "rule_triggered")
        final.collect()
        assert "skew=true" in plan(final)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_groups_are_cut_by_number(spark):
    """Stamps of microseconds and no address, under a rated rule of a source without addresses: no window group outgrows the bound."""
    rule = Rule("burst", "CRITICAL", {"source": "fim", "rate": {"threshold": 5, "window_seconds": 10}})
    rows = spark.range(40_000).selectExpr(
        "id AS seq", "CAST(NULL AS STRING) AS ip", "'fim' AS source", "'modified' AS action", "'INFO' AS severity",
        "TIMESTAMP_NTZ'2026-05-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(id * 0.000731 AS DECIMAL(18, 6))) AS ts",
    )
    edges = edges_of_cells(rate_candidates(rows, [rule]), [rule]).distinct()
    per_cell = edges.groupBy("rule_no", "ip_key", F.shiftright("us", 23)).count()
    per_slot = edges.groupBy("rule_no", "ip_key", F.shiftright("us", 27)).count()
    assert per_cell.agg(F.max("count")).first()[0] == 2 * 5 and per_slot.agg(F.max("count")).first()[0] <= 2 * 5 * SLOT_CELLS
    found = {r.seq for r in all_matches(rows, [rule]).select("seq").collect()}
    assert found == set(range(4, 40_000))
    assert {r.seq for r in detect_events(rows, [rule]).where("rule_triggered = 'burst'").collect()} == found


def test_bursts_between_idle_times(spark):
    """Dense and sparse cells in turn, thresholds above and below what a cell holds, windows of very different length."""
    rng = random.Random(11)
    events, at = [], START
    for burst in range(25):
        at += timedelta(seconds=rng.choice([0.4, 3, 9, 31, 200]))
        for _ in range(rng.choice([1, 3, 30, 60])):
            at += timedelta(microseconds=rng.choice([0, 1, 300, 40_000, 700_000]))
            events.append((len(events), at, rng.choice(["a", "a", None]), rng.choice(["x", "y"])))
    rng.shuffle(events)
    rules = [rate_rule("n1_30", 1, 30), rate_rule("n4_1", 4, 1, action="x"), rate_rule("n7_0", 3, 0), rate_rule("n25_10", 25, 10), rate_rule("n90_600", 90, 600)]
    assert check(spark, events, rules)


MIXED = [
    Rule("drops", "CRITICAL", {"source": "firewall", "rate": {"threshold": 3, "window_seconds": 10}}),
    Rule("deleted", "WARNING", {"source": "fim", "action": "deleted"}),
]


def mixed_events(spark, count=3000):
    rng = random.Random(2)
    rows = [
        dict(source=rng.choice(["firewall", "fim", "syslog", "fim"]), ip=f"ip{rng.randrange(400)}", action=rng.choice(["deleted", "x"]), ts=START + timedelta(seconds=rng.randrange(900)))
        for _ in range(count)
    ]
    rows += [dict(source=s, ts=START) for s in (None, "firewall", "firewall", "firewall")]
    return make_events(spark, *rows)


def exchanged(frame):
    """What feeds each shuffle, as text of the plan before execution."""
    text = frame._jdf.queryExecution().executedPlan().toString()
    lines, parts = text.splitlines(), []
    for k, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            depth = line.index("Exchange")
            below = []
            for other in lines[k + 1 :]:
                if len(other) - len(other.lstrip(" :+-*(0123456789)")) <= depth:
                    break
                below.append(other)
            parts.append("\n".join(below))
    return parts


def test_sources_without_rates_are_in_no_shuffle(spark):
    events = mixed_events(spark)
    wanted = sorted((r.seq, r.rule_triggered, r.severity) for r in detect_events(events, MIXED, staged=True).collect())
    frame = detect_events(events, MIXED)
    assert sorted((r.seq, r.rule_triggered, r.severity) for r in frame.collect()) == wanted and len(wanted) == events.count()
    assert len({w[1] for w in wanted}) == 3
    parts = exchanged(detect_events(events, MIXED).select("raw", "rule_triggered"))
    assert parts and all("source" in p and "firewall" in p for p in parts)


def test_other_rows_pass_the_filter_first(spark, monkeypatch):
    """Outcomes too many for a broadcast: only rows whose key may be among theirs are joined; results stay whole."""
    events = mixed_events(spark)
    wanted = sorted((r.seq, r.rule_triggered) for r in detect_events(events, MIXED).collect())
    monkeypatch.setattr(detect, "LIGHT_OUTCOMES", 0)
    frame = detect_events(events, MIXED, staged=True)
    assert sorted((r.seq, r.rule_triggered) for r in frame.collect()) == wanted
    outcomes = detect.outcomes_of(events, MIXED[:1])
    keyed = outcome_keys(events.where("source = 'firewall'"), MIXED[:1])
    may = keyed.where(detect._may_fire(outcomes)).count()
    exact = keyed.join(outcomes.select("_ip", "_bucket"), ["_ip", "_bucket"], "left_semi").count()
    assert exact <= may <= exact + 5 and may < keyed.count() / 2
    for bits in (64, 128):  # a filter that is full says yes too often, and never a wrong no
        monkeypatch.setattr(detect, "FILTER_BITS", bits)
        assert sorted((r.seq, r.rule_triggered) for r in detect_events(events, MIXED, staged=True).collect()) == wanted


def test_rate_only_sets_join_inner(spark):
    frame = all_matches(mixed_events(spark), MIXED[:1])
    assert "Inner" in plan(frame) and "LeftOuter" not in plan(frame)
