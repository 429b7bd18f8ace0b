"""Counters, series and listings on small tables, and registered queries against SQL."""

from datetime import datetime, timedelta

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracle import compare
from test_rules import make_events
from vigilog.operators import metrics, search, stats, timeline

NOON = datetime(2026, 5, 1, 12)
SF_DIR = "/root/testdata/sf0.001"

# one query of each kind; tests/check_oracle.py runs all of them
SAMPLE = [
    "normalize_events", "detect_events", "detections_by_ip", "running_totals", "timeline_10s", "timeline_last_90",
    "event_rate_by_severity", "topk_rules", "counter_rate", "gauge_arith", "event_feed_json", "latest_then_filter",
    "timeline_runs", "reload_rules", "rules_as_of", "stream_live_window", "compact_events", "stream_detect_events",
]


@pytest.fixture(scope="module")
def connection():
    duck = duckdb.connect()
    for table in ("events", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return duck


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, connection, name):
    assert compare(spark, connection, name, SF_DIR)


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.fixture(scope="module")
def events(spark):
    rows = [("INFO", 0), ("WARNING", 0), ("INFO", 9), ("CRITICAL", 10), ("OTHER", 45), ("INFO", 86_400)]
    return make_events(spark, *[dict(severity=s, ts=NOON + timedelta(seconds=t), rule_triggered="r" if s == "INFO" else None) for s, t in rows])


def test_counters(events):
    assert tuple(stats.event_stats(events).first()) == (3, 1, 1, 6)
    assert stats.stat_total(events, "WARNING").first().total == 1
    assert {(r.rule, r.total) for r in stats.rules_triggered_total(events).collect()} == {("r", 3)}
    assert {(r.severity, r.total, r.share) for r in stats.severity_distribution(events).collect()} == {
        ("INFO", 3, 0.6), ("WARNING", 1, 0.2), ("CRITICAL", 1, 0.2)}
    empty = stats.severity_distribution(events.where("false")).collect()
    assert [(r.total, r.share) for r in empty] == [(0, 0.0)] * 3


def test_running_totals_over_distant_numbers(spark):
    seqs = [0, 1, 65_535, 65_536, 2**32 - 1, 2**32, 2**40 + 5]
    frame = make_events(spark, *[dict(seq=s, severity="INFO" if i % 2 else "WARNING") for i, s in enumerate(seqs)])
    out = stats.running_totals(frame).orderBy("seq").collect()
    assert [(r.seq, r.total, r.info, r.warning) for r in out] == [(s, i + 1, (i + 1) // 2, (i + 2) // 2) for i, s in enumerate(seqs)]


def test_dense_timeline(events):
    out = timeline.timeline(events).orderBy("bucket").collect()
    assert len(out) == 8641
    assert [tuple(r)[1:] for r in out[:2]] == [(2, 1, 0), (0, 0, 1)] and out[-1].info == 1
    assert sum(r.info + r.warning + r.critical for r in out) == 5
    assert timeline.timeline(events.where("false")).count() == 0
    with pytest.raises(ValueError):
        timeline.timeline(events, 7)


def test_a_stray_time_adds_one_row(spark, events):
    """One stamp ten years off: a row for its bucket and one for all the empty buckets between."""
    stray = make_events(spark, dict(severity="INFO", ts=NOON + timedelta(days=3650)))
    plain, more = timeline.timeline_runs(events), timeline.timeline_runs(events.unionByName(stray))
    assert more.count() == plain.count() + 2
    assert [tuple(r)[1:] for r in plain.orderBy("bucket").collect()] == [(1, 2, 1, 0), (1, 0, 0, 1), (2, 0, 0, 0), (1, 0, 0, 0), (8635, 0, 0, 0), (1, 1, 0, 0)]
    assert more.agg({"buckets": "sum"}).first()[0] == 3650 * 8640 + 1
    assert timeline.timeline(events.unionByName(stray)).count() == 8641 + 2
    since = timeline.timeline_runs(events, since=NOON - timedelta(seconds=50)).orderBy("bucket").first()
    assert (since.bucket, since.buckets) == (NOON - timedelta(seconds=50), 5)


def test_idle_and_ended_series(events):
    """Zeros go on for the life of a series, five minutes by default, then it stops until its next event."""
    out = {(r.bucket, r.severity): r.rate for r in timeline.rate_series(events, "severity").collect()}
    assert out[NOON + timedelta(seconds=15), "INFO"] == 0 == out[NOON + timedelta(seconds=300), "INFO"]
    assert (NOON + timedelta(seconds=315), "INFO") not in out and (NOON + timedelta(days=1), "INFO") in out
    none = {(r.bucket, r.severity) for r in timeline.rate_series(events, "severity", life_seconds=0).collect()}
    assert {k for k, v in out.items() if v > 0} == none
    with pytest.raises(ValueError):
        timeline.rate_series(events, "severity", life_seconds=20)


def test_last_buckets():
    start = timeline.last_buckets_start
    assert start((NOON, NOON + timedelta(seconds=899))) == NOON
    assert start((NOON, NOON + timedelta(seconds=909))) == NOON + timedelta(seconds=10)


def test_rates(events):
    out = {(r.bucket, r.severity): r.rate for r in timeline.rate_series(events, "severity").collect()}
    assert out[NOON, "INFO"] == round(2 / 60, 6) and out[NOON, "OTHER"] == round(1 / 60, 6)
    assert out[NOON - timedelta(seconds=45), "INFO"] == round(2 / 60, 6)
    assert (NOON - timedelta(seconds=60), "INFO") not in out
    top = timeline.topk_rules(events, NOON + timedelta(seconds=9)).collect()
    assert [(r.rule, r.rate) for r in top] == [("r", round(2 / 300, 6))]


def test_counter_reset_and_gauges(spark):
    def sample(second, metric, value, **labels):
        return (NOON + timedelta(seconds=second), metric, labels, float(value))

    rows = [sample(s, "c", v, instance="a") for s, v in ((0, 10), (15, 40), (30, 5), (45, 20), (60, 100))]
    rows += [sample(0, "node_time_seconds", 50, instance="a"), sample(9, "node_time_seconds", 70, instance="a"), sample(1, "node_boot_time_seconds", 20, instance="a")]
    rows += [sample(0, "node_boot_time_seconds", 20, instance="b")]
    frame = spark.createDataFrame(rows, "ts TIMESTAMP_NTZ, metric STRING, labels MAP<STRING, STRING>, value DOUBLE")
    out = {r.bucket: r.rate for r in metrics.counter_rate(frame, "c").collect()}
    assert out == {NOON: round((30 + 5 + 15) / 45, 6), NOON + timedelta(seconds=60): round(80 / 15, 6)}
    assert [(r.instance, r.name, r.value) for r in metrics.gauge_arith(frame).collect()] == [("a", "uptime", 50.0)]


def test_steady_counters(spark):
    """A counter that grows by 1 a second has rate 1 everywhere, scraped every 15 s; a fully idle machine is 0 % busy."""
    labels = {"instance": "a", "mode": "idle", "cpu": "0"}
    rows = [(NOON + timedelta(seconds=s), "node_cpu_seconds_total", labels, float(s)) for s in range(0, 600, 15)]
    frame = spark.createDataFrame(rows, "ts TIMESTAMP_NTZ, metric STRING, labels MAP<STRING, STRING>, value DOUBLE")
    for step in (15, 60):
        rates = metrics.counter_rate(frame, "node_cpu_seconds_total", 60, step, {"cpu": "0"}).collect()
        assert len(rates) >= 10 and {r.rate for r in rates} == {1.0}
    assert metrics.counter_rate(frame, "node_cpu_seconds_total", labels={"cpu": "1"}).count() == 0
    assert {r.cpu_usage_pct for r in metrics.cpu_usage_pct(frame).collect()} == {0.0}


def test_listings(events):
    newest = search.latest_events(events, 2).collect()
    assert [r.seq for r in newest] == [5, 4]
    assert [r.seq for r in search.search_events(events, "INFO", "", 2).collect()] == [5, 2]
    assert search.latest_then_filter(events, "CRITICAL").count() == 1
    assert search.live_window(events).count() == 6
    shown = search.project_display(events.where("seq = 0")).first()
    assert tuple(shown) == ("2026-05-01 12:00:00", "auth", "-", "-", "-", "-", "INFO", "r")
    for limit in (0, 1001, "5", True):
        with pytest.raises(ValueError):
            search.latest_events(events, limit)
    text = search.search_events(events, "INFO")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text
