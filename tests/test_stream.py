"""Streams must give what the batch job gives, whatever the batches."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from vigilog import Rule, detect_events, load_rules, normalize_events, rules_from
from vigilog.operators import detect
from vigilog.operators.normalize import parse_lines, rejected_lines
from vigilog.operators.search import live_window
from vigilog.plans import queries
from vigilog.schema import EVENTS
from vigilog.sources.commits import EventStore
from vigilog.sources.event_store import append_events, create_event_table, scan_events
from vigilog.sources.lines import paths_from_env, read_lines, switch_log_path, tail_stream, union_sources
from vigilog.streaming.detection import DetectionStream, _write_all, number_lines
from vigilog.streaming.series import stream_timeline, stream_totals

LINES = "seq BIGINT, source STRING, line STRING"


def make_lines(count=240, seed=5):
    rng, rows, at = random.Random(seed), [], datetime(2026, 5, 1, 23, 58)
    for seq in range(count):
        at += timedelta(seconds=rng.choice([0, 0, 0, 1, 2, 9]))
        ip, stamp = f"10.0.0.{rng.choice([1, 1, 1, 2])}", at.strftime("%b %d %H:%M:%S")
        kind = rng.randrange(5)
        if kind == 0:
            rows.append((seq, "auth", f"{stamp} server sshd[1]: Failed password for root from {ip} port 22"))
        elif kind == 1:
            rows.append((seq, "firewall", f"{stamp} fw kernel: [UFW BLOCK] IN=eth0 OUT= SRC={ip} DST=1.1.1.1 LEN=1 PROTO=TCP SPT=1 DPT=2"))
        elif kind == 2:
            rows.append((seq, "access", f'{ip} - - [{at:%d/%b/%Y:%H:%M:%S} +0000] "GET /a HTTP/1.1" 404 1'))
        elif kind == 3:
            rows.append((seq, "syslog", f"{stamp} server sudo: bob : authentication failure ; x"))
        else:
            rows.append((seq, "fim", "broken"))
    return rows


RULES = [
    Rule("failures", "CRITICAL", {"source": "auth", "action": "failed_login", "rate": {"threshold": 4, "window_seconds": 60}}),
    Rule("drop", "INFO", {"source": "firewall", "action": "DROP"}),
    Rule("scan", "WARNING", {"source": "access", "status": "404", "rate": {"threshold": 6, "window_seconds": 40}}),
    Rule("sudo", None, {"source": "syslog"}),
]


def run(spark, job, folder, steps, checkpoint=None):
    """Feed the steps one after the other; the query is stopped and started again in between."""
    for rows in steps:
        spark.createDataFrame(rows, LINES).write.mode("append").parquet(f"{folder}/in")
        arriving = spark.readStream.schema(LINES).parquet(f"{folder}/in")
        job(arriving)


def keys(frame):
    return sorted(tuple(r) for r in frame.select("seq", "rule_triggered", "severity").collect())


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    rows, folder = make_lines(), str(tmp_path)
    stream = DetectionStream(RULES, f"{folder}/out", ref_year=2026)
    steps = [rows[:50], rows[50:51], rows[51:170], rows[170:]]
    run(spark, lambda lines: stream.start(lines, f"{folder}/cp", availableNow=True).awaitTermination(), folder, steps)
    batch = detect_events(normalize_events(spark.createDataFrame(rows, LINES), ref_year=2026), RULES)
    found = stream.outputs(spark, "events", EVENTS)
    assert keys(found) == keys(batch)
    assert {"failures", "scan"} <= {k[1] for k in keys(found)}

    # what hangs off the events
    broken = sum(r[2] == "broken" for r in rows)
    critical = found.where("severity = 'CRITICAL'").count()
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/out/rejected").count() == broken
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/out/alerts").count() == critical
    feed = [json.loads(r.message) for r in spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/out/feed").collect()]
    assert len(feed) == len(rows) - broken and {"rule_triggered", "extra", "timestamp"} <= set(feed[0])
    counters = spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/out/counters")
    assert counters.agg(F.sum("total")).first()[0] == len(feed)

    # a batch that runs again replaces its own output, and counts once
    for _ in range(2):
        totals = {r.severity: r.total for r in stream_totals(spark, f"{folder}/out").collect()}
        assert totals == {r.severity: r["count"] for r in batch.groupBy("severity").count().collect()}
        buckets = stream_timeline(spark, f"{folder}/out").collect()
        assert sum(r.info + r.warning + r.critical for r in buckets) == len(feed) and len({r.bucket for r in buckets}) == len(buckets)
        stream.process(spark.createDataFrame(rows[170:], LINES), 3)
        assert keys(stream.outputs(spark, "events", EVENTS)) == keys(batch)


def failure(seq, second, stamp="May 01 12:00:{:02d}"):
    return seq, "auth", stamp.format(second) + " server sshd[1]: Failed password for root from 1.1.1.1 port 22"


def test_a_stray_time_does_not_clear_the_state(spark, tmp_path):
    """Lines without a usable time take the time of arrival, months after the others."""
    stream = DetectionStream(RULES, f"{tmp_path}/out", ref_year=2026)
    stream.process(spark.createDataFrame([failure(0, 0), failure(1, 1), failure(2, 2), failure(3, 0, "Feb 30 12:00:{:02d}")], LINES), 0)
    stream.process(spark.createDataFrame([failure(4, 9)], LINES), 1)
    fired = {k[0]: k[1] for k in keys(stream.outputs(spark, "events", EVENTS))}
    assert fired[4] == "failures" and fired[3] is None


def stamped(seq, stamp, ip):
    return seq, "auth", f"{stamp} server sshd[1]: Failed password for root from {ip} port 22"


@pytest.mark.parametrize("stamp", ["Dec 30 23:59:{:02d}", "Jan 01 00:00:{:02d}"], ids=["future", "past"])
def test_odd_stamps_in_the_majority_leave_firings_unchanged(spark, tmp_path, stamp):
    """Three failures, fifty lines of another address with stamps months off, and the fourth failure a batch later."""
    stray = [stamped(100 + i, stamp.format(i), "9.9.9.9") for i in range(50)]
    stream = DetectionStream(RULES, f"{tmp_path}/out", ref_year=2026)
    stream.process(spark.createDataFrame([failure(0, 0), failure(1, 1), failure(2, 2), *stray], LINES), 0)
    stream.process(spark.createDataFrame(stray[:9], LINES), 1)
    stream.process(spark.createDataFrame([failure(4, 9)], LINES), 2)
    fired = {k[0]: k[1] for k in keys(scan_events(spark, f"{tmp_path}/out/events").where("seq < 100"))}
    assert fired == {0: None, 1: None, 2: None, 4: "failures"}


def test_state_ages_by_running_time(spark, tmp_path):
    """A row is forgotten after window and delay of running time; a pause of days counts for a minute."""
    at = [datetime(2026, 5, 1, 12, tzinfo=timezone.utc)]
    stream = DetectionStream(RULES, f"{tmp_path}/out", ref_year=2026, delay_seconds=100, clock=lambda: at[0])
    held = []
    for batch, seconds in enumerate([0, 50, 86_400, 30, 30, 30]):  # ages 0, 50, 110, 140, 170
        at[0] += timedelta(seconds=seconds)
        stream.process(spark.createDataFrame([failure(0, 0)] if batch == 0 else [], LINES), batch)
        held.append(spark.read.parquet(stream.state_path(batch)).count())
    assert held == [1, 1, 1, 1, 0, 0]


def test_rules_that_change_while_the_stream_runs(spark, tmp_path):
    steps = {0: 9, 1: 4}
    rule = lambda n: Rule("failures", "CRITICAL", {"action": "failed_login", "rate": {"threshold": n, "window_seconds": 60}})
    stream = DetectionStream(lambda batch: [rule(steps[batch])], f"{tmp_path}/out", ref_year=2026)
    for batch, seqs in enumerate(([0, 1, 2], [3])):
        stream.process(spark.createDataFrame([failure(s, s) for s in seqs], LINES), batch)
    assert [k[1] for k in keys(scan_events(spark, f"{tmp_path}/out/events"))] == [None, None, None, "failures"]


def test_live_view_after_every_batch(spark, tmp_path):
    """It equals the batch query over all events so far, under any filter, also when a batch runs again."""
    rows = make_lines(1500, seed=9)
    stream = DetectionStream(RULES, f"{tmp_path}/out", ref_year=2026)
    steps = [rows[:900], rows[900:905], rows[905:]]
    for batch, step in enumerate(steps):
        for _ in range(1 + batch % 2):
            stream.process(spark.createDataFrame(step, LINES), batch)
        events = scan_events(spark, f"{tmp_path}/out/events")
        for severity, source in ((None, None), ("INFO", None), (None, "access"), ("CRITICAL", "auth"), ("CRITICAL", "fim")):
            wanted = [r.seq for r in live_window(events, severity, source).collect()]
            assert [r.seq for r in stream.live(spark, severity, source).collect()] == wanted
    assert len(wanted) == 0 and events.where("source = 'access'").count() > 200


def test_state_outlives_rules_without_rates(spark, tmp_path):
    out = f"{tmp_path}/out"
    plain = [r for r in RULES if r.rate is None]
    steps = [(RULES, [0, 1, 2]), (plain, [3]), (plain, [4]), (plain, [5]), (RULES, [6])]
    for batch, (rules, seqs) in enumerate(steps):
        DetectionStream(rules, out, ref_year=2026).process(spark.createDataFrame([failure(s, s) for s in seqs], LINES), batch)
    fired = {k[0]: k[1] for k in keys(DetectionStream(RULES, out).outputs(spark, "events", EVENTS))}
    assert fired[6] == "failures"
    # from the start without rates
    DetectionStream(plain, f"{tmp_path}/b", ref_year=2026).process(spark.createDataFrame([failure(0, 0)], LINES), 0)
    DetectionStream(RULES, f"{tmp_path}/b", ref_year=2026).process(spark.createDataFrame([failure(1, 1)], LINES), 1)


def test_lines_are_numbered_in_order_of_arrival(spark):
    lines = spark.range(1000, numPartitions=7).selectExpr("'auth' AS source", "cast(id AS string) AS line")
    seqs = [r.seq for r in number_lines(lines, 3).orderBy(F.col("line").cast("int")).collect()]
    assert seqs == [(3 << 36) + k for k in range(1000)]


def test_inferred_times_agree_between_actions(spark):
    lines = spark.createDataFrame([failure(i, 0, "Feb 30 12:00:{:02d}") for i in range(8)], LINES)
    events = normalize_events(lines, ref_year=2026)
    assert events.where("ts_inferred").count() == 8
    assert events.agg(F.max("ts")).first() == events.agg(F.max("ts")).first()
    for staged in (False, True):
        assert sum(k[1] == "failures" for k in keys(detect_events(events, RULES, staged=staged))) == 5


def test_reloaded_rules_keep_their_counters(spark, tmp_path):
    """The threshold drops while three failures are on record: the next one fires."""
    stamp = "May 01 12:00:0{} server sshd[1]: Failed password for root from 1.1.1.1 port 22"
    rows, folder = [(i, "auth", stamp.format(i)) for i in range(4)], str(tmp_path)

    def with_threshold(n):
        rule = Rule("failures", "CRITICAL", {"action": "failed_login", "rate": {"threshold": n, "window_seconds": 60}})
        stream = DetectionStream([rule], f"{folder}/out", ref_year=2026)
        return lambda lines: stream.start(lines, f"{folder}/cp", availableNow=True).awaitTermination()

    run(spark, with_threshold(9), folder, [rows[:3]])
    run(spark, with_threshold(4), folder, [rows[3:]])
    found = scan_events(spark, f"{folder}/out/events")
    assert [k[1] for k in keys(found)] == [None, None, None, "failures"]


def test_processing_clock_counts_arrivals(spark, tmp_path):
    """Log times hours apart, but all lines arrive together."""
    lines = [(i, "auth", f"May 01 {i:02d}:00:00 server sshd[1]: Failed password for root from 1.1.1.1 port 22") for i in range(5)]
    for clock, fired in (("processing", 2), ("event", 0)):
        stream = DetectionStream(RULES, f"{tmp_path}/{clock}", ref_year=2026, rate_clock=clock)
        stream.process(spark.createDataFrame(lines, LINES), 0)
        assert sum(k[1] == "failures" for k in keys(stream.outputs(spark, "events", EVENTS))) == fired
    with pytest.raises(ValueError):
        DetectionStream(RULES, "x", rate_clock="wall")


def test_text_files_batch_and_stream(spark, tmp_path):
    folders = {}
    for source, text in (("auth", "a1\na2\n"), ("fim", "f1\n")):
        (tmp_path / source).mkdir()
        (tmp_path / source / "one.log").write_text(text)
        folders[source] = str(tmp_path / source)
    lines = read_lines(spark, {**folders, "access": str(tmp_path / "missing")}, missing="skip")
    with pytest.raises(AnalysisException):
        read_lines(spark, {**folders, "access": str(tmp_path / "missing")})
    assert sorted((r.source, r.line) for r in lines.collect()) == [("auth", "a1"), ("auth", "a2"), ("fim", "f1")]
    assert lines.select("seq").distinct().count() == 3
    assert read_lines(spark, {"access": str(tmp_path / "missing")}, missing="skip").count() == 0

    moved = switch_log_path(folders, "fim", folders["auth"])
    assert moved["fim"] == folders["auth"] and folders["fim"] != folders["auth"]
    with pytest.raises(ValueError):
        switch_log_path(folders, "mail", "x")
    stream = DetectionStream(RULES, f"{tmp_path}/out", ref_year=2026)
    stream.start(tail_stream(spark, folders), f"{tmp_path}/cp", availableNow=True).awaitTermination()
    rejected = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/out/rejected")
    assert sorted(r.line for r in rejected.collect()) == ["a1", "a2", "f1"]
    assert rejected.select("seq").distinct().count() == 3


def test_source_selection(spark):
    files, generated = (spark.createDataFrame([(i, "auth", n)], LINES) for i, n in enumerate(("file", "made")))
    for mode, expected in (("file", ["file"]), ("generator", ["made"]), ("both", ["file", "made"])):
        assert sorted(r.line for r in union_sources(files, generated, mode).collect()) == expected
    with pytest.raises(ValueError):
        union_sources(files, generated, "none")
    assert paths_from_env({"LOG_FILE_FIM": "/x"})["fim"] == "/x" and paths_from_env({})["auth"] == "/app/logs/auth.log"


def test_event_table(spark, tmp_path):
    events = detect_events(normalize_events(spark.createDataFrame(make_lines(), LINES), ref_year=2026), RULES)
    for _ in range(2):
        create_event_table(spark, "test_events", str(tmp_path / "events"))
    append_events(events, "test_events")
    stored = scan_events(spark, "test_events")
    assert keys(stored) == keys(events)
    one = stored.where("source = 'auth' AND event_date = DATE'2026-05-02' AND severity = 'CRITICAL'").select("seq")
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "event_date" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(severity,CRITICAL)" in text and "raw" not in text.split("ReadSchema")[1]
    append_events(events, "test_events")
    assert stored.count() == 2 * events.count()
    spark.sql("DROP TABLE test_events")


def test_steps_of_a_streamed_query_are_dealt_over_the_cores(spark, tmp_path, monkeypatch):
    """The events lie in one row group of a file that counts as many splits."""
    class Idle:
        def __init__(self, rules, out, **settings):
            self.out = out

        def start(self, *args, **settings):
            return self

        def awaitTermination(self):
            pass

    rows = spark.range(4000).selectExpr("id AS event_id", "id % 7 AS user_id", "'view' AS event_type")
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(queries, "DetectionStream", Idle)
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert spark.read.parquet(f"{tmp_path}/events.parquet").rdd.getNumPartitions() >= 4
        folder = queries._stream(spark, str(tmp_path), lambda step: []).out.removesuffix("/out")
        lines = spark.read.parquet(f"{folder}/lines")
        files = lines.groupBy((F.col("seq") >= 2000).alias("step"), F.input_file_name()).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    assert sum(f["count"] for f in files) == 4000
    for step in (False, True):
        assert max(f["count"] for f in files if f["step"] == step) <= 1000


def test_one_pass_gives_events_and_rejected_lines(spark):
    odd = [(900, "mail", "May 01 12:00:00 a b: c"), (901, "auth", None), (902, None, "x"), (903, "auth", ""), (None, "fim", "broken")]
    lines = spark.createDataFrame([*make_lines(), *odd], LINES).withColumn("ingest_ts", F.expr("TIMESTAMP_NTZ'2026-05-01 00:00:00'"))
    parsed = parse_lines(lines, ref_year=2026)

    def rows(frame):
        return sorted(map(str, frame.collect()))

    assert rows(parsed.where("is_event").drop("is_event", "line")) == rows(normalize_events(lines, ref_year=2026))
    assert rows(parsed.where("NOT is_event").select("seq", "source", "line")) == rows(rejected_lines(lines))
    assert parsed.where("is_event AND line IS NOT NULL").count() == 0


def test_a_result_that_cannot_be_written_fails_the_batch(spark, tmp_path):
    good, bad = spark.range(3), spark.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(Exception, match="no"):
        _write_all(spark, {f"{tmp_path}/good": good, f"{tmp_path}/bad": bad})
    assert spark.read.parquet(f"{tmp_path}/good").count() == 3


@pytest.mark.parametrize("light", [detect.LIGHT_OUTCOMES, 0])
def test_events_of_a_batch_that_cannot_fire_are_in_no_join_shuffle(spark, tmp_path, monkeypatch, light):
    """What fires is written first: broadcast if it is small; else only events whose key is among it are shuffled."""
    monkeypatch.setattr(detect, "LIGHT_OUTCOMES", light)
    plans, commit, rows = [], EventStore.commit, make_lines()

    def noted(store, events, key):
        plans.append(events._jdf.queryExecution().sparkPlan().toString())
        commit(store, events, key)

    monkeypatch.setattr(EventStore, "commit", noted)
    stream = DetectionStream(RULES, f"{tmp_path}/out", ref_year=2026)
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for batch_id, part in enumerate((rows[:100], rows[100:])):
            stream.process(spark.createDataFrame(part, LINES), batch_id)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert len(plans) == 2 and all(("BroadcastHashJoin" in p, "shiftrightunsigned" in p) == (light > 0, light == 0) for p in plans)
    whole = normalize_events(spark.createDataFrame(rows, LINES), ref_year=2026)
    assert keys(stream.outputs(spark, "events", EVENTS)) == keys(detect_events(whole, RULES))
