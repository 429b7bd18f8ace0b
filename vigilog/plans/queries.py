"""All registered queries: a Spark job and, where SQL can say it, the expected result."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.functions import predicates
from vigilog.functions.http import classify_http_attack
from vigilog.functions.text import strip
from vigilog.functions.timestamps import format_iso
from vigilog.operators import detect, metrics, outputs, search, stats, timeline
from vigilog.operators.normalize import normalize_events, rejected_lines
from vigilog.operators.rate import rate_rules
from vigilog.plans import oracle as o
from vigilog.schema import EVENTS, SOURCES
from vigilog.session import scratch_dir, tune
from vigilog.sources.commits import EventStore, plain
from vigilog.sources.event_store import append_events, create_event_table, scan_events
from vigilog.sources.fixture import REF_YEAR, log_lines, metric_samples
from vigilog.sources.lines import read_lines, switch_log_path, tail_stream, union_sources
from vigilog.sources.rules import Rule, load_rules, rule_versions, rules_from, rules_path
from vigilog.streaming.detection import DetectionStream
from vigilog.streaming.series import stream_timeline, stream_totals

Job = Callable[[SparkSession, str], DataFrame]

# Streamed queries feed the whole table in this many steps, restarting in between.
_STEPS = 2


@dataclass(frozen=True)
class Query:
    job: Job
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    def register(job: Job) -> Job:
        QUERIES[name] = Query(lambda spark, sf_dir: job(tune(spark), sf_dir), sql)
        return job

    return register


def _ts(column: str = "ts"):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def _events(spark: SparkSession, sf_dir: str, sources: Sequence[str] = SOURCES) -> DataFrame:
    return normalize_events(log_lines(spark, sf_dir), ref_year=REF_YEAR, sources=sources)


def _rules(spark: SparkSession) -> list[Rule]:
    return rules_from(load_rules(spark))


def _detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.detect_events(_events(spark, sf_dir), _rules(spark))


def _event_text(events: DataFrame) -> DataFrame:
    return events.select(
        "seq", _ts(), "source", "raw", "ip", "user", "action", "status", "severity", "path", "direction",
        F.to_json("extra").alias("extra"),
    )


def _detected_text(events: DataFrame) -> DataFrame:
    return events.select("seq", _ts(), "source", "ip", "user", "action", "status", "severity", "rule_triggered")


# ---- sources and sinks

def _write_files(lines: DataFrame, base: str, sources: Sequence[str] = SOURCES) -> dict[str, str]:
    """One folder of text files per source."""
    lines.where(F.col("source").isin(*sources)).select("line", "source").write.partitionBy("source").text(base)
    return {s: f"{base}/source={s}" for s in sources}


@query("scan_log_lines", o.with_lines("SELECT source, line FROM log_lines"))
def _scan_log_lines(spark, sf_dir):
    paths = _write_files(log_lines(spark, sf_dir), scratch_dir(spark, "logs"))
    return read_lines(spark, paths).select("source", "line")


def _copy_stream(spark, paths: dict[str, str], out: str, checkpoint: str) -> None:
    writer = tail_stream(spark, paths).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(out).awaitTermination()


@query("tail_stream", o.with_lines("SELECT source, line FROM log_lines"))
def _tail_stream(spark, sf_dir):
    base = scratch_dir(spark, "tail")
    paths = _write_files(log_lines(spark, sf_dir), f"{base}/logs")
    _copy_stream(spark, paths, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema("source STRING, line STRING").parquet(f"{base}/out")


@query("switch_log_path", o.with_lines("SELECT source, line FROM log_lines"))
def _switch_log_path(spark, sf_dir):
    """The access log moves to another folder between two runs."""
    base, lines = scratch_dir(spark, "switch"), log_lines(spark, sf_dir)
    others = [s for s in SOURCES if s != "access"]
    paths = _write_files(lines, f"{base}/old", others)
    _copy_stream(spark, paths, f"{base}/out/before", f"{base}/checkpoint-before")
    moved = _write_files(lines, f"{base}/new", ["access"])["access"]
    paths = {"access": switch_log_path(paths, "access", moved)["access"]}
    _copy_stream(spark, paths, f"{base}/out/after", f"{base}/checkpoint-after")
    return spark.read.schema("source STRING, line STRING").parquet(f"{base}/out/before", f"{base}/out/after")


@query("union_sources", o.with_lines("SELECT seq, source, line FROM log_lines"))
def _union_sources(spark, sf_dir):
    lines = log_lines(spark, sf_dir)
    hosts = F.col("source").isin("syslog", "fim")
    return union_sources(lines.where(~hosts), lines.where(hosts), "both").select("seq", "source", "line")


@query(
    "load_rules",
    o.with_detected(
        "SELECT rule_ord, rule_id, name, description, severity, mitre_id, mitre_tactic, threshold, window_seconds, "
        "(SELECT count(*) FROM candidates c WHERE c.rule_ord = r.rule_ord) AS candidates FROM rules r"
    ),
)
def _load_rules(spark, sf_dir):
    """The rules with the number of events each has to look at."""
    rules = load_rules(spark)
    found = detect.rule_matches(_events(spark, sf_dir), rules_from(rules)).groupBy("rule_ord").agg(F.count("*").alias("candidates"))
    return rules.join(found, "rule_ord", "left").select(
        "rule_ord", "rule_id", "name", "description", "severity", "mitre_id", "mitre_tactic",
        F.col("conditions.rate.threshold").alias("threshold"),
        F.col("conditions.rate.window_seconds").alias("window_seconds"),
        F.coalesce("candidates", F.lit(0)).alias("candidates"),
    )


# Event stores and tables filled by this process, by application, data folder and state of its events.
_STORES: dict[tuple, EventStore] = {}
_TABLES: dict[tuple, str] = {}


def _state_of(spark, sf_dir) -> tuple:
    """Names a folder's events as they are now: changed files are read anew."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.sparkContext.applicationId, sf_dir, files.getContentSummary(path).getLength(), files.getFileStatus(path).getModificationTime()


def _store(spark, sf_dir) -> EventStore:
    """The committed events of a folder: all detected events, written once in a session."""
    known = _state_of(spark, sf_dir)
    if known not in _STORES:
        store = EventStore(spark, scratch_dir(spark, "events"))
        store.append(detect.detect_events(_events(spark, sf_dir), _rules(spark), staged=True))
        _STORES[known] = store
    return _STORES[known]


def _stored(spark, sf_dir) -> str:
    """Name of the event table of a folder, filled once in a session."""
    known = _state_of(spark, sf_dir)
    if known in _TABLES and spark.catalog.tableExists(_TABLES[known]):
        return _TABLES[known]
    path = scratch_dir(spark, "events")
    name = "log_events_" + path.rsplit("-", 1)[1]
    create_event_table(spark, name, path)
    create_event_table(spark, name, path)
    append_events(_table(spark, sf_dir), name)
    _TABLES[known] = name
    return name


def _table(spark, sf_dir) -> DataFrame:
    """The committed events, which counts, series and listings read."""
    return _store(spark, sf_dir).scan().drop("event_date")


def _newest(spark, sf_dir, n: int, severity: str | None = None, source: str | None = None) -> DataFrame:
    """The days at the end that hold ``n`` events of this severity and source."""
    return _store(spark, sf_dir).newest(n, severity, source).drop("event_date")


@query(
    "append_events",
    o.with_detected("SELECT strftime(ts, '%Y-%m-%d') AS event_date, source, severity, count(*) AS n FROM detected GROUP BY ALL"),
)
def _append_events(spark, sf_dir):
    stored = scan_events(spark, _stored(spark, sf_dir))
    return stored.groupBy(F.col("event_date").cast("string").alias("event_date"), "source", "severity").agg(F.count("*").alias("n"))


@query("create_event_table", o.with_detected("SELECT source, count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS days FROM detected GROUP BY 1"))
def _create_event_table(spark, sf_dir):
    return spark.table(_stored(spark, sf_dir)).groupBy("source").agg(
        F.count("*").alias("n"), F.count_distinct("event_date").alias("days")
    )


@query("scan_events", o.with_detected(f"SELECT {o.DETECTED_TEXT}, extra FROM detected"))
def _scan_events(spark, sf_dir):
    stored = scan_events(spark, _stored(spark, sf_dir))
    return stored.select(*_detected_text(stored).columns, F.to_json("extra").alias("extra")).withColumn("ts", _ts())


@query(
    "event_feed_json",
    o.with_detected(
        """SELECT seq, '{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '","source":"' || source || '","raw":' || to_json(raw)
        || ',"ip":' || coalesce(to_json(ip), 'null') || ',"user":' || coalesce(to_json("user"), 'null') || ',"action":' || to_json(action)
        || ',"status":' || coalesce(to_json(status), 'null') || ',"severity":"' || severity || '","rule_triggered":'
        || coalesce(to_json(rule_triggered), 'null') || ',"extra":' || extra || '}' AS message FROM detected"""
    ),
)
def _event_feed_json(spark, sf_dir):
    return outputs.event_feed_json(_table(spark, sf_dir))


@query(
    "alert_messages",
    o.with_detected(
        "SELECT seq, chr(10) || ' **SIEM ALERT TRIGGERED**' || chr(10) || chr(10) || '**Rule:** ' || coalesce(rule_triggered, 'None') "
        + "".join(
            f"|| chr(10) || '**{label}:** ' || coalesce({column}, 'None') "
            for label, column in (("Severity", "severity"), ("Source", "source"), ("IP", "ip"), ("User", '"user"'), ("Action", "action"), ("Status", "status"))
        )
        + "|| chr(10) || '**Time:** ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || chr(10) AS message FROM detected WHERE severity = 'CRITICAL'"
    ),
)
def _alert_messages(spark, sf_dir):
    return outputs.alert_messages(_table(spark, sf_dir))


_REJECTED = o.with_events("SELECT seq, source, line FROM log_lines WHERE seq NOT IN (SELECT seq FROM events_p)")


@query("rejected_lines", _REJECTED)
def _rejected_lines(spark, sf_dir):
    return rejected_lines(log_lines(spark, sf_dir))


# ---- parsing

def _register_parsers() -> None:
    for source in SOURCES:
        query(f"parse_{source}", o.with_events(f"SELECT {o.EVENT_TEXT} FROM events_p WHERE source = '{source}'"))(
            lambda spark, sf_dir, s=source: _event_text(_events(spark, sf_dir, [s]))
        )
    for name, sources in (("syslog", ("auth", "firewall", "syslog")), ("clf", ("access",)), ("iso", ("fim",))):
        listed = ", ".join(f"'{s}'" for s in sources)
        query(f"parse_{name}_ts", o.with_events(f"SELECT seq, {o.TS_TEXT} FROM events_p WHERE source IN ({listed})"))(
            lambda spark, sf_dir, s=sources: _events(spark, sf_dir, s).select("seq", _ts())
        )


_register_parsers()


@query("classify_http_attack", f"SELECT page_id, url, {o._attack('url')} AS attack FROM pages")
def _classify_http_attack(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "url", classify_http_attack(F.col("url")).alias("attack"))


@query("normalize_events", o.with_events(f"SELECT {o.EVENT_TEXT} FROM events_p"))
def _normalize_events(spark, sf_dir):
    return _event_text(_events(spark, sf_dir))


@query("drop_unparsed", o.with_events("SELECT source, count(*) AS n FROM events_p GROUP BY 1"))
def _drop_unparsed(spark, sf_dir):
    return _events(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"))


@query("strip_lines", o.with_lines("SELECT seq, line FROM log_lines"))
def _strip_lines(spark, sf_dir):
    padded = F.concat(F.lit("\t 　"), F.col("line"), F.lit(" \x0b\r"))
    return log_lines(spark, sf_dir).select("seq", strip(padded).alias("line"))


_ISO_SQL = "CASE WHEN {0} = date_trunc('second', {0}) THEN strftime({0}, '%Y-%m-%dT%H:%M:%S') ELSE strftime({0}, '%Y-%m-%dT%H:%M:%S.%f') END"


@query(
    "format_iso_ts",
    f"SELECT event_id, {_ISO_SQL.format('ts')} AS iso, {_ISO_SQL.format('whole')} AS iso_whole FROM (SELECT *, date_trunc('second', ts) AS whole FROM events)",
)
def _format_iso_ts(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    whole = F.date_trunc("second", "ts").cast("timestamp_ntz")
    return events.select("event_id", format_iso(F.col("ts")).alias("iso"), format_iso(whole).alias("iso_whole"))


# ---- conditions

def _flagged(spark, sf_dir, **tests: str) -> DataFrame:
    return _events(spark, sf_dir).select("seq", *[F.expr(t).alias(n) for n, t in tests.items()])


@query(
    "cond_equality",
    o.with_events("""SELECT seq, source = 'auth' AS on_source, action = 'login' AS on_action, coalesce(status = 'SUCCESS', false) AS on_status,
      coalesce("user" = 'root', false) AS on_user, coalesce(source = 'auth' AND action = 'login' AND "user" = 'root', false) AS on_all FROM events_p"""),
)
def _cond_equality(spark, sf_dir):
    wanted = {"source": "auth", "action": "login", "status": "SUCCESS", "user": "root"}
    tests = {f"on_{k}": predicates.cond_equality(k, v) for k, v in wanted.items()}
    return _flagged(spark, sf_dir, **tests, on_all=predicates.rule_condition({**wanted, "unknown": "x"}))


@query("cond_direction", o.with_events("SELECT seq, coalesce(direction = 'outbound', false) AS outbound FROM events_p"))
def _cond_direction(spark, sf_dir):
    return _flagged(spark, sf_dir, outbound=predicates.cond_direction("outbound"))


@query(
    "cond_path_match",
    o.with_events("SELECT seq, coalesce(starts_with(path, '/etc/') OR starts_with(path, '/api'), false) AS listed, false AS nothing FROM events_p"),
)
def _cond_path_match(spark, sf_dir):
    return _flagged(spark, sf_dir, listed=predicates.cond_path_match(["/etc/", "/api"]), nothing=predicates.cond_path_match([]))


@query(
    "cond_time_range",
    o.with_events("SELECT seq, hour(ts) < 6 AS night, hour(ts) >= 22 OR hour(ts) < 6 AS around_midnight, false AS never FROM events_p"),
)
def _cond_time_range(spark, sf_dir):
    test = predicates.cond_time_range
    return _flagged(spark, sf_dir, night=test(), around_midnight=test(22, 6), never=test(5, 5))


@query(
    "cond_rate",
    o.with_events("""SELECT a.seq, a.ip FROM (SELECT * FROM events_p WHERE action = 'DROP') a
      JOIN (SELECT * FROM events_p WHERE action = 'DROP') b ON a.ip = b.ip AND b.ts BETWEEN a.ts - INTERVAL 3 SECOND AND a.ts
        AND (b.ts < a.ts OR b.seq <= a.seq) GROUP BY ALL HAVING count(*) >= 7"""),
)
def _cond_rate(spark, sf_dir):
    rule = Rule("drops", conditions={"action": "DROP", "rate": {"threshold": 7, "window_seconds": 3}})
    return detect.rate_detection(_events(spark, sf_dir, ["firewall"]), [rule]).select("seq", "ip")


@query("filter_severity", o.with_detected(f"SELECT {o.DETECTED_TEXT} FROM detected WHERE severity = 'WARNING'"))
def _filter_severity(spark, sf_dir):
    return _detected_text(search.filter_events(_table(spark, sf_dir), severity="WARNING"))


@query("filter_source", o.with_detected(f"SELECT {o.DETECTED_TEXT} FROM detected WHERE source = 'firewall'"))
def _filter_source(spark, sf_dir):
    return _detected_text(search.filter_events(_table(spark, sf_dir), severity="", source="firewall"))


@query("filter_critical", o.with_detected(f"SELECT {o.DETECTED_TEXT} FROM detected WHERE severity = 'CRITICAL'"))
def _filter_critical(spark, sf_dir):
    return _detected_text(search.filter_critical(_table(spark, sf_dir)))


# ---- detection

@query("rule_matches", o.with_detected("SELECT c.seq, c.rule_ord, r.name AS rule, r.severity AS rule_severity FROM candidates c JOIN rules r USING (rule_ord)"))
def _rule_matches(spark, sf_dir):
    return detect.rule_matches(_events(spark, sf_dir), _rules(spark)).select("seq", "rule_ord", "rule", "rule_severity")


@query("detect_events", o.with_detected(f"SELECT {o.DETECTED_TEXT}, raw, path, direction, extra FROM detected"))
def _detect_events(spark, sf_dir):
    events = _detected(spark, sf_dir)
    return events.select(*events.drop("ts_inferred").columns).withColumn("ts", _ts()).withColumn("extra", F.to_json("extra"))


_RATED = "matches m JOIN rules r USING (rule_ord) JOIN events_p e USING (seq) WHERE r.threshold IS NOT NULL"


@query("rate_detection", o.with_detected(f"SELECT seq, {o.TS_TEXT.replace('(ts', '(e.ts')}, e.ip, m.rule FROM {_RATED}"))
def _rate_detection(spark, sf_dir):
    return detect.rate_detection(_events(spark, sf_dir), _rules(spark)).select("seq", _ts(), "ip", "rule")


@query("detection_severity", o.with_detected("SELECT seq, e.severity AS parsed_severity, d.severity FROM events_p e JOIN detected d USING (seq)"))
def _detection_severity(spark, sf_dir):
    events = _events(spark, sf_dir).withColumn("parsed_severity", F.col("severity"))
    return detect.detect_events(events, _rules(spark)).select("seq", "parsed_severity", "severity")


@query(
    "detection_mitre",
    o.with_detected("SELECT seq, rule_triggered, rule_id, mitre_id, mitre_tactic FROM detected LEFT JOIN (SELECT * EXCLUDE (severity) FROM rules) ON name = rule_triggered"),
)
def _detection_mitre(spark, sf_dir):
    joined = detect.detection_mitre(_detected(spark, sf_dir), load_rules(spark))
    return joined.select("seq", "rule_triggered", "rule_id", "mitre_id", "mitre_tactic")


@query(
    "detections_by_ip",
    o.with_detected(
        "SELECT e.ip, m.rule, count(*) AS firings, strftime(min(e.ts), '%Y-%m-%d %H:%M:%S') AS first_ts, "
        f"strftime(max(e.ts), '%Y-%m-%d %H:%M:%S') AS last_ts FROM {_RATED} GROUP BY 1, 2"
    ),
)
def detections_by_ip(spark, sf_dir):
    found = detect.detections_by_ip(_events(spark, sf_dir), _rules(spark))
    return found.select("ip", "rule", "firings", _ts("first_ts"), _ts("last_ts"))


def _register_rules() -> None:
    for rule in o._rules():
        name = rule["name"]
        sql = o.with_detected(
            f"SELECT seq, {o.TS_TEXT.replace('(ts', '(e.ts')}, e.source, e.ip, e.\"user\", e.action, m.rule, m.rule_severity "
            f"FROM matches m JOIN events_p e USING (seq) WHERE m.rule = '{name}'"
        )

        def job(spark, sf_dir, wanted=name):
            rules = [r for r in _rules(spark) if r.name == wanted]
            return detect.all_matches(_events(spark, sf_dir), rules).select(
                "seq", _ts(), "source", "ip", "user", "action", "rule", "rule_severity"
            )

        query(f"rule_{name}", sql)(job)


_register_rules()


# ---- counters

@query(
    "event_stats",
    o.with_detected("SELECT count(*) FILTER (severity = 'INFO') AS info, count(*) FILTER (severity = 'WARNING') AS warning, count(*) FILTER (severity = 'CRITICAL') AS critical, count(*) AS total FROM detected"),
)
def _event_stats(spark, sf_dir):
    return stats.event_stats(_table(spark, sf_dir))


@query("events_total", o.with_detected("SELECT severity, source, count(*) AS total FROM detected GROUP BY 1, 2"))
def _events_total(spark, sf_dir):
    return stats.events_total(_table(spark, sf_dir))


@query("rules_triggered_total", o.with_detected("SELECT rule_triggered AS rule, count(*) AS total FROM detected WHERE rule_triggered IS NOT NULL GROUP BY 1"))
def _rules_triggered_total(spark, sf_dir):
    return stats.rules_triggered_total(_table(spark, sf_dir))


def _register_stats() -> None:
    for name, severity in (("stat_total", None), ("stat_critical", "CRITICAL"), ("stat_warning", "WARNING")):
        where = f" WHERE severity = '{severity}'" if severity else ""
        query(name, o.with_detected(f"SELECT count(*) AS total FROM detected{where}"))(
            lambda spark, sf_dir, s=severity: stats.stat_total(_table(spark, sf_dir), s)
        )


_register_stats()


@query(
    "running_totals",
    o.with_detected(
        "SELECT seq, count(*) OVER w AS total, count(*) FILTER (severity = 'INFO') OVER w AS info, count(*) FILTER (severity = 'WARNING') OVER w AS warning, "
        "count(*) FILTER (severity = 'CRITICAL') OVER w AS critical FROM detected WINDOW w AS (ORDER BY seq)"
    ),
)
def _running_totals(spark, sf_dir):
    return stats.running_totals(_table(spark, sf_dir))


@query(
    "severity_distribution",
    o.with_detected(
        "SELECT s.severity, count(d.seq) AS total, round(count(d.seq) / (SELECT count(*) FROM detected WHERE severity IN ('INFO', 'WARNING', 'CRITICAL')), 6) AS share "
        "FROM (VALUES ('INFO'), ('WARNING'), ('CRITICAL')) s(severity) LEFT JOIN detected d USING (severity) GROUP BY 1"
    ),
)
def _severity_distribution(spark, sf_dir):
    return stats.severity_distribution(_table(spark, sf_dir))


# ---- time series

_TIMELINE = """SELECT strftime(b.bucket, '%Y-%m-%d %H:%M:%S') AS bucket, count(*) FILTER (d.severity = 'INFO') AS info,
  count(*) FILTER (d.severity = 'WARNING') AS warning, count(*) FILTER (d.severity = 'CRITICAL') AS critical
  FROM (SELECT unnest(generate_series(time_bucket(INTERVAL 10 SECOND, min(ts)), max(ts), INTERVAL 10 SECOND)) AS bucket FROM detected) b
  LEFT JOIN detected d ON time_bucket(INTERVAL 10 SECOND, d.ts) = b.bucket"""


@query("timeline_10s", o.with_detected(f"{_TIMELINE} GROUP BY b.bucket"))
def _timeline_10s(spark, sf_dir):
    return timeline.timeline(_table(spark, sf_dir)).withColumn("bucket", _ts("bucket"))


@query(
    "timeline_last_90",
    o.with_detected(f"{_TIMELINE} WHERE b.bucket > (SELECT time_bucket(INTERVAL 10 SECOND, max(ts)) FROM detected) - INTERVAL 900 SECOND GROUP BY b.bucket"),
)
def _timeline_last_90(spark, sf_dir):
    """Over the committed events: the end of them is all that is read."""
    path = _store(spark, sf_dir).path
    start = timeline.last_buckets_start(timeline.time_span(scan_events(spark, path)))
    return timeline.timeline(scan_events(spark, path, start), since=start).withColumn("bucket", _ts("bucket"))


_RUNS = """SELECT *, lead(bucket) OVER (ORDER BY bucket) AS following FROM (SELECT time_bucket(INTERVAL 10 SECOND, ts) AS bucket,
  count(*) FILTER (severity = 'INFO') AS info, count(*) FILTER (severity = 'WARNING') AS warning, count(*) FILTER (severity = 'CRITICAL') AS critical
  FROM detected GROUP BY 1)"""


@query(
    "timeline_runs",
    o.with_detected(
        f"SELECT strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, 1::BIGINT AS buckets, info, warning, critical FROM ({_RUNS}) UNION ALL "
        "SELECT strftime(bucket + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S'), (epoch(following) - epoch(bucket))::BIGINT // 10 - 1, 0, 0, 0 "
        f"FROM ({_RUNS}) WHERE following > bucket + INTERVAL 10 SECOND"
    ),
)
def _timeline_runs(spark, sf_dir):
    """The timeline with each run of empty buckets as one row."""
    return timeline.timeline_runs(_table(spark, sf_dir)).withColumn("bucket", _ts("bucket"))


def _rate_sql(key: str, seconds: int, alias: str | None = None, life: int = 300) -> str:
    """Counts of a step in the windows that cover it, and zeros for ``life`` seconds after it."""
    copies = f"[{{'bucket': step - to_seconds(15 * k), 'n': CASE WHEN k >= 0 THEN n ELSE 0 END}} for k in range({-life // 15}, {seconds // 15})]"
    return f"""SELECT strftime(c.bucket, '%Y-%m-%d %H:%M:%S') AS bucket, {key} AS {alias or key}, round(sum(c.n) / {seconds}.0, 6) AS rate
      FROM (SELECT {key}, unnest({copies}) AS c FROM (SELECT {key}, time_bucket(INTERVAL 15 SECOND, ts) AS step, count(*) AS n
        FROM detected WHERE {key} IS NOT NULL GROUP BY ALL)) GROUP BY ALL"""


def _register_rates() -> None:
    for name, key, alias, seconds in (
        ("event_rate_by_severity", "severity", "severity", 60),
        ("event_rate_by_source", "source", "source", 60),
        ("rule_rate", "rule_triggered", "rule", 60),
        ("event_rate_5m", "severity", "severity", 300),
    ):
        query(name, o.with_detected(_rate_sql(key, seconds, alias)))(
            lambda spark, sf_dir, k=key, a=alias, s=seconds: timeline.rate_series(_with_rule(spark, sf_dir, k), k, s)
            .withColumnRenamed(k, a)
            .withColumn("bucket", _ts("bucket"))
        )


def _with_rule(spark, sf_dir, key: str) -> DataFrame:
    """Events to count by ``key``; by rule, only those that have one."""
    detected = _table(spark, sf_dir)
    return detected.where("rule_triggered IS NOT NULL") if key == "rule_triggered" else detected


_register_rates()


@query(
    "topk_rules",
    o.with_detected("SELECT rule_triggered AS rule, round(count(*) / 300.0, 6) AS rate FROM detected WHERE ts > (SELECT max(ts) FROM detected) - INTERVAL 300 SECOND AND rule_triggered IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"),
)
def _topk_rules(spark, sf_dir):
    path = _store(spark, sf_dir).path
    _, at = timeline.time_span(scan_events(spark, path))
    return timeline.topk_rules(scan_events(spark, path, at - timeline.timedelta(seconds=300), at), at)


@query(
    "topk_rules_per_window",
    o.with_detected(f"SELECT bucket, rule, rate, row_number() OVER (PARTITION BY bucket ORDER BY rate DESC, rule) AS rank FROM ({_rate_sql('rule_triggered', 300, 'rule', 0)}) QUALIFY rank <= 5"),
)
def _topk_rules_per_window(spark, sf_dir):
    return timeline.topk_rules_per_window(_table(spark, sf_dir)).withColumn("bucket", _ts("bucket"))


# ---- metric samples

# The increase from each sample to the next, if that comes no more than a range of steps later, and the time it took.
_COUNTER = """SELECT series, instance, mode, bucket, sum(grown) / sum(seconds) AS rate
  FROM (SELECT *, unnest([step - to_seconds({step} * k) for k in range({copies})]) AS bucket
    FROM (SELECT *, CASE WHEN value < prev THEN value ELSE value - prev END AS grown, epoch(ts) - epoch(prev_ts) AS seconds
      FROM (SELECT *, time_bucket(INTERVAL {step} SECOND, ts) AS step, lag(value) OVER w AS prev, lag(ts) OVER w AS prev_ts
            FROM samples WHERE {where} WINDOW w AS (PARTITION BY series ORDER BY ts, value))
      WHERE prev_ts >= step - INTERVAL 60 SECOND)) GROUP BY ALL HAVING sum(seconds) > 0"""


def _counter_sql(where: str, step: int) -> str:
    return _COUNTER.format(where=where, step=step, copies=60 // step)


@query(
    "counter_rate",
    o.with_samples(
        " UNION ALL ".join(
            f"SELECT '{way}' AS way, series, instance, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, round(rate, 6) AS rate "
            f"FROM ({_counter_sql(f"metric = 'node_network_{way}_bytes_total' AND series LIKE '%device=eth0%'", 15)})"
            for way in ("receive", "transmit")
        )
    ),
)
def _counter_rate(spark, sf_dir):
    """Both directions of one network device, in steps of 15 s over ranges of 60 s."""
    samples = metric_samples(spark, sf_dir)
    receive, transmit = (
        metrics.counter_rate(samples, f"node_network_{way}_bytes_total", 60, 15, {"device": "eth0"}).select(
            F.lit(way).alias("way"), "series", "instance", _ts("bucket"), "rate"
        )
        for way in ("receive", "transmit")
    )
    return receive.union(transmit)


@query(
    "cpu_usage_pct",
    o.with_samples("SELECT instance, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, round(100 - avg(rate) * 100, 4) AS cpu_usage_pct FROM (" + _counter_sql("metric = 'node_cpu_seconds_total' AND mode = 'idle'", 60) + ") GROUP BY ALL"),
)
def _cpu_usage_pct(spark, sf_dir):
    return metrics.cpu_usage_pct(metric_samples(spark, sf_dir)).withColumn("bucket", _ts("bucket"))


@query(
    "gauge_arith",
    o.with_samples("""SELECT a.series, a.instance, name, round(CASE name WHEN 'disk_used_pct' THEN 100 - a.value / nullif(b.value, 0) * 100 ELSE a.value - b.value END, 4) AS value
      FROM (VALUES ('uptime', 'node_time_seconds', 'node_boot_time_seconds'), ('memory_used', 'node_memory_MemTotal_bytes', 'node_memory_MemAvailable_bytes'),
            ('disk_used_pct', 'node_filesystem_avail_bytes', 'node_filesystem_size_bytes')) p(name, m1, m2)
      JOIN (SELECT series, instance, metric, max_by(value, ts) AS value FROM samples GROUP BY ALL) a ON a.metric = m1
      JOIN (SELECT series, metric, max_by(value, ts) AS value FROM samples GROUP BY ALL) b ON b.metric = m2 AND a.series = b.series"""),
)
def _gauge_arith(spark, sf_dir):
    return metrics.gauge_arith(metric_samples(spark, sf_dir))


@query("series_count", o.with_samples("SELECT count(DISTINCT series) AS series FROM samples WHERE metric = 'node_cpu_seconds_total' AND mode = 'idle'"))
def _series_count(spark, sf_dir):
    return metrics.series_count(metric_samples(spark, sf_dir))


# ---- listings

@query("project_event", o.with_detected('SELECT strftime(ts, \'%Y-%m-%dT%H:%M:%S\') AS "timestamp", source, raw, ip, "user", action, status, severity, rule_triggered, extra FROM detected'))
def _project_event(spark, sf_dir):
    return search.project_event(_table(spark, sf_dir))


@query(
    "project_display",
    o.with_detected("""SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp", coalesce(source, '-') AS source, coalesce(ip, '-') AS ip, coalesce("user", '-') AS "user",
      coalesce(action, '-') AS action, coalesce(status, '-') AS status, coalesce(severity, '-') AS severity, coalesce(rule_triggered, '-') AS rule_triggered FROM detected"""),
)
def _project_display(spark, sf_dir):
    return search.project_display(_table(spark, sf_dir))


def _latest_sql(n: int, where: str = "true") -> str:
    return f"(SELECT * FROM detected WHERE {where} ORDER BY ts DESC, seq DESC LIMIT {n})"


@query("latest_events", o.with_detected(f"SELECT {o.DETECTED_TEXT} FROM {_latest_sql(100)}"))
def _latest_events(spark, sf_dir):
    return _detected_text(search.latest_events(_newest(spark, sf_dir, search.DEFAULT_LIMIT)))


@query("validate_limit", o.with_detected(f"SELECT {o.DETECTED_TEXT} FROM {_latest_sql(1000)}"))
def _validate_limit(spark, sf_dir):
    """The largest limit that is accepted; the one above it is not."""
    events = _newest(spark, sf_dir, search.MAX_LIMIT)
    try:
        search.latest_events(events, search.MAX_LIMIT + 1)
    except ValueError:
        return _detected_text(search.latest_events(events, search.MAX_LIMIT))
    raise AssertionError("a limit out of bounds was accepted")


@query("search_events", o.with_detected("SELECT " + o.DETECTED_TEXT + " FROM " + _latest_sql(100, "severity = 'CRITICAL' AND source = 'auth'")))
def _search_events(spark, sf_dir):
    return _detected_text(search.search_events(_newest(spark, sf_dir, search.DEFAULT_LIMIT, "CRITICAL", "auth"), "CRITICAL", "auth"))


@query("latest_then_filter", o.with_detected(f"SELECT {o.DETECTED_TEXT} FROM {_latest_sql(50)} WHERE severity = 'CRITICAL'"))
def _latest_then_filter(spark, sf_dir):
    return _detected_text(search.latest_then_filter(_newest(spark, sf_dir, search.INITIAL_ROWS), severity="CRITICAL"))


@query("live_window_200", o.with_detected("SELECT " + o.DETECTED_TEXT + " FROM " + _latest_sql(200, "source = 'access'")))
def _live_window_200(spark, sf_dir):
    return _detected_text(search.live_window(_newest(spark, sf_dir, search.LIVE_ROWS, source="access"), source="access"))


# ---- streams: the whole table in time order, in steps, with a restart in between

def _stream(spark, sf_dir, rules: Callable[[int], Sequence[Rule]]) -> DetectionStream:
    # a step is a range of the table, so it must not hang on the row groups and files that hold it
    lines, base = log_lines(spark, sf_dir, spread=True), scratch_dir(spark, "stream")
    first, last = log_lines(spark, sf_dir).agg(F.min("seq"), F.max("seq")).first()
    for step in range(_STEPS):
        low, high = (first + (last + 1 - first) * k // _STEPS for k in (step, step + 1))
        lines.where((F.col("seq") >= low) & (F.col("seq") < high)).write.mode("append").options(**plain("line")).parquet(f"{base}/lines")
        job = DetectionStream(rules(step), f"{base}/out", ref_year=REF_YEAR)
        arriving = spark.readStream.schema(lines.schema).parquet(f"{base}/lines")
        job.start(arriving, f"{base}/checkpoint", availableNow=True).awaitTermination()
    return job


@query("stream_detect_events", o.with_detected(f"SELECT {o.DETECTED_TEXT} FROM detected"))
def _stream_detect_events(spark, sf_dir):
    """What the stream has committed, read as the event table."""
    rules = _rules(spark)
    return _detected_text(scan_events(spark, f"{_stream(spark, sf_dir, lambda step: rules).out}/events"))


# What the rule file says after its change.
_CHANGES = {"ssh_brute_force": {"threshold": 3}, "firewall_drop_flood": {"threshold": 12}, "sudo_failed": {"severity": "CRITICAL"}}


def _changed_rules(spark) -> str:
    """Path of a rule file with the changes."""
    with open(rules_path()) as file:
        content = json.load(file)
    for rule in content["rules"]:
        change = _CHANGES.get(rule["name"], {})
        rule["severity"] = change.get("severity", rule["severity"])
        if "threshold" in change:
            rule["conditions"]["rate"]["threshold"] = change["threshold"]
    path = scratch_dir(spark, "rules")
    spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.text(path)
    return path


_SECOND_STEP = "c.seq >= (SELECT min(seq) + (max(seq) + 1 - min(seq)) // 2 FROM log_lines)"


@query("reload_rules", o.with_changed_rules(f"SELECT {o.DETECTED_TEXT} FROM detected", _SECOND_STEP, _CHANGES))
def _reload_rules(spark, sf_dir):
    """The setting names another rule file before the second step; the rate state of the first step is kept."""
    settings = [{}, {"RULES_PATH": _changed_rules(spark)}]
    stream = _stream(spark, sf_dir, lambda step: rules_from(load_rules(spark, rules_path(settings[step]))))
    return _detected_text(stream.outputs(spark, "events", EVENTS))


_IN_FORCE = datetime(2026, 5, 2, 2)


@query("rules_as_of", o.with_changed_rules(f"SELECT {o.DETECTED_TEXT} FROM detected", f"c.ts >= TIMESTAMP '{_IN_FORCE}'", _CHANGES))
def _rules_as_of(spark, sf_dir):
    """Each event by the rules in force at its time."""
    versions = rule_versions(spark, {None: None, _IN_FORCE: _changed_rules(spark)})
    return _detected_text(detect.detect_versions(_events(spark, sf_dir), versions))


@query("stream_live_window", o.with_detected("SELECT " + o.DETECTED_TEXT + " FROM " + _latest_sql(200, "source = 'access'")))
def _stream_live_window(spark, sf_dir):
    """The live view that the stream keeps, after its last batch."""
    rules = _rules(spark)
    return _detected_text(_stream(spark, sf_dir, lambda step: rules).live(spark, source="access"))


@query(
    "compact_events",
    o.with_detected("SELECT strftime(ts, '%Y-%m-%d') AS event_date, source, severity, count(*) AS n, 1::BIGINT AS files FROM detected GROUP BY ALL"),
)
def _compact_events(spark, sf_dir):
    """The stream's commits gathered: the same events, each day and source in one file at this size."""
    rules = _rules(spark)
    store = _stream(spark, sf_dir, lambda step: rules).store(spark)
    store.compact(keep=0)
    events = store.scan().withColumn("file", F.input_file_name())
    files = events.groupBy("event_date", "source").agg(F.count_distinct("file").alias("files"))
    counts = events.groupBy("event_date", "source", "severity").agg(F.count("*").alias("n"))
    return counts.join(files, ["event_date", "source"]).withColumn("event_date", F.col("event_date").cast("string"))


_LAST_RATED = """SELECT seq, e.ip, max_by(m.rule, rule_ord) AS rule_triggered, max_by(r.severity, rule_ord) AS severity
  FROM matches m JOIN rules r USING (rule_ord) JOIN events_p e USING (seq) WHERE r.threshold IS NOT NULL GROUP BY 1, 2"""


@query("rate_detection_stream", o.with_detected(_LAST_RATED))
def _rate_detection_stream(spark, sf_dir):
    rated = rate_rules(_rules(spark))
    fired = _stream(spark, sf_dir, lambda step: rated).outputs(spark, "events", EVENTS).where("rule_triggered IS NOT NULL")
    return fired.select("seq", "ip", "rule_triggered", "severity")


@query("stream_error_isolation", _REJECTED)
def _stream_error_isolation(spark, sf_dir):
    """Lines that fit no format are set aside; the rest of the batch goes on."""
    rules = _rules(spark)
    rejected = _stream(spark, sf_dir, lambda step: rules).outputs(spark, "rejected", log_lines(spark, sf_dir).schema)
    return rejected.select("seq", "source", "line")


@query(
    "stream_tumbling_timeline",
    o.with_detected(
        "SELECT strftime(time_bucket(INTERVAL 10 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS bucket, count(*) FILTER (severity = 'INFO') AS info, "
        "count(*) FILTER (severity = 'WARNING') AS warning, count(*) FILTER (severity = 'CRITICAL') AS critical FROM detected GROUP BY 1"
    ),
)
def _stream_tumbling_timeline(spark, sf_dir):
    rules = _rules(spark)
    return stream_timeline(spark, _stream(spark, sf_dir, lambda step: rules).out).withColumn("bucket", _ts("bucket"))


@query("stream_running_totals", o.with_detected("SELECT severity, count(*) AS total FROM detected GROUP BY severity"))
def _stream_running_totals(spark, sf_dir):
    rules = _rules(spark)
    return stream_totals(spark, _stream(spark, sf_dir, lambda step: rules).out)
