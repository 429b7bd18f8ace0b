"""DuckDB statements that state the expected result of every query independently.

Each statement is complete: it derives the lines, parses them with DuckDB's own
regex dialect, and evaluates the rules by plain joins. The rate is counted by a
self-join, not by the row-distance argument of the Spark job.
"""

from __future__ import annotations

import json

from vigilog.functions.http import WEB_SHELLS
from vigilog.sources.fixture import REF_YEAR, log_lines_sql, metric_samples_sql
from vigilog.sources.rules import DEFAULT_RULES

_STAMP = r"^(\w+)\s+(\d+)\s+([\d:]+)\s+"
_SYSLOG_TS = f"try_strptime(g.mon || ' ' || g.day || ' {REF_YEAR} ' || g.tim, '%b %d %Y %H:%M:%S')"

_COLUMNS = "seq, ts, source, raw, ip, \"user\", action, status, severity, path, direction, extra"

_AUTH = rf"""
SELECT seq, {_SYSLOG_TS} AS ts, source, raw,
  CASE kind WHEN 1 THEN f.ip WHEN 2 THEN a.ip WHEN 3 THEN i.ip END AS ip,
  CASE kind WHEN 1 THEN f.u WHEN 2 THEN a.u WHEN 3 THEN i.u END AS "user",
  CASE kind WHEN 1 THEN 'failed_login' WHEN 2 THEN 'login' WHEN 3 THEN 'invalid_user' ELSE 'other' END AS action,
  CASE kind WHEN 1 THEN 'FAILED' WHEN 2 THEN 'SUCCESS' WHEN 3 THEN 'FAILED' END AS status,
  CASE WHEN kind IN (1, 3) THEN 'WARNING' ELSE 'INFO' END AS severity,
  NULL::VARCHAR AS path, NULL::VARCHAR AS direction, '{{}}' AS extra
FROM (
  SELECT *, CASE WHEN f.u <> '' THEN 1 WHEN a.u <> '' THEN 2 WHEN i.u <> '' THEN 3 ELSE 0 END AS kind
  FROM (
    SELECT *, regexp_extract(g.msg, 'Failed password for (?:invalid user )?(\S+) from ([\d.]+)', ['u','ip']) AS f,
      regexp_extract(g.msg, 'Accepted password for (\S+) from ([\d.]+)', ['u','ip']) AS a,
      regexp_extract(g.msg, 'Invalid user (\S+) from ([\d.]+)', ['u','ip']) AS i
    FROM (SELECT seq, source, trim(line) AS raw,
            regexp_extract(trim(line), '{_STAMP}\S+\s+\S+:\s+(.+)', ['mon','day','tim','msg']) AS g
          FROM log_lines WHERE source = 'auth')
    WHERE g.msg <> ''))
"""

# What marks a path as an attack, in this dialect (a quote is doubled in SQL).
_SQLI = (
    r"(?:union[\s+]+select|select[\s+]+.*from|insert[\s+]+into|delete[\s+]+from|drop[\s+]+table|update[\s+]+.*set)",
    r"(?:''[\s+]*or[\s+]+''1''[\s+]*=[\s+]*''1|''[\s+]*or[\s+]+1[\s+]*=[\s+]*1|''[\s+]*--)",
    r"(?:;[\s+]*(?:drop|delete|insert|update|alter)[\s+])",
)
_XSS = (
    r"<script[^>]*>",
    r"javascript\s*:",
    r"on(?:error|load|click|mouseover)\s*=",
    r"<img[^>]+onerror",
)


def _attack(path: str) -> str:
    shells = " OR ".join(f"ends_with(lower({path}), '{suffix}')" for suffix in WEB_SHELLS)
    return (
        f"CASE WHEN regexp_matches({path}, '(?i){'|'.join(_SQLI)}') THEN 'sql_injection' "
        f"WHEN regexp_matches({path}, '(?i){'|'.join(_XSS)}') THEN 'xss_attempt' WHEN {shells} THEN 'web_shell' END"
    )


_ACCESS = rf"""
SELECT seq, try_strptime(regexp_extract(g.tim, '^(\S+) [+-]\d{{4}}$', 1), '%d/%b/%Y:%H:%M:%S') AS ts, source, raw, g.ip AS ip,
  NULL::VARCHAR AS "user", coalesce(attack, g.method) AS action, g.status AS status,
  CASE WHEN attack IS NOT NULL OR CAST(g.status AS INT) >= 500 THEN 'CRITICAL'
       WHEN CAST(g.status AS INT) >= 400 THEN 'WARNING' ELSE 'INFO' END AS severity,
  g.path AS path, NULL::VARCHAR AS direction,
  '{{"path":' || to_json(g.path) || ',"size":"' || g.size || '"}}' AS extra
FROM (SELECT *, {_attack('g.path')} AS attack
  FROM (SELECT seq, source, trim(line) AS raw,
    regexp_extract(trim(line), '^([\d.]+) \S+ \S+ \[([^\]]+)\] "(\S+) (\S+) \S+" (\d+) (\d+)', ['ip','tim','method','path','status','size']) AS g
    FROM log_lines WHERE source = 'access')
  WHERE g.ip <> '')
"""

_FIREWALL = rf"""
SELECT seq, {_SYSLOG_TS} AS ts, source, raw, g.src AS ip, NULL::VARCHAR AS "user", act AS action, act AS status,
  CASE WHEN act = 'DROP' THEN 'WARNING' ELSE 'INFO' END AS severity, NULL::VARCHAR AS path, dir AS direction,
  '{{"dst":"' || g.dst || '","proto":"' || g.proto || '","src_port":"' || g.spt || '","dst_port":"' || g.dpt ||
  '","direction":"' || dir || '","in_iface":"' || g.inf || '","out_iface":"' || g.outf || '"}}' AS extra
FROM (SELECT *, CASE WHEN contains(g.label, 'BLOCK') OR contains(g.label, 'DROP') THEN 'DROP'
    WHEN contains(g.label, 'ALLOW') OR contains(g.label, 'ACCEPT') THEN 'ACCEPT' ELSE g.label END AS act,
    CASE WHEN g.inf <> '' AND g.outf = '' THEN 'inbound' ELSE 'outbound' END AS dir
  FROM (SELECT seq, source, trim(line) AS raw,
    regexp_extract(trim(line), '{_STAMP}\S+\s+kernel:\s+\[([^\]]+)\]\s+IN=(\S*)\s+OUT=(\S*)\s+(?:MAC=\S*\s+)?SRC=([\d.]+)\s+DST=([\d.]+)\s+.*?PROTO=(\S+)\s+(?:SPT=(\d+)\s+)?(?:DPT=(\d+))?',
      ['mon','day','tim','label','inf','outf','src','dst','proto','spt','dpt']) AS g
    FROM log_lines WHERE source = 'firewall')
  WHERE g.src <> '')
"""

_SYSLOG = rf"""
SELECT seq, {_SYSLOG_TS} AS ts, source, raw, NULL::VARCHAR AS ip,
  CASE kind WHEN 'sudo_command' THEN c.u WHEN 'sudo_failed' THEN s WHEN 'user_added' THEN n END AS "user",
  CASE WHEN kind = 'service' THEN 'service_' || lower(v.verb) ELSE kind END AS action,
  CASE kind WHEN 'sudo_command' THEN 'SUCCESS' WHEN 'sudo_failed' THEN 'FAILED' END AS status,
  CASE WHEN kind IN ('sudo_failed', 'user_added') OR (kind = 'service' AND v.verb = 'Stopped') THEN 'WARNING' ELSE 'INFO' END AS severity,
  NULL::VARCHAR AS path, NULL::VARCHAR AS direction,
  '{{"program":"' || g.prog || '","hostname":"' || g.host || '"' ||
  CASE kind WHEN 'sudo_command' THEN ',"target_user":"' || c.t || '","command":' || to_json(c.cmd)
    WHEN 'service' THEN ',"service":' || to_json(v.svc) ELSE '' END || '}}' AS extra
FROM (SELECT *, CASE WHEN g.prog = 'sudo' THEN CASE WHEN c.u <> '' THEN 'sudo_command' WHEN s <> '' THEN 'sudo_failed' ELSE 'sudo_other' END
    WHEN v.verb <> '' THEN 'service' WHEN n <> '' THEN 'user_added' ELSE 'syslog_other' END AS kind
  FROM (SELECT *, regexp_extract(g.msg, '(\S+)\s+:\s+TTY=\S+\s+;\s+PWD=\S+\s+;\s+USER=(\S+)\s+;\s+COMMAND=(.+)', ['u','t','cmd']) AS c,
      regexp_extract(g.msg, '(\S+)\s+:\s+[^;]*authentication failure', 1) AS s,
      regexp_extract(g.msg, '(Stopped|Started|Stopping|Starting)\s+(.+)', ['verb','svc']) AS v,
      regexp_extract(g.msg, 'new user:\s+name=([^\s,]+)', 1) AS n
    FROM (SELECT seq, source, trim(line) AS raw,
      regexp_extract(trim(line), '{_STAMP}(\S+)\s+(\S+?)(?:\[\d+\])?:\s+(.+)', ['mon','day','tim','host','prog','msg']) AS g
      FROM log_lines WHERE source = 'syslog')
    WHERE g.msg <> ''))
"""

_FIM = r"""
SELECT seq, try_strptime(g.stamp[1:19], '%Y-%m-%dT%H:%M:%S') AS ts, source, raw, NULL::VARCHAR AS ip, NULL::VARCHAR AS "user",
  g.act AS action, NULL::VARCHAR AS status, CASE WHEN g.act IN ('modified', 'deleted') THEN 'WARNING' ELSE 'INFO' END AS severity,
  g.path AS path, NULL::VARCHAR AS direction,
  '{"path":' || to_json(g.path) || ',"uid":"' || g.uid || '","gid":"' || g.gid || '","md5":"' || g.md5 || '","sha256":"' || g.sha || '"}' AS extra
FROM (SELECT seq, source, trim(line) AS raw,
  regexp_extract(trim(line), '^(\S+)\s+fim:\s+action=(\S+)\s+path=(\S+)(?:\s+uid=(\d+))?(?:\s+gid=(\d+))?(?:\s+md5=(\S+))?(?:\s+sha256=(\S+))?',
    ['stamp','act','path','uid','gid','md5','sha']) AS g
  FROM log_lines WHERE source = 'fim')
WHERE g.path <> ''
"""

PARSERS = {"auth": _AUTH, "access": _ACCESS, "firewall": _FIREWALL, "syslog": _SYSLOG, "fim": _FIM}


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _rules() -> list[dict]:
    with open(DEFAULT_RULES) as file:
        return json.load(file)["rules"]


def _condition(cond: dict) -> str:
    tests = [f'e."{k}" = {_text(cond[k])}' for k in ("source", "action", "status", "user", "direction") if k in cond]
    if "path_match" in cond:
        tests.append("(" + " OR ".join(f"starts_with(e.path, {_text(p)})" for p in cond["path_match"]) + ")")
    if "time_range" in cond:
        hours = cond["time_range"]
        tests.append(f"hour(e.ts) >= {hours['start_hour']} AND hour(e.ts) < {hours['end_hour']}")
    return " AND ".join(tests)


def rules_cte() -> str:
    rows = [
        f"({i}, {r['rule_id']}, {_text(r['name'])}, {_text(r['description'])}, {_text(r['severity'])}, {_text(r['mitre_id'])}, "
        f"{_text(r['mitre_tactic'])}, {r['conditions'].get('rate', {}).get('threshold', 'NULL')}, {r['conditions'].get('rate', {}).get('window_seconds', 'NULL')})"
        for i, r in enumerate(_rules())
    ]
    return (
        "rules AS (SELECT * FROM (VALUES " + ", ".join(rows)
        + ") t(rule_ord, rule_id, name, description, severity, mitre_id, mitre_tactic, threshold, window_seconds))"
    )


def with_lines(select: str) -> str:
    return f"WITH log_lines AS ({log_lines_sql(duckdb=True)}) {select}"


def _events_ctes() -> list[str]:
    union = " UNION ALL ".join(f"SELECT {_COLUMNS} FROM ({sql})" for sql in PARSERS.values())
    timed = f"SELECT p.* REPLACE (coalesce(p.ts, l.ingest_ts) AS ts) FROM ({union}) p JOIN log_lines l USING (seq)"
    return [f"log_lines AS MATERIALIZED ({log_lines_sql(duckdb=True)})", f"events_p AS MATERIALIZED ({timed})"]


def with_events(select: str) -> str:
    """``events_p``: parsed events."""
    return f"WITH {', '.join(_events_ctes())} {select}"


def _match_ctes(later: str | None = None, changes: dict[str, dict] | None = None) -> list[str]:
    """``later``: SQL on the candidate ``c`` for the time of the changed rules; ``changes``: their threshold or severity by name."""
    threshold, severity = "r.threshold", "r.severity"
    for name, change in (changes or {}).items():
        at = f"CASE WHEN r.name = '{name}' AND {later} THEN"
        threshold = f"{at} {change['threshold']} ELSE {threshold} END" if "threshold" in change else threshold
        severity = f"{at} '{change['severity']}' ELSE {severity} END" if "severity" in change else severity
    pairs = " UNION ALL ".join(
        f"SELECT e.seq, e.ts, e.ip, {i} AS rule_ord FROM events_p e WHERE {_condition(r['conditions'])}" for i, r in enumerate(_rules())
    )
    return [
        *_events_ctes(),
        rules_cte(),
        f"candidates AS MATERIALIZED ({pairs})",
        """counted AS MATERIALIZED (
          SELECT a.seq, a.rule_ord, count(*) AS n
          FROM (SELECT c.*, window_seconds FROM candidates c JOIN rules USING (rule_ord) WHERE threshold IS NOT NULL) a
          JOIN candidates b ON a.rule_ord = b.rule_ord AND a.ip IS NOT DISTINCT FROM b.ip
            AND b.ts BETWEEN a.ts - to_seconds(a.window_seconds) AND a.ts AND (b.ts < a.ts OR b.seq <= a.seq)
          GROUP BY ALL)""",
        f"""matches AS MATERIALIZED (
          SELECT c.seq, c.rule_ord, r.name AS rule, {severity} AS rule_severity
          FROM candidates c JOIN rules r USING (rule_ord) LEFT JOIN counted k ON k.seq = c.seq AND k.rule_ord = c.rule_ord
          WHERE r.threshold IS NULL OR k.n >= {threshold})""",
        """detected AS MATERIALIZED (
          SELECT e.* EXCLUDE (severity), coalesce(m.sev, e.severity) AS severity, m.rule AS rule_triggered
          FROM events_p e LEFT JOIN (SELECT seq, max_by(rule, rule_ord) AS rule, max_by(rule_severity, rule_ord) AS sev
                                     FROM matches GROUP BY seq) m USING (seq))""",
    ]


def with_detected(select: str, *ctes: str) -> str:
    """``candidates`` (no rates), ``matches`` (all conditions), ``detected`` (last match wins)."""
    return f"WITH {', '.join([*_match_ctes(), *ctes])} {select}"


def with_changed_rules(select: str, later: str, changes: dict[str, dict]) -> str:
    """As ``with_detected``, by rules that change where ``later`` holds."""
    return f"WITH {', '.join(_match_ctes(later, changes))} {select}"


def with_samples(select: str) -> str:
    """``samples`` with the series as text, like Spark's ordered labels."""
    return f"""WITH raw_samples AS ({metric_samples_sql(duckdb=True)}),
    samples AS MATERIALIZED (SELECT ts, metric, instance, mode, value,
      CASE WHEN unit = '' THEN '' WHEN metric LIKE '%cpu%' THEN 'cpu=' || unit || ',' WHEN metric LIKE '%network%' THEN 'device=' || unit || ',' ELSE '' END
      || 'instance=' || instance || CASE WHEN mode <> '' THEN ',mode=' || mode ELSE '' END
      || CASE WHEN unit <> '' AND metric LIKE '%filesystem%' THEN ',mountpoint=' || unit ELSE '' END AS series
      FROM raw_samples)
    {select}"""


TS_TEXT = "strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts"
EVENT_TEXT = f'seq, {TS_TEXT}, source, raw, ip, "user", action, status, severity, path, direction, extra'
DETECTED_TEXT = f'seq, {TS_TEXT}, source, ip, "user", action, status, severity, rule_triggered'
