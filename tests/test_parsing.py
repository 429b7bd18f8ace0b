"""Literal lines and what must become of them."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vigilog import normalize_events, rejected_lines
from vigilog.functions.http import classify_http_attack
from vigilog.functions.text import FLAGS, NS, S
from vigilog.functions.timestamps import epoch_micros, format_iso
from vigilog.operators.normalize import parse_lines

AUTH = "May 21 10:23:45 server sshd[1234]: "
ACCESS = '1.2.3.4 - - [21/May/2026:10:23:45 +0000] "{} HTTP/1.1" {} {}'
FW = "May 23 10:15:30 firewall kernel: [{}] {} SRC={} DST=192.168.1.1 LEN=60 TTL=64 ID=5 {}"
SYS = "May 23 09:15:22 server "
SUDO = SYS + "sudo: ubuntu : TTY=pts/0 ; PWD=/home/ubuntu ; USER=root ; COMMAND=/bin/cat /etc/shadow"

INGEST = datetime(2026, 7, 1, 12, 0)
AT = datetime(2026, 5, 21, 10, 23, 45)

# name: (source, line, expected columns); None means rejected
CASES = {
    "failed": ("auth", AUTH + "Failed password for root from 1.2.3.4 port 22",
               dict(action="failed_login", status="FAILED", severity="WARNING", user="root", ip="1.2.3.4", ts=AT, ts_inferred=False, extra={})),
    "failed_invalid": ("auth", AUTH + "Failed password for invalid user nobody from 5.6.7.8 port 22", dict(action="failed_login", user="nobody", ip="5.6.7.8")),
    "accepted": ("auth", AUTH + "Accepted password for admin from 1.2.3.4 port 22", dict(action="login", status="SUCCESS", severity="INFO", user="admin")),
    "invalid": ("auth", AUTH + "Invalid user testuser from 5.6.7.8", dict(action="invalid_user", status="FAILED", severity="WARNING", user="testuser")),
    "other": ("auth", AUTH + "Server listening on 0.0.0.0 port 22", dict(action="other", status=None, severity="INFO", ip=None, user=None)),
    "ipv6": ("auth", AUTH + "Failed password for root from 2001:db8::1 port 22", dict(ip="2001")),
    "bad_day": ("auth", "Feb 30 10:23:45 server sshd[1]: Invalid user a from 1.1.1.1", dict(action="invalid_user", ts=INGEST, ts_inferred=True)),
    "no_month": ("auth", "Foo 3 10:23:45 server sshd[1]: x", dict(action="other", ts=INGEST, ts_inferred=True)),
    "full_month": ("auth", "June 3 10:23:45 server sshd[1]: x", dict(ts_inferred=True)),
    "short_time": ("auth", "jun 3 9:1:2 server sshd[1]: x", dict(ts=datetime(2026, 6, 3, 9, 1, 2), ts_inferred=False)),
    "two_part_time": ("auth", "Jun 3 10:23 server sshd[1]: x", dict(ts_inferred=True)),
    "precedence": ("auth", AUTH + "Invalid user x from 9.9.9.9 Failed password for y from 8.8.8.8", dict(action="failed_login", user="y")),
    "padded": ("auth", " \t" + AUTH + "Invalid user a from 1.1.1.1 　", dict(raw=AUTH + "Invalid user a from 1.1.1.1")),
    "nbsp": ("auth", "Mär 21 10:23:45 server sshd[1]: Invalid user a from 1.1.1.1", dict(action="invalid_user", ts_inferred=True)),
    "carriage_return": ("auth", AUTH + "note\rInvalid user a from 1.1.1.1", dict(action="invalid_user")),
    "separator_inside": ("auth", AUTH + "odd\x1ftext\x1fhere", dict(action="other", ip=None)),
    "separator_command": ("syslog", SYS + "sudo: u : TTY=a ; PWD=b ; USER=c ; COMMAND=x\x1fy\x1fz", dict(extra={"program": "sudo", "hostname": "server", "target_user": "c", "command": "x\x1fy\x1fz"})),
    "page": ("access", ACCESS.format("GET /index.html", 200, 512), dict(action="GET", status="200", severity="INFO", path="/index.html", ip="1.2.3.4", ts=AT, extra={"path": "/index.html", "size": "512"})),
    "moved": ("access", ACCESS.format("GET /old", 301, 0), dict(severity="INFO")),
    "bad_request": ("access", ACCESS.format("GET /bad", 400, 50), dict(severity="WARNING")),
    "missing": ("access", ACCESS.format("GET /missing", 404, 0), dict(severity="WARNING", status="404")),
    "error": ("access", ACCESS.format("POST /api", 500, 100), dict(severity="CRITICAL", action="POST")),
    "huge_status": ("access", ACCESS.format("GET /", "9" * 50, 1), dict(severity="CRITICAL", status="9" * 50)),
    "sqli": ("access", ACCESS.format("GET /api/users?id=1'+OR+'1'='1", 200, 512), dict(action="sql_injection", severity="CRITICAL")),
    "xss": ("access", ACCESS.format("GET /search?q=<script>alert(1)</script>", 200, 256), dict(action="xss_attempt", severity="CRITICAL")),
    "shell": ("access", ACCESS.format("GET /c99.php", 200, 1024), dict(action="web_shell", severity="CRITICAL")),
    "shell_case": ("access", ACCESS.format("GET /up/WSO.PHP", 200, 1024), dict(action="web_shell")),
    "shell_query": ("access", ACCESS.format("GET /c99.php?x=1", 200, 1024), dict(action="GET", severity="INFO")),
    "size_dash": ("access", ACCESS.format("GET /", 200, "-"), None),
    "bad_offset": ("access", '1.2.3.4 - - [21/May/2026:10:23:45 +9900] "GET / HTTP/1.1" 200 1', dict(ts=INGEST, ts_inferred=True)),
    "offset_dropped": ("access", '1.2.3.4 - - [21/may/2026:10:23:45 -0700] "GET / HTTP/1.1" 200 1', dict(ts=AT)),
    "no_offset": ("access", '1.2.3.4 - - [21/May/2026:10:23:45] "GET / HTTP/1.1" 200 1', dict(ts_inferred=True)),
    "block": ("firewall", FW.format("UFW BLOCK", "IN=eth0 OUT= MAC=00:0c:29", "45.33.32.156", "PROTO=TCP SPT=45678 DPT=22"),
              dict(action="DROP", status="DROP", severity="WARNING", ip="45.33.32.156", direction="inbound",
                   extra={"dst": "192.168.1.1", "proto": "TCP", "src_port": "45678", "dst_port": "22", "direction": "inbound", "in_iface": "eth0", "out_iface": ""})),
    "allow": ("firewall", FW.format("UFW ALLOW", "IN=eth0 OUT=", "10.0.0.5", "PROTO=TCP SPT=1 DPT=80"), dict(action="ACCEPT", severity="INFO")),
    "outbound": ("firewall", FW.format("UFW BLOCK", "IN= OUT=eth0", "192.168.1.1", "PROTO=TCP SPT=1 DPT=4444"), dict(direction="outbound")),
    "forwarded": ("firewall", FW.format("UFW BLOCK", "IN=eth0 OUT=eth1", "192.168.1.1", "PROTO=TCP SPT=1 DPT=4444"), dict(direction="outbound")),
    "audit": ("firewall", FW.format("UFW\x1fAUDIT x", "IN=eth0 OUT=", "10.0.0.5", "PROTO=UDP "), None),
    "audit_icmp": ("firewall", FW.format("UFW\x1fAUDIT x", "IN=eth0 OUT=", "10.0.0.5", "PROTO=ICMP TYPE=8"),
                   dict(action="UFW\x1fAUDIT x", status="UFW\x1fAUDIT x", severity="INFO", direction="inbound")),
    "ends_after_proto": ("firewall", FW.format("UFW BLOCK", "IN=eth0 OUT=", "10.0.0.5", "PROTO=ICMP"), None),
    "sudo": ("syslog", SUDO, dict(action="sudo_command", status="SUCCESS", user="ubuntu", severity="INFO",
                                  extra={"program": "sudo", "hostname": "server", "target_user": "root", "command": "/bin/cat /etc/shadow"})),
    "sudo_failed": ("syslog", SYS + "sudo: admin : authentication failure ; logname= ; user=root", dict(action="sudo_failed", status="FAILED", severity="WARNING", user="admin")),
    "sudo_other": ("syslog", SYS + "sudo: Stopped thinking", dict(action="sudo_other", severity="INFO", user=None)),
    "stopped": ("syslog", SYS + "systemd[1]: Stopped nginx.service", dict(action="service_stopped", severity="WARNING", user=None, status=None,
                                                                         extra={"program": "systemd", "hostname": "server", "service": "nginx.service"})),
    "started": ("syslog", SYS + "systemd[1]: Started nginx.service", dict(action="service_started", severity="INFO")),
    "first_verb": ("syslog", SYS + "systemd[1]: Starting x then Stopped y", dict(action="service_starting", severity="INFO")),
    "useradd": ("syslog", SYS + "useradd[5432]: new user: name=deploy, UID=1001", dict(action="user_added", severity="WARNING", user="deploy")),
    "cron": ("syslog", SYS + "cron[2345]: (root) CMD (/bin/true)", dict(action="syslog_other", severity="INFO", extra={"program": "cron", "hostname": "server"})),
    "fim": ("fim", "2026-05-23T09:15:22+00:00 fim: action=modified path=/etc/passwd uid=0 gid=0 md5=abc sha256=def",
            dict(action="modified", severity="WARNING", path="/etc/passwd", ip=None, status=None, ts=datetime(2026, 5, 23, 9, 15, 22),
                 extra={"path": "/etc/passwd", "uid": "0", "gid": "0", "md5": "abc", "sha256": "def"})),
    "fim_created": ("fim", "2026-05-23T09:16:00+00:00 fim: action=created path=/tmp/t uid=1000", dict(severity="INFO")),
    "fim_deleted": ("fim", "2026-05-23T09:25:00+07:00 fim: action=deleted path=/var/log/a uid=0 gid=0",
                    dict(severity="WARNING", ts=datetime(2026, 5, 23, 9, 25), extra={"path": "/var/log/a", "uid": "0", "gid": "0", "md5": "", "sha256": ""})),
    "fim_fraction": ("fim", "2026-05-23T09:25:00.25Z fim: action=x path=/a", dict(ts=datetime(2026, 5, 23, 9, 25, 0, 250000))),
    "fim_basic": ("fim", "20260523T092501 fim: action=x path=/a", dict(ts=datetime(2026, 5, 23, 9, 25, 1))),
    "fim_date": ("fim", "2026-05-23 fim: action=x path=/a", dict(ts=datetime(2026, 5, 23))),
    "fim_bad": ("fim", "2026-5-3T1:2:3 fim: action=x path=/a", dict(ts=INGEST, ts_inferred=True)),
    "not_auth": ("auth", "not a log line", None),
    "not_access": ("access", "not a log line", None),
    "not_firewall": ("firewall", "not a log line", None),
    "not_syslog": ("syslog", "not a log line", None),
    "not_fim": ("fim", "not a log line", None),
    "empty": ("auth", "", None),
    "blank": ("access", "   ", None),
    "unknown_source": ("mail", AUTH + "Invalid user a from 1.1.1.1", None),
}


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(i, source, line) for i, (source, line, _) in enumerate(CASES.values())]
    return spark.createDataFrame(rows, "seq BIGINT, source STRING, line STRING").withColumn("ingest_ts", F.lit(INGEST))


@pytest.fixture(scope="module")
def parsed(lines):
    return {row.seq: row for row in normalize_events(lines, ref_year=2026).collect()}


@pytest.mark.parametrize("name", CASES)
def test_line(parsed, name):
    seq = list(CASES).index(name)
    source, line, expected = CASES[name]
    if expected is None:
        assert seq not in parsed
        return
    row = parsed[seq].asDict()
    assert row["source"] == source and row["rule_triggered"] is None
    assert row["raw"] == expected.get("raw", line)
    assert {k: row[k] for k in expected} == expected


def test_rejected_lines_are_the_complement(lines, parsed):
    rejected = {row.seq for row in rejected_lines(lines).collect()}
    assert rejected == {i for i, case in enumerate(CASES.values()) if case[2] is None}
    assert rejected.isdisjoint(parsed) and len(rejected) + len(parsed) == len(CASES)


def test_year_defaults_to_that_of_ingestion(lines):
    row = normalize_events(lines.where("seq = 0")).first()
    assert row.ts == AT.replace(year=INGEST.year)


def test_unknown_source_name_is_an_error(lines):
    with pytest.raises(ValueError):
        normalize_events(lines, sources=["mail"])


def test_wall_clock_does_not_depend_on_session_zone(spark, lines):
    zone = spark.conf.get("spark.sql.session.timeZone")
    gap = [(1, "auth", "Mar 8 02:30:00 server sshd[1]: x")]  # does not exist in New York
    df = spark.createDataFrame(gap, "seq BIGINT, source STRING, line STRING")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = normalize_events(df, ref_year=2026).select("ts", epoch_micros("ts").alias("us")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.ts == datetime(2026, 3, 8, 2, 30)
    assert row.us == (row.ts - datetime(1970, 1, 1)).total_seconds() * 1_000_000


def test_iso_text(spark):
    df = spark.createDataFrame([(datetime(2026, 5, 1),), (datetime(2026, 5, 1, 0, 0, 0, 1200),)], "ts TIMESTAMP_NTZ")
    assert [r[0] for r in df.select(format_iso(F.col("ts"))).collect()] == ["2026-05-01T00:00:00", "2026-05-01T00:00:00.001200"]


@pytest.mark.parametrize(
    "path, attack",
    [
        ("/x?q=UNION+SELECT+1", "sql_injection"), ("/x?q=select a from b", "sql_injection"), ("/x?q=admin'--", "sql_injection"),
        ("/x?id=1;+drop+x", "sql_injection"), ("/x?a='or+1=1&b=<script>", "sql_injection"), ("/x?b=<SCRIPT src=a>", "xss_attempt"),
        ("/x?b=javascript :x", "xss_attempt"), ("/x?onload=1", "xss_attempt"), ("/a/shell.php", "web_shell"), ("/a/shell.php.bak", None), ("/", None),
    ],
)
def test_attack_class(spark, path, attack):
    df = spark.createDataFrame([(path,)], "path STRING")
    assert df.select(classify_http_attack(F.col("path"))).first()[0] == attack


def test_blanks_are_the_unicode_ones(spark):
    """The classes that most characters pass at their first member hold the same characters as the plain ones."""
    text = spark.createDataFrame([(chr(i),) for i in range(0x3100) if not 0xD800 <= i < 0xE000], "c string")
    for quick, plain in ((S, r"[\s\x1c-\x1f]"), (NS, r"[^\s\x1c-\x1f]")):
        both = text.select(*[F.col("c").rlike(f"{FLAGS}^{p}\\z").alias(n) for n, p in (("quick", quick), ("plain", plain))])
        assert both.where("quick != plain").count() == 0 and both.where("quick").count() > 20


def test_where_all_lines_stay_the_groups_are_a_plain_column(spark):
    lines = spark.createDataFrame([(1, "auth", AUTH + "Invalid user a from 1.1.1.1"), (2, "auth", "broken")], "seq long, source string, line string")
    parsed = parse_lines(lines, ref_year=2026)
    assert "Generate" not in parsed._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in parsed.orderBy("seq").select("seq", "is_event", "action", "line").collect()] == [(1, True, "invalid_user", None), (2, False, None, "broken")]
