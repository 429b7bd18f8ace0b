"""Test input derived by Spark from the driver's ``events`` table (FIXTURES.md §3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REF_YEAR = 2026

# The same text serves Spark and DuckDB apart from the date expressions.
_LINES = """
WITH a AS (
  SELECT event_id e, user_id u, event_type t,
    CAST(FLOOR(event_id/1000) AS BIGINT)*3600 + CAST(FLOOR((event_id%1000)/100) AS BIGINT) n,
    (event_id*37+user_id)%100 r, event_id%10 d, least(user_id%16,4) k
  FROM {events}),
b AS (
  SELECT *, CASE WHEN e%89=0 THEN replace({syslog_date},'May 0','Feb 3') ELSE {syslog_date} END sy,
    CASE WHEN e%83=0 THEN replace({clf_date},'2026','20x6') ELSE {clf_date} END clf, {iso_date} iso, {ingest} ingest_ts,
    '10.0.0.' || CAST(10+k AS STRING) ip,
    split_part('root|carol|mina|oscar|deploybot|svc_batch','|',CAST(u%6 AS INT)+1) usr
  FROM a)
SELECT e AS seq,
CASE t WHEN 'signup' THEN 'auth' WHEN 'view' THEN 'access' WHEN 'click' THEN 'firewall' WHEN 'purchase' THEN 'syslog' ELSE 'fim' END AS source,
CASE WHEN e%97=0 THEN '??? corrupted record ' || CAST(e AS STRING)
WHEN t='signup' THEN sy || ' server sshd[' || CAST(1000+e%9000 AS STRING) || ']: ' ||
  CASE WHEN r<60 THEN CASE WHEN d=0 THEN 'Failed password for invalid user ' ELSE 'Failed password for ' END || usr || ' from ' || ip || ' port 22'
   WHEN r<85 THEN 'Accepted password for ' || usr || ' from ' || ip || ' port 22'
   WHEN r<95 THEN 'Invalid user ' || usr || ' from ' || ip
   ELSE 'Server listening on 0.0.0.0 port 22' END
WHEN t='view' THEN ip || ' - - [' || clf || ' +0000] "' || split_part('GET|POST|HEAD|PATCH','|',CAST(e%4 AS INT)+1) || ' ' ||
  CASE WHEN r<5 THEN replace(split_part('/items?ref=7~+or+~1~=~1|/notes?by=mina~+--|/report?day=2;+delete+from+audit|/find?key=9+union+select+name+from+staff|/cart?sum=3~+or+1=1','|',CAST(r AS INT)+1),'~',chr(39))
   WHEN r<8 THEN replace(split_part('/note?text=<script>go(~a~)</script>|/pic?u=<img+src=q+onerror=go(2)>|/link?to=javascript:go(location)','|',CAST(r-5 AS INT)+1),'~',chr(39))
   WHEN r<10 THEN split_part('/cmd.php|/files/B374K.php','|',CAST(r-8 AS INT)+1)
   ELSE split_part('/|/health|/reports/daily|/cart|/static/app.js|/server-status|/feed.xml','|',CAST(e%7 AS INT)+1) END || ' HTTP/1.1" ' ||
  CASE WHEN r<10 THEN '200' ELSE split_part('200|200|200|200|200|301|403|404|404|500','|',CAST(d AS INT)+1) END || ' ' || CAST(100+e%4900 AS STRING)
WHEN t='click' THEN sy || ' firewall kernel: [' || CASE WHEN r<65 THEN 'UFW BLOCK' WHEN r>=97 THEN 'UFW AUDIT' ELSE 'UFW ALLOW' END || ']' ||
  CASE WHEN d<7 THEN ' IN=eth0 OUT=' ELSE ' IN= OUT=eth0' END || CASE WHEN e%3=0 THEN ' MAC=00:0c:29:68:a1:b2' ELSE '' END ||
  ' SRC=' || ip || ' DST=192.168.1.1 LEN=60 TOS=0x00 PREC=0x00 TTL=64 ID=' || CAST(1000+e%60000 AS STRING) || ' PROTO=' ||
  CASE WHEN e%11=0 THEN 'ICMP TYPE=8 CODE=0'
   ELSE split_part('TCP|UDP','|',CAST(e%2 AS INT)+1) || ' SPT=' || CAST(1024+e%60000 AS STRING) || ' DPT=' || split_part('22|53|443|8081|6667','|',CAST(e%5 AS INT)+1) END
WHEN t='purchase' THEN sy || ' server ' ||
  CASE WHEN r<30 THEN 'sudo: ' || usr || ' : TTY=pts/0 ; PWD=/home/' || usr || ' ; USER=root ; COMMAND=' || split_part('/usr/bin/less /var/log/secure|/usr/bin/systemctl restart cron|/usr/sbin/usermod -L mina','|',CAST(e%3 AS INT)+1)
   WHEN r<40 THEN 'sudo: ' || usr || ' : authentication failure ; logname= ; uid=1000 ; euid=0 ; tty=/dev/pts/0 ; ruser=' || usr || ' ; rhost= ; user=root'
   WHEN r<55 THEN 'systemd[1]: Stopped ' || split_part('postfix.service|cron.service','|',CAST(e%2 AS INT)+1)
   WHEN r<75 THEN 'systemd[1]: Started ' || split_part('postfix.service|cron.service','|',CAST(e%2 AS INT)+1)
   WHEN r<80 THEN 'useradd[' || CAST(1000+e%9000 AS STRING) || ']: new user: name=' || split_part('oscar|temp1|contractor','|',CAST(e%3 AS INT)+1) || ', UID=1001, GID=1001, home=/home/x, shell=/bin/bash'
   ELSE 'cron[' || CAST(1000+e%9000 AS STRING) || ']: (root) CMD (/opt/jobs/rotate.sh)' END
ELSE replace(iso,' ','T') || '+00:00 fim: action=' ||
  CASE WHEN r<50 THEN 'modified' WHEN r<70 THEN 'created' WHEN r<80 THEN 'deleted' ELSE 'attributes_changed' END || ' path=' ||
  CASE WHEN e%20<3 THEN split_part('/etc/passwd|/etc/shadow|/etc/sudoers','|',CAST(e%20 AS INT)+1)
   WHEN e%20<5 THEN split_part('/usr/bin/ssh|/usr/sbin/sshd','|',CAST(e%20-3 AS INT)+1)
   ELSE split_part('/srv/data/report.csv|/opt/app/config.yml|/home/carol/.profile|/etc/fstab','|',CAST(e%4 AS INT)+1) END ||
  ' uid=' || split_part('0|1000','|',CAST(e%2 AS INT)+1) || ' gid=' || split_part('0|1000','|',CAST(e%2 AS INT)+1) ||
  CASE WHEN r>=70 AND r<80 THEN '' ELSE ' md5=' || md5(CAST(e AS STRING)) || ' sha256=' || md5(CAST(e AS STRING)) || md5(CAST(u AS STRING)) END
END AS line, ingest_ts
FROM b
"""

# Host-style samples: counters (with resets) and gauges of four instances.
_SAMPLES = """
SELECT {base} AS ts,
  CASE event_type WHEN 'click' THEN 'node_cpu_seconds_total' WHEN 'view' THEN 'node_network_receive_bytes_total'
    WHEN 'signup' THEN 'node_network_transmit_bytes_total'
    WHEN 'purchase' THEN split_part('node_time_seconds|node_boot_time_seconds|node_memory_MemTotal_bytes','|',CAST(event_id%3 AS INT)+1)
    ELSE split_part('node_memory_MemAvailable_bytes|node_filesystem_size_bytes|node_filesystem_avail_bytes','|',CAST(event_id%3 AS INT)+1) END AS metric,
  'host' || CAST(user_id%4 AS STRING) AS instance,
  CASE WHEN event_type='click' THEN CAST(event_id%2 AS STRING) WHEN event_type IN ('view','signup') THEN 'eth0'
    WHEN event_type='error' AND event_id%3>0 THEN '/' ELSE '' END AS unit,
  CASE WHEN event_type='click' THEN split_part('idle|user','|',CAST(event_id%5%2 AS INT)+1) ELSE '' END AS mode,
  event_id AS seq,
  CASE WHEN event_type IN ('click','view','signup') THEN CAST((event_id*7)%4001 AS DOUBLE)
    WHEN event_type='purchase' THEN CAST(1000000+event_id*(3-event_id%3) AS DOUBLE)
    ELSE CAST(1000+event_id%(1+event_id%3)*100+event_id%89 AS DOUBLE) END AS value
FROM {events}
"""

_SECONDS = "CAST(FLOOR(event_id/1000) AS BIGINT)*3600 + event_id%1000"


def _spark_date(fmt: str) -> str:
    return f"date_format(TIMESTAMP_NTZ'2026-05-01 22:00:00' + make_dt_interval(0,0,0,n),'{fmt}')"


def _duckdb_date(fmt: str) -> str:
    return f"strftime(TIMESTAMP '2026-05-01 22:00:00' + to_seconds(n), '{fmt}')"


def log_lines_sql(events: str = "events", *, duckdb: bool = False) -> str:
    if duckdb:
        dates = [_duckdb_date(f) for f in ("%b %d %H:%M:%S", "%d/%b/%Y:%H:%M:%S", "%Y-%m-%d %H:%M:%S")]
        ingest = "TIMESTAMP '2026-05-01 22:00:02' + to_seconds(n)"
    else:
        dates = [_spark_date(f) for f in ("MMM dd HH:mm:ss", "dd/MMM/yyyy:HH:mm:ss", "yyyy-MM-dd HH:mm:ss")]
        ingest = "TIMESTAMP_NTZ'2026-05-01 22:00:02' + make_dt_interval(0,0,0,n)"
    return _LINES.format(events=events, syslog_date=dates[0], clf_date=dates[1], iso_date=dates[2], ingest=ingest)


def metric_samples_sql(events: str = "events", *, duckdb: bool = False) -> str:
    if duckdb:
        base = f"TIMESTAMP '2026-05-01 22:00:00' + to_seconds({_SECONDS})"
    else:
        base = f"TIMESTAMP_NTZ'2026-05-01 22:00:00' + make_dt_interval(0,0,0,{_SECONDS})"
    return _SAMPLES.format(events=events, base=base)


def _events(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The events table; a file too small to give every core a task is spread first.

    Splits of a file are counted by its bytes, its rows come by row groups: of a few large
    groups most splits are empty. With ``spread`` every core gets a range of as many rows.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type")
    cores = spark.sparkContext.defaultParallelism
    if spread:
        return events.repartitionByRange(cores, "event_id")
    if events.rdd.getNumPartitions() < cores:
        events = events.repartition(cores, "event_id")
    return events


def log_lines(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """All lines; with ``spread``, any range of ``seq`` is dealt evenly over the cores."""
    return spark.sql(log_lines_sql("{src}"), src=_events(spark, sf_dir, spread))


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ts, metric, labels, value)``; absent labels are not in the map."""
    return spark.sql(
        f"""SELECT ts, metric, map_filter(map('instance', instance,
              CASE WHEN metric LIKE '%cpu%' THEN 'cpu' WHEN metric LIKE '%network%' THEN 'device' ELSE 'mountpoint' END, unit,
              'mode', mode), (k, v) -> v <> '') AS labels, value
            FROM ({metric_samples_sql('{src}')})""",
        src=_events(spark, sf_dir),
    )
