"""Times the headline queries and prints one JSON line.

Settings: BENCH_SF_DIR (data folder), BENCH_CPUS (cores), BENCH_SCALE (copies of
the lines from other addresses at the same times, to see how a query grows).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from vigilog.operators import detect, search, stats, timeline  # noqa: E402
from vigilog.operators.normalize import normalize_events  # noqa: E402
from vigilog.session import build_session, scratch_dir  # noqa: E402
from vigilog.sources.event_store import append_events, create_event_table, scan_events  # noqa: E402
from vigilog.sources.fixture import REF_YEAR, log_lines  # noqa: E402
from vigilog.sources.rules import load_rules, rules_from  # noqa: E402
from vigilog.streaming.detection import DetectionStream  # noqa: E402
from vigilog.streaming.series import stream_totals  # noqa: E402

HEADLINE = {
    "normalize_events": lambda events, rules: events,
    "rule_matches": lambda events, rules: detect.rule_matches(events, rules).select("seq", "rule"),
    "rate_detection": lambda events, rules: detect.rate_detection(events, rules).select("seq", "rule"),
    "detect_events": lambda events, rules: detect.detect_events(events, rules),
    "detections_by_ip": lambda events, rules: detect.detections_by_ip(events, rules),
    "event_stats": lambda events, rules: stats.event_stats(detect.detect_events(events, rules)),
    "rules_triggered_total": lambda events, rules: stats.rules_triggered_total(detect.detect_events(events, rules)),
    "timeline_10s": lambda events, rules: timeline.timeline(detect.detect_events(events, rules)),
    "event_rate_by_severity": lambda events, rules: timeline.rate_series(detect.detect_events(events, rules), "severity"),
    "search_events": lambda events, rules: search.search_events(detect.detect_events(events, rules), "CRITICAL", "auth"),
}


def copies(lines, n: int):
    """The lines ``n`` times; copy k has its own seqs and host numbers."""
    if n == 1:
        return lines
    wide = lines.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k"))
    moved = F.regexp_replace("line", r"10\.0\.0\.", F.concat(F.lit("10.0."), F.col("k").cast("string"), F.lit(".")))
    return wide.select((F.col("seq") * n + F.col("k")).alias("seq"), "source", moved.alias("line"), "ingest_ts")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scale = int(os.environ.get("BENCH_SCALE", "1"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_driver_memory="16g", spark_ui_showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    rules = rules_from(load_rules(spark))

    # the input of all queries: raw lines in a table
    path = scratch_dir(spark, "bench-lines")
    copies(log_lines(spark, sf_dir), scale).write.parquet(path)
    lines = spark.read.parquet(path)

    def run(name: str) -> float:
        started = time.time()
        events = normalize_events(lines, ref_year=REF_YEAR)
        HEADLINE[name](events, rules).write.format("noop").mode("overwrite").save()
        return time.time() - started

    def timed(job) -> float:
        started = time.time()
        job()
        return round(time.time() - started, 3)

    def store() -> None:
        create_event_table(spark, table, f"{path}-events")
        append_events(detect.detect_events(normalize_events(lines, ref_year=REF_YEAR), rules, staged=True), table)

    def listing() -> None:
        search.search_events(scan_events(spark, table), "CRITICAL", "auth").write.format("noop").mode("overwrite").save()

    def stream() -> None:
        job = DetectionStream(rules, f"{path}-stream/out", ref_year=REF_YEAR)
        arriving = spark.readStream.schema(lines.schema).parquet(path)
        job.start(arriving, f"{path}-stream/checkpoint", availableNow=True).awaitTermination()
        stream_totals(spark, job.out).collect()

    run("detect_events")  # start-up of the JVM is not part of any query
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    table = "bench_" + path.rsplit("-", 1)[1]
    seconds |= {"store_events": timed(store), "stored_stats": timed(lambda: stats.event_stats(scan_events(spark, table)).collect())}
    seconds |= {"stored_search": timed(listing), "stream_all_lines": timed(stream)}
    spark.sql(f"DROP TABLE {table}")
    print(
        json.dumps(
            {
                "metric": "seconds for all headline queries from raw lines",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "copies": scale,
                "lines": lines.count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
