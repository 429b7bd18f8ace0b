"""Filters, projections and newest-first listings of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.functions.predicates import equals_if_set
from vigilog.functions.text import blank_to_dash
from vigilog.functions.timestamps import format_iso

# Bounds and defaults of the listings.
DEFAULT_LIMIT = 100
MIN_LIMIT, MAX_LIMIT = 1, 1000
INITIAL_ROWS = 50
LIVE_ROWS = 200


def validate_limit(n: int) -> int:
    if isinstance(n, bool) or not isinstance(n, int) or not MIN_LIMIT <= n <= MAX_LIMIT:
        raise ValueError(f"limit must be a number from {MIN_LIMIT} to {MAX_LIMIT}: {n!r}")
    return n


def filter_events(events: DataFrame, severity: str | None = None, source: str | None = None) -> DataFrame:
    return events.where(equals_if_set("severity", severity) & equals_if_set("source", source))


def filter_critical(events: DataFrame) -> DataFrame:
    return events.where(F.col("severity") == "CRITICAL")


def latest_events(events: DataFrame, n: int = DEFAULT_LIMIT) -> DataFrame:
    """The newest ``n`` events; of equal times the one that arrived last comes first."""
    return events.orderBy(F.desc("ts"), F.desc("seq")).limit(validate_limit(n))


def search_events(
    events: DataFrame, severity: str | None = None, source: str | None = None, n: int = DEFAULT_LIMIT
) -> DataFrame:
    """The newest ``n`` of the events that match."""
    return latest_events(filter_events(events, severity, source), n)


def latest_then_filter(events: DataFrame, severity: str | None = None, source: str | None = None) -> DataFrame:
    """Those of the newest 50 events that match."""
    return filter_events(latest_events(events, INITIAL_ROWS), severity, source)


def live_window(events: DataFrame, severity: str | None = None, source: str | None = None) -> DataFrame:
    """The newest 200 rows of the filtered live view."""
    return search_events(events, severity, source, LIVE_ROWS)


def project_event(events: DataFrame) -> DataFrame:
    """The ten fields of an event record, with text time and JSON extras."""
    return events.select(
        format_iso(F.col("ts")).alias("timestamp"),
        "source", "raw", "ip", "user", "action", "status", "severity", "rule_triggered",
        F.to_json("extra").alias("extra"),
    )


def project_display(events: DataFrame) -> DataFrame:
    """The eight columns of the events table on screen; '-' stands for no value."""
    names = ("source", "ip", "user", "action", "status", "severity", "rule_triggered")
    return events.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        *[blank_to_dash(F.col(n)).alias(n) for n in names],
    )
