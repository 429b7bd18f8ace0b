"""Text forms of events for the live feed and for alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.functions.timestamps import format_iso, format_plain
from vigilog.operators.search import filter_critical


def event_feed_json(events: DataFrame) -> DataFrame:
    """One JSON message per event: all fields, missing ones as null, extras nested."""
    fields = F.struct(
        format_iso(F.col("ts")).alias("timestamp"),
        "source", "raw", "ip", "user", "action", "status", "severity", "rule_triggered", "extra",
    )
    return events.select("seq", F.to_json(fields, {"ignoreNullFields": "false"}).alias("message"))


def _or_none(text: Column) -> Column:
    return F.coalesce(text, F.lit("None"))


def alert_messages(events: DataFrame) -> DataFrame:
    """The alert text of every CRITICAL event."""
    # The layout of an alert.
    message = F.concat(
        F.lit("\n **SIEM ALERT TRIGGERED**\n\n**Rule:** "), _or_none(F.col("rule_triggered")),
        F.lit("\n**Severity:** "), _or_none(F.col("severity")),
        F.lit("\n**Source:** "), _or_none(F.col("source")),
        F.lit("\n**IP:** "), _or_none(F.col("ip")),
        F.lit("\n**User:** "), _or_none(F.col("user")),
        F.lit("\n**Action:** "), _or_none(F.col("action")),
        F.lit("\n**Status:** "), _or_none(F.col("status")),
        F.lit("\n**Time:** "), format_plain(F.col("ts")), F.lit("\n"),
    )
    return filter_critical(events).select("seq", message.alias("message"))
