"""Raw lines to events: one narrow pass over the input, no shuffle, no Python."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.functions.formats import DETAIL_FIELDS, FORMATS, Groups, LineFormat, by_source, event_fields, event_ts
from vigilog.functions.text import fields_of, is_recast, strip
from vigilog.functions.timestamps import wall_clock
from vigilog.schema import SOURCES


def _formats(sources: Iterable[str]) -> tuple[LineFormat, ...]:
    wanted = set(sources)
    unknown = wanted - set(SOURCES)
    if unknown:
        raise ValueError(f"unknown source: {', '.join(sorted(unknown))}; known: {', '.join(SOURCES)}")
    return tuple(f for f in FORMATS if f.source in wanted)


def _ingest_ts(lines: DataFrame) -> Column:
    """The stored time of arrival; without one, a time fixed here, so that all jobs over the result agree."""
    if "ingest_ts" in lines.columns:
        return F.col("ingest_ts").cast("timestamp_ntz")
    return wall_clock(datetime.now(timezone.utc).replace(tzinfo=None))


def normalize_events(
    lines: DataFrame, *, ref_year: int | None = None, sources: Iterable[str] = SOURCES
) -> DataFrame:
    """Parse ``lines(seq, source, line[, ingest_ts])`` into the event layout.

    A line that fits no format, or has an unknown source, yields no row. Lines
    without a usable time take ``ingest_ts`` (if the column is missing, the time of
    this call) and are marked ``ts_inferred``. ``ref_year`` is the year of syslog
    stamps, by default that of ``ingest_ts``.
    """
    formats = _formats(sources)
    known = lines.where(F.col("source").isin([f.source for f in formats]))
    return _parsed(known, formats, ref_year)


def parse_lines(lines: DataFrame, *, ref_year: int | None = None) -> DataFrame:
    """``normalize_events`` and ``rejected_lines`` in one pass, for a caller that stores the result and needs both.

    Each line is a row of the event layout with ``is_event``; ``line`` is kept of those that are none.
    """
    return _parsed(lines, FORMATS, ref_year, with_rejected=True)


def _parsed(lines: DataFrame, formats: tuple[LineFormat, ...], ref_year: int | None, with_rejected: bool = False) -> DataFrame:
    now = _ingest_ts(lines)
    year = F.lit(ref_year) if ref_year is not None else F.year("_now")
    g, d, t = Groups(F.col("_g")), Groups(F.col("_d")), Groups(F.col("_t"))

    source, line = F.col("source"), F.col("_line")
    whole = [F.col("line")] if with_rejected else []
    rejected = [F.when(~F.coalesce(is_recast(line), F.lit(False)), F.col("line")).alias("line")] if with_rejected else []
    judged = [F.col("_g").isNotNull().alias("is_event"), F.col("line")] if with_rejected else []

    # Each step reads columns of the step before, so every regex runs once per line.
    # explode of a zero- or one-element array drops unparsed lines; a filter on the
    # rewritten line would be pushed below it and run the regex twice. Where all lines
    # stay, nothing is dropped, and the groups are a plain column.
    groups = by_source(source, formats, lambda f: fields_of(line, len(f.keep)))
    detail = by_source(source, formats, lambda f: f.detail(g))
    time = by_source(source, formats, lambda f: f.time(g) if f.time else None).cast("string")
    extra = by_source(source, formats, lambda f: f.extra(g, d))
    kept = F.when(is_recast(line), groups) if with_rejected else F.explode(F.when(is_recast(line), F.array(groups)))
    fields = event_fields(source, g, d)
    return (
        lines.select("seq", "source", strip(F.col("line")).alias("raw"), now.alias("_now"), *whole)
        .select("*", by_source(source, formats, lambda f: f.recast(F.col("raw"))).alias("_line"))
        .select("seq", "source", "raw", "_now", kept.alias("_g"), *rejected)
        .select("*", detail.alias("_detail"), time.alias("_time"))
        .select("*", fields_of(F.col("_detail"), DETAIL_FIELDS).alias("_d"), fields_of(F.col("_time"), 7).alias("_t"))
        .select("*", event_ts(source, g, t, year).alias("_ts"), extra.alias("extra"))
        .select(
            "seq",
            F.coalesce("_ts", "_now").alias("ts"),
            F.col("_ts").isNull().alias("ts_inferred"),
            "source",
            "raw",
            *[fields[name].alias(name) for name in ("ip", "user", "action", "status", "severity")],
            F.lit(None).cast("string").alias("rule_triggered"),
            *[fields[name].alias(name) for name in ("path", "direction")],
            "extra",
            *judged,
        )
    )


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The complement of ``normalize_events``: lines of no format or no known source."""
    raw = strip(F.col("line"))
    parsed = by_source(F.col("source"), FORMATS, lambda f: is_recast(f.recast(raw)))
    return lines.where(~F.coalesce(parsed, F.lit(False))).select("seq", "source", "line")
