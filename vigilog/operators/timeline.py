"""Time series of events: tumbling counts, per-second rates, top rules."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.functions.timestamps import bucket_start, wall_clock
from vigilog.operators.stats import severity_counts
from vigilog.schema import SEVERITIES
from vigilog.session import materialize

# Resolution and length of the timeline, step of the rate series.
BUCKET_SECONDS = 10
MAX_BUCKETS = 90
STEP_SECONDS = 15
TOP_RULES = 5
# How long a series without events is taken to be idle, not ended.
LIFE_SECONDS = 300

_DAY = 86_400


def _seconds(n: int) -> Column:
    return F.make_dt_interval(secs=F.lit(n))


def timeline_counts(events: DataFrame, seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Counts per severity of each bucket that has events."""
    return events.groupBy(bucket_start(F.col("ts"), seconds).alias("bucket")).agg(*severity_counts())


def timeline_runs(events: DataFrame, seconds: int = BUCKET_SECONDS, since: datetime | None = None, expand: int = 0) -> DataFrame:
    """(bucket, buckets, info, warning, critical) from the first event, or ``since``, to the last.

    A bucket with events is one row. Empty buckets in a row are one row as well, with the
    first of them, their number and zeros; up to ``expand`` in a row are a row each. So a
    time that is years off adds one row. The next bucket is found within a day, or from
    the list of days that have events.
    """
    if _DAY % seconds:
        raise ValueError("bucket length must divide a day")
    names = [s.lower() for s in SEVERITIES]
    counts = materialize(timeline_counts(events, seconds), "timeline").withColumn("_day", F.to_date("bucket"))
    days = counts.groupBy("_day").agg(F.min("bucket").alias("_first"))
    following = days.select("_day", F.lead("_first").over(Window.orderBy("_day")).alias("_next_day"))  # a row per day with events
    within = counts.withColumn("_next", F.lead("bucket").over(Window.partitionBy("_day").orderBy("bucket")))
    ahead = within.join(following, "_day").select("bucket", F.coalesce("_next", "_next_day").alias("_next"), *names)
    gaps = ahead.select((F.col("bucket") + _seconds(seconds)).alias("bucket"), "_next")
    if since is not None:
        start = wall_clock(since)
        gaps = gaps.unionByName(days.agg(F.min("_first").alias("_next")).select(start.alias("bucket"), "_next"))
    length = (F.timestamp_diff("SECOND", "bucket", "_next") / seconds).cast("long")
    runs = gaps.withColumn("buckets", length).where("buckets > 0").withColumns({n: F.lit(0).cast("long") for n in names})
    whole = counts.withColumn("buckets", F.lit(1).cast("long"))
    if since is not None:
        whole = whole.where(F.col("bucket") >= wall_clock(since))
        runs = runs.where(F.col("bucket") >= wall_clock(since))
    columns = ["bucket", "buckets", *names]
    if not expand:
        return whole.select(*columns).unionByName(runs.select(*columns))
    short = F.col("buckets") <= expand
    places = F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1))
    each = runs.where(short).select("bucket", places.alias("_k"), F.lit(1).cast("long").alias("buckets"), *names)
    moved = each.withColumn("bucket", F.col("bucket") + F.make_dt_interval(secs=F.col("_k") * seconds))
    return whole.select(*columns).unionByName(moved.select(*columns)).unionByName(runs.where(~short).select(*columns))


def timeline(events: DataFrame, seconds: int = BUCKET_SECONDS, since: datetime | None = None, expand: int = _DAY // BUCKET_SECONDS) -> DataFrame:
    """Tumbling counts per severity from the first event, or ``since``, to the last event.

    Gaps of up to ``expand`` buckets are filled with zeros; of a longer one there is the
    first bucket only. ``timeline_runs`` tells how many buckets a row stands for.
    ``seconds`` must divide a day.
    """
    return timeline_runs(events, seconds, since, expand).drop("buckets")


def time_span(events: DataFrame) -> tuple[datetime, datetime] | None:
    """Times of the oldest and the newest event; two values, whatever the size."""
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    return None if first is None else (first, last)


def last_buckets_start(
    span: tuple[datetime, datetime], count: int = MAX_BUCKETS, seconds: int = BUCKET_SECONDS
) -> datetime:
    """Start of the newest ``count`` buckets, or of the first bucket if there are fewer."""
    first, last = ((t - datetime(1970, 1, 1)) // timedelta(seconds=seconds) for t in span)
    return datetime(1970, 1, 1) + timedelta(seconds=seconds) * max(first, last - count + 1)


def rate_series(
    events: DataFrame, key: str, range_seconds: int = 60, step_seconds: int = STEP_SECONDS, life_seconds: int = LIFE_SECONDS
) -> DataFrame:
    """Events per second over a range, one value per step and ``key``.

    Events are first counted per step; only these counts, not the events, are
    then copied into the ``range / step`` windows that cover them. For ``life_seconds``
    after its last event a series goes on with zeros; then it has ended, and comes back
    with its next event. The zeros are copies as well, so no gap is ever spanned.
    """
    if range_seconds % step_seconds or life_seconds % step_seconds:
        raise ValueError("the step must divide the range and the life of a series")
    per_step = (
        events.groupBy(key, bucket_start(F.col("ts"), step_seconds).alias("_step"))
        .agg(F.count("*").alias("n"))
    )
    places = range(-(life_seconds // step_seconds), range_seconds // step_seconds)
    none = F.lit(0).cast("long")
    copies = [F.struct((F.col("_step") - _seconds(k * step_seconds)).alias("bucket"), (F.col("n") if k >= 0 else none).alias("n")) for k in places]
    return (
        per_step.select(key, F.inline(F.array(*copies)))
        .groupBy("bucket", key)
        .agg(F.round(F.sum("n") / range_seconds, 6).alias("rate"))
    )


def topk_rules(events: DataFrame, at, k: int = TOP_RULES, range_seconds: int = 300) -> DataFrame:
    """The ``k`` rules with the highest rate over the range that ends at time ``at``."""
    in_range = (F.col("ts") > wall_clock(at) - _seconds(range_seconds)) & (F.col("ts") <= wall_clock(at))
    return (
        events.where(in_range & F.col("rule_triggered").isNotNull())
        .groupBy(F.col("rule_triggered").alias("rule"))
        .agg(F.round(F.count("*") / range_seconds, 6).alias("rate"))
        .orderBy(F.desc("rate"), "rule")
        .limit(k)
    )


def topk_rules_per_window(events: DataFrame, k: int = TOP_RULES, range_seconds: int = 300) -> DataFrame:
    """The top rules of every step of the rate series."""
    named = events.where(F.col("rule_triggered").isNotNull())
    rates = rate_series(named, "rule_triggered", range_seconds, life_seconds=0).withColumnRenamed("rule_triggered", "rule")
    by_rate = Window.partitionBy("bucket").orderBy(F.desc("rate"), "rule")
    return rates.withColumn("rank", F.row_number().over(by_rate)).where(F.col("rank") <= k)
