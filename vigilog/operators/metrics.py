"""Arithmetic over metric samples: ``(ts, metric, labels, value)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.functions.timestamps import bucket_start


def series_key() -> Column:
    """Labels as text in one order; maps themselves can be neither grouped nor joined."""
    pairs = F.array_sort(F.map_entries("labels"))
    return F.concat_ws(",", F.transform(pairs, lambda p: F.concat(p["key"], F.lit("="), p["value"])))


def label(name: str) -> Column:
    return F.try_element_at("labels", F.lit(name))


def _exact_rate(samples: DataFrame, metric: str, range_seconds: int, step_seconds: int, labels: dict[str, str]) -> DataFrame:
    """Per-second increase of a counter over each trailing range, per series.

    Each sample adds its increase since the sample before it, and the time between the
    two; the rate is their quotient. A value below the one before is a reset: the counter
    has grown by the value itself. The last sample of a step is copied to the steps of one
    range after it, so nothing is lost at an edge and no task holds a whole series.
    """
    if range_seconds % step_seconds:
        raise ValueError("the step must divide the range")
    steps = range_seconds // step_seconds
    chosen = samples.where(F.col("metric") == metric)
    for name, value in labels.items():
        chosen = chosen.where(label(name) == value)
    by_step = chosen.select(
        series_key().alias("series"),
        label("instance").alias("instance"),
        label("mode").alias("mode"),
        bucket_start(F.col("ts"), step_seconds).alias("step"),
        "ts",
        "value",
    )
    key = ["series", "instance", "mode"]
    after = F.array(*[F.col("step") + F.make_dt_interval(secs=F.lit(k * step_seconds)) for k in range(1, steps + 1)])
    last = by_step.groupBy(*key, "step").agg(F.max(F.struct("ts", "value")).alias("s"))
    context = last.select(*key, F.explode(after).alias("step"), "s.ts", "s.value", F.lit(False).alias("own"))
    in_step = Window.partitionBy(*key, "step").orderBy("ts", "value")
    before, before_ts = F.lag("value").over(in_step), F.lag("ts").over(in_step)
    grown = F.when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    increases = (
        by_step.withColumn("own", F.lit(True))
        .unionByName(context)
        .select(*key, "step", "own", grown.alias("grown"), ((_micros("ts") - _micros(before_ts)) / 1_000_000).alias("seconds"))
        .where("own AND seconds IS NOT NULL")
        .groupBy(*key, "step")
        .agg(F.sum("grown").alias("grown"), F.sum("seconds").alias("seconds"))
    )
    starts = F.array(*[F.col("step") - F.make_dt_interval(secs=F.lit(k * step_seconds)) for k in range(steps)])
    windows = increases.select(*key, F.explode(starts).alias("bucket"), "grown", "seconds").groupBy(*key, "bucket")
    summed = windows.agg(F.sum("grown").alias("grown"), F.sum("seconds").alias("seconds"))
    return summed.where("seconds > 0").select(*key, "bucket", (F.col("grown") / F.col("seconds")).alias("rate"))


def _micros(ts: str | Column) -> Column:
    return F.unix_micros(F.to_timestamp_ltz(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def counter_rate(
    samples: DataFrame, metric: str, range_seconds: int = 60, step_seconds: int | None = None, labels: dict[str, str] | None = None
) -> DataFrame:
    """Per-second increase of a counter in the range from ``bucket`` on, one value per step and series, to six digits.

    ``step_seconds`` is the range if not given; ``labels`` must have the given values.
    """
    exact = _exact_rate(samples, metric, range_seconds, step_seconds or range_seconds, labels or {})
    return exact.withColumn("rate", F.round("rate", 6))


def cpu_usage_pct(samples: DataFrame, range_seconds: int = 60) -> DataFrame:
    """100 minus the average idle rate of an instance's processors, in percent."""
    rates = _exact_rate(samples, "node_cpu_seconds_total", range_seconds, range_seconds, {"mode": "idle"})
    return rates.groupBy("instance", "bucket").agg(F.round(100 - F.avg("rate") * 100, 4).alias("cpu_usage_pct"))


def latest_gauges(samples: DataFrame, *metrics: str) -> DataFrame:
    """Newest value of each metric per label set, side by side; NULL where one has no such series."""
    newest = [
        F.max_by("value", F.when(F.col("metric") == m, F.struct("ts", "value"))).alias(m) for m in metrics
    ]
    return (
        samples.where(F.col("metric").isin(*metrics))
        .groupBy(series_key().alias("series"), label("instance").alias("instance"))
        .agg(*newest)
    )


def gauge_arith(samples: DataFrame) -> DataFrame:
    """Uptime, used memory and used disk share: arithmetic of gauges with equal labels."""
    gauges = latest_gauges(
        samples,
        "node_time_seconds", "node_boot_time_seconds",
        "node_memory_MemTotal_bytes", "node_memory_MemAvailable_bytes",
        "node_filesystem_avail_bytes", "node_filesystem_size_bytes",
    )
    results = {
        "uptime": F.col("node_time_seconds") - F.col("node_boot_time_seconds"),
        "memory_used": F.col("node_memory_MemTotal_bytes") - F.col("node_memory_MemAvailable_bytes"),
        "disk_used_pct": 100 - F.try_divide("node_filesystem_avail_bytes", "node_filesystem_size_bytes") * 100,
    }
    return gauges.select(
        "series", "instance",
        F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.round(v, 4).alias("value")) for n, v in results.items()])),
    ).where(F.col("value").isNotNull())


def series_count(samples: DataFrame, metric: str = "node_cpu_seconds_total", mode: str = "idle") -> DataFrame:
    """Number of series of a metric; duplicates are dropped in each task before the shuffle."""
    chosen = samples.where((F.col("metric") == metric) & (label("mode") == mode))
    return chosen.select(series_key().alias("series")).distinct().agg(F.count("*").alias("series"))
