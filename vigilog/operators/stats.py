"""Counters over detected events. All are one aggregation with partial results per task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilog.schema import SEVERITIES
from vigilog.session import materialize

# Levels of the running totals: seqs are grouped by 2^16, these groups by 2^16 again.
_LEVEL_BITS = 16


def severity_counts(extra: tuple = ()) -> list:
    return [*extra, *[F.count_if(F.col("severity") == s).alias(s.lower()) for s in SEVERITIES]]


def event_stats(events: DataFrame) -> DataFrame:
    """One row: info, warning, critical, total. Other severities count in total only."""
    return events.agg(*severity_counts(), F.count("*").alias("total"))


def events_total(events: DataFrame) -> DataFrame:
    return events.groupBy("severity", "source").agg(F.count("*").alias("total"))


def rules_triggered_total(events: DataFrame) -> DataFrame:
    """Events by the rule that named them; events without a rule are left out."""
    named = events.where(F.col("rule_triggered").isNotNull())
    return named.groupBy(F.col("rule_triggered").alias("rule")).agg(F.count("*").alias("total"))


def stat_total(events: DataFrame, severity: str | None = None) -> DataFrame:
    matching = events.where(F.col("severity") == severity) if severity else events
    return matching.agg(F.count("*").alias("total"))


def severity_distribution(events: DataFrame) -> DataFrame:
    """Count and share of each of the three severities, zero where there is none."""
    one_row = event_stats(events)
    known = F.col("info") + F.col("warning") + F.col("critical")
    labels = F.array(*[F.struct(F.lit(s).alias("severity"), F.col(s.lower()).alias("total")) for s in SEVERITIES])
    return one_row.select(F.inline(labels), known.alias("known")).select(
        "severity",
        "total",
        F.round(F.when(F.col("known") > 0, F.col("total") / F.col("known")).otherwise(0.0), 6).alias("share"),
    )


def running_totals(events: DataFrame) -> DataFrame:
    """The counters as they stood after each event, in ``seq`` order.

    Prefix sums in three levels: within blocks of 2^16 seqs, over the blocks of a
    group of 2^16 blocks, and over the groups. No task sorts more than 2^16 rows
    of a block or 2^16 block totals; the number of groups is the seq range / 2^32.
    """
    names = ["total", *[s.lower() for s in SEVERITIES]]
    steps = materialize(
        events.select("seq", F.lit(1).alias("total"), *[(F.col("severity") == s).cast("int").alias(s.lower()) for s in SEVERITIES]),
        "running-totals",
    )
    block = F.shiftrightunsigned("seq", _LEVEL_BITS)
    before = (Window.unboundedPreceding, -1)

    def sums(by) -> list:
        return [F.coalesce(F.sum(n).over(by), F.lit(0)).alias(n) for n in names]

    blocks = steps.groupBy(block.alias("_block")).agg(*[F.sum(n).alias(n) for n in names])
    group = F.shiftrightunsigned("_block", _LEVEL_BITS).alias("_group")
    groups = blocks.groupBy(group).agg(*[F.sum(n).alias(n) for n in names])
    group_base = groups.select("_group", *sums(Window.orderBy("_group").rowsBetween(*before)))
    in_group = Window.partitionBy("_group").orderBy("_block").rowsBetween(*before)
    block_base = (
        blocks.select("_block", group, *names)
        .select("_block", "_group", *sums(in_group))
        .join(group_base.withColumnsRenamed({n: f"_g_{n}" for n in names}), "_group")
        .select("_block", *[(F.col(n) + F.col(f"_g_{n}")).alias(f"_b_{n}") for n in names])
    )
    upto = Window.partitionBy("_block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return (
        steps.withColumn("_block", block)
        .select("seq", "_block", *[F.sum(n).over(upto).alias(n) for n in names])
        .join(block_base, "_block")
        .select("seq", *[(F.col(n) + F.col(f"_b_{n}")).alias(n) for n in names])
    )
