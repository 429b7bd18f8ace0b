"""The event table: Parquet, partitioned by day and source."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.functions.timestamps import wall_clock
from vigilog.schema import EVENTS
from vigilog.sources.commits import EventStore

_PARTITIONS = ["event_date", "source"]


def create_event_table(spark: SparkSession, name: str, path: str) -> None:
    """Create the table unless it exists."""
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in EVENTS.fields if f.name != "source"]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}, event_date DATE, source STRING) "
        f"USING parquet PARTITIONED BY ({', '.join(_PARTITIONS)}) LOCATION '{path}'"
    )


def append_events(events: DataFrame, name: str) -> None:
    """Append events to the table.

    The rebalance hint gathers the rows of a partition into few files and, unlike
    a repartition, lets adaptive execution split a large day or source.
    """
    order = [f.name for f in EVENTS.fields if f.name != "source"]
    (
        events.withColumn("severity", F.coalesce("severity", F.lit("INFO")))
        .select(*order, F.to_date("ts").alias("event_date"), "source")
        .hint("rebalance", *_PARTITIONS)
        .write.mode("append")
        .insertInto(name)
    )


def scan_events(spark: SparkSession, name: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Events of the table with ``start <= ts <= end``. The bounds, or a filter on ``source``, prune partitions.

    A path instead of a name reads the committed events below it, those of a stream for instance.
    """
    if "/" in name:
        return EventStore(spark, name).scan(start, end)
    events = spark.table(name).select(*[f.name for f in EVENTS.fields], "event_date")
    if start is not None:
        events = events.where((F.col("event_date") >= F.lit(start.date())) & (F.col("ts") >= wall_clock(start)))
    if end is not None:
        events = events.where((F.col("event_date") <= F.lit(end.date())) & (F.col("ts") <= wall_clock(end)))
    return events


def append_jdbc(events: DataFrame, url: str, table: str = "log_events", writers: int = 16, **options: str) -> None:
    """Append events to a relational table, extras as JSON text; ``writers`` connections, batches of rows per insert."""
    (
        events.withColumn("extra", F.to_json("extra"))
        .write.format("jdbc")
        .options(url=url, dbtable=table, batchsize="10000", numPartitions=str(writers), **options)
        .mode("append")
        .save()
    )
