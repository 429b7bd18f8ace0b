"""Running counters and the timeline of a detection stream.

Every batch writes its own counts, in a folder that a repeated batch replaces. The
totals are sums over these folders: a batch counts once however often it has run, and
a late event counts in the bucket of its time, however late it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.schema import SEVERITIES


def _counts(spark: SparkSession, out: str, output: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).parquet(f"{out.rstrip('/')}/{output}")


def stream_timeline(spark: SparkSession, out: str) -> DataFrame:
    """Counts per severity and bucket over all batches of the stream that writes to ``out``."""
    names = [s.lower() for s in SEVERITIES]
    return _counts(spark, out, "timeline").groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names])


def stream_totals(spark: SparkSession, out: str) -> DataFrame:
    """Events per severity over all batches of the stream that writes to ``out``."""
    return _counts(spark, out, "counters").groupBy("severity").agg(F.sum("total").alias("total"))
