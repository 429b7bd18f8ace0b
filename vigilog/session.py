"""Session settings and scratch storage."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the jobs profit from; safe on any session.

    The parsing projection compiles to a method longer than the 8000 bytes the
    JVM's compiler accepts. With this limit Spark splits it instead of running it
    interpreted, which is worth a factor of about two. The call-site notes Spark
    keeps for every Column operation take most of the time to build a plan.
    """
    spark.conf.set("spark.sql.dataFrameQueryContext.enabled", "false")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def build_session(app: str = "vigilog", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use "_" for "."."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return tune(builder.getOrCreate())


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder the cluster names.

    Only a local session that names none falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="vigilog-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/vigilog/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove what was written to a path of ``scratch_dir``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _SCRATCH.remove(path)


@contextmanager
def scratch_dropped(spark: SparkSession, *keep: str):
    """Removes, at the end of the block, what was written to scratch within it, but for the paths ``keep``.

    For jobs whose results are written by then; a table still to be read must be kept.
    """
    before = len(_SCRATCH)
    try:
        yield
    finally:
        for path in [p for p in _SCRATCH[before:] if p not in keep]:
            drop_scratch(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
