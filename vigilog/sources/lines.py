"""Raw log lines from per-source files, as a table or as a stream."""

from __future__ import annotations

import os
from collections.abc import Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.functions.timestamps import wall_clock
from vigilog.schema import LINES, SOURCES

# Variable and default path of each source.
PATH_SETTINGS = {
    "auth": ("LOG_FILE_AUTH", "/app/logs/auth.log"),
    "access": ("LOG_FILE_ACCESS", "/app/logs/access.log"),
    "firewall": ("LOG_FILE_FIREWALL", "/app/logs/firewall.log"),
    "syslog": ("LOG_FILE_SYSLOG", "/app/logs/syslog.log"),
    "fim": ("LOG_FILE_FIM", "/app/logs/fim.log"),
}
MODES = ("file", "generator", "both")


def paths_from_env(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    return {source: env.get(name, default) for source, (name, default) in PATH_SETTINGS.items()}


def check_source(source: str) -> str:
    if source not in SOURCES:
        raise ValueError(f"unknown source {source!r}; known: {', '.join(SOURCES)}")
    return source


def switch_log_path(paths: Mapping[str, str], source: str, path: str) -> dict[str, str]:
    """The paths with one source moved. Start the next query with them and a checkpoint of its own."""
    return {**paths, check_source(source): path}


def read_lines(spark: SparkSession, paths: Mapping[str, str], missing: str = "error") -> DataFrame:
    """``(seq, source, line, ingest_ts)`` of all files, ``ingest_ts`` the time of this call.

    A path that does not exist is an error; with ``missing="skip"`` its source is left out.

    ``seq`` follows file position. It is only as stable as the files: to evaluate
    rules on files that still change, write the lines to a table first.
    """
    if missing not in ("error", "skip"):
        raise ValueError(f"missing must be error or skip: {missing!r}")
    now = wall_clock(datetime.now(timezone.utc).replace(tzinfo=None)).alias("ingest_ts")
    parts = []
    for source, path in paths.items():
        try:
            text = spark.read.text(path)
        except AnalysisException as error:
            if missing == "error" or error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        parts.append(text.select(F.lit(check_source(source)).alias("source"), F.col("value").alias("line")))
    if not parts:
        return spark.createDataFrame([], LINES).withColumn("ingest_ts", now)
    lines = reduce(DataFrame.unionByName, parts)
    return lines.select(F.monotonically_increasing_id().alias("seq"), "source", "line", now)


def tail_stream(spark: SparkSession, paths: Mapping[str, str], max_files_per_trigger: int | None = None) -> DataFrame:
    """New lines of all sources as a stream; each path is a folder (or pattern) that files are added to.

    Spark follows files, not bytes: rotate logs into the folder, or use a message
    queue as the source, if lines must be seen before a file is complete.
    """
    def follow(source: str, path: str) -> DataFrame:
        reader = spark.readStream
        if max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.text(path).select(F.lit(check_source(source)).alias("source"), F.col("value").alias("line"))

    return reduce(DataFrame.unionByName, [follow(s, p) for s, p in paths.items()])


def union_sources(files: DataFrame, generated: DataFrame, mode: str = "both") -> DataFrame:
    """Lines of the active inputs: log files, generated lines, or both."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}: {mode!r}")
    active = {"file": [files], "generator": [generated], "both": [files, generated]}[mode]
    return reduce(DataFrame.unionByName, active)
