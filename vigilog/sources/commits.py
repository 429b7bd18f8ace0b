"""Event folders that are committed as a whole: what streams write, and what listings read first.

Each commit has a key, a stream's batch for instance. Its events are written to a folder of
their own, by day and source, and then entered in the list of commits, which also holds
how many events of each day, source and severity the folder has. A commit under a known
key takes the place of the one before, so a batch that runs again counts once. The list is
written anew as one small file that appears by a rename; readers take the newest list, so they
see all of a commit or nothing. Folders no list names any more are removed by ``vacuum``.

``compact`` rewrites many small folders as one; readers that hold an older list go on with
the old folders. One process at a time may commit, as is the case for a stream.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog.functions.timestamps import wall_clock
from vigilog.schema import EVENTS

PARTITIONS = ["event_date", "source"]
KEPT_LISTS = 5
# Compaction gathers the commits once there are so many.
COMMITS = 40


def plain(*columns: str) -> dict[str, str]:
    """Options of a Parquet writer for columns of texts that hardly repeat: no dictionary is built of them."""
    return {f"parquet.enable.dictionary#{c}": "false" for c in columns}


class EventStore:
    """Events below ``path``: ``commits`` holds the lists, ``data`` the folders."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._fs.Path(f"{self.path}/{name}".rstrip("/"))

    def _versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self._files.globStatus(self._at("commits/*.json")) or []]
        return sorted(int(n.removesuffix(".json")) for n in names)

    def _list(self) -> dict:
        """The newest list: entries by key, each ``{folder, counts}``, in order of commit, and what was compacted."""
        versions = self._versions()
        return self._read(versions[-1]) if versions else {"entries": {}, "gathered": []}

    def _read(self, version: int) -> dict:
        stream = self._files.open(self._at(f"commits/{version}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _write(self, content: dict) -> None:
        version = ([0, *self._versions()])[-1] + 1
        draft = self._at(f"commits/{version}-{uuid.uuid4().hex}.tmp")
        stream = self._files.create(draft, True)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        if not self._files.rename(draft, self._at(f"commits/{version}.json")):
            raise RuntimeError(f"another process commits to {self.path}")

    def _store(self, events: DataFrame) -> dict:
        """Write a folder; the rebalance hint gathers a day and source into few files and splits a large one."""
        folder = f"folder={uuid.uuid4().hex}"
        rows = events.select(*EVENTS.names).withColumns({"severity": F.coalesce("severity", F.lit("INFO")), "event_date": F.to_date("ts")})
        rows.hint("rebalance", *PARTITIONS).write.partitionBy(*PARTITIONS).options(**plain("raw")).parquet(f"{self.path}/data/{folder}")
        counts = self._folders([folder]).groupBy(*PARTITIONS, "severity").agg(F.count("*").alias("n")).collect()  # days x 15
        return {"folder": folder, "counts": [[r["event_date"].isoformat(), r["source"], r["severity"], r["n"]] for r in counts]}

    def _folders(self, folders: Iterable[str]) -> DataFrame:
        """Events of the folders, and their day, with the partition columns typed."""
        columns = [*EVENTS.names, "event_date"]
        paths = [p for p in (f"{self.path}/data/{f}" for f in folders) if self._files.globStatus(self._fs.Path(f"{p}/event_date=*"))]
        if not paths:
            return self.spark.createDataFrame([], EVENTS).withColumn("event_date", F.to_date("ts")).select(*columns)
        layout = T.StructType([*(f for f in EVENTS.fields if f.name != "source"), T.StructField("event_date", T.DateType()), EVENTS["source"]])
        return self.spark.read.schema(layout).option("basePath", f"{self.path}/data").parquet(*paths).select(*columns)

    def commit(self, events: DataFrame, key: str) -> None:
        """Store ``events`` in the place of what was committed under ``key``."""
        now = self._list()
        if key in now["gathered"]:  # compacted since, so committed for good
            return
        entry = self._store(events)
        now["entries"].pop(key, None)
        now["entries"][key] = entry
        self._write(now)

    def append(self, events: DataFrame) -> None:
        self.commit(events, f"append-{uuid.uuid4().hex}")

    def keys(self) -> list[str]:
        return list(self._list()["entries"])

    def scan(self, start: datetime | None = None, end: datetime | None = None, key: str | None = None) -> DataFrame:
        """Committed events with ``start <= ts <= end`` and their ``event_date``; those of one commit, if ``key`` is given."""
        entries = self._list()["entries"]
        chosen = entries.values() if key is None else [entries[key]] if key in entries else []
        events = self._folders(e["folder"] for e in chosen)
        if start is not None:
            events = events.where((F.col("event_date") >= F.lit(start.date())) & (F.col("ts") >= wall_clock(start)))
        if end is not None:
            events = events.where((F.col("event_date") <= F.lit(end.date())) & (F.col("ts") <= wall_clock(end)))
        return events

    def counts(self) -> Counter:
        """Committed events by (day, source, severity), without reading any."""
        total: Counter = Counter()
        for entry in self._list()["entries"].values():
            for day, source, severity, n in entry["counts"]:
                total[date.fromisoformat(day), source, severity] += n
        return total

    def newest_days(self, n: int, severity: str | None = None, source: str | None = None) -> date | None:
        """The day from which on there are ``n`` events of this severity and source; None if there are fewer at all."""
        per_day: Counter = Counter()
        for (day, of, level), found in self.counts().items():
            if severity in (None, "", level) and source in (None, "", of):
                per_day[day] += found
        for day in sorted(per_day, reverse=True):
            n -= per_day[day]
            if n <= 0:
                return day
        return None

    def newest(self, n: int, severity: str | None = None, source: str | None = None) -> DataFrame:
        """Events of the newest days that hold ``n`` of this severity and source, or all if there are fewer."""
        since = self.newest_days(n, severity, source)
        events = self.scan()
        return events if since is None else events.where(F.col("event_date") >= F.lit(since))

    def newest_of_each(self, n: int, key: str) -> Column:
        """Condition on the events of a commit, by its counts: the newest days that hold ``n`` of each source and severity."""
        found: dict[tuple, Counter] = {}
        entry = self._list()["entries"].get(key, {"counts": []})
        for day, source, level, rows in entry["counts"]:
            found.setdefault((source, level), Counter())[day] += rows
        chosen = F.lit(False)
        for (source, level), days in found.items():
            left, wanted = n, F.col("source").eqNullSafe(F.lit(source)) & (F.col("severity") == F.lit(level))
            for day in sorted(days, reverse=True):
                left -= days[day]
                if left <= 0:
                    wanted = wanted & (F.col("event_date") >= F.lit(date.fromisoformat(day)))
                    break
            chosen = chosen | wanted
        return chosen

    def compact(self, keep: int = 1) -> None:
        """Gather all but the ``keep`` newest commits; these may run again and stay as they are."""
        now = self._list()
        old = list(now["entries"])[: -keep or None]
        if len(old) < 2:
            return
        entry = self._store(self._folders(now["entries"][k]["folder"] for k in old))
        newer = {k: e for k, e in now["entries"].items() if k not in old}
        gathered = [*now["gathered"], *(k for k in old if not k.startswith(("append-", "gathered-")))]
        self._write({"entries": {f"gathered-{uuid.uuid4().hex}": entry, **newer}, "gathered": gathered[-10 * COMMITS :]})
        self.vacuum()

    def vacuum(self, keep: int = KEPT_LISTS) -> None:
        """Remove lists but for the newest, and folders that none of these names."""
        versions = self._versions()
        named = {e["folder"] for v in versions[-keep:] for e in self._read(v)["entries"].values()}
        for v in versions[:-keep]:
            self._files.delete(self._at(f"commits/{v}.json"), False)
        for folder in self._files.globStatus(self._at("data/*")) or []:
            if folder.getPath().getName() not in named:
                self._files.delete(folder.getPath(), True)
