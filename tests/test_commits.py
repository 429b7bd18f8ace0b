"""Committed event folders: whole commits, repeated keys, newest days, compaction."""

from datetime import datetime, timedelta
from functools import reduce

import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrame

from test_rules import make_events
from vigilog.operators import search
from vigilog.sources.commits import EventStore
from vigilog.sources.event_store import scan_events

NOON = datetime(2026, 5, 1, 12)


@pytest.fixture
def store(spark, tmp_path):
    return EventStore(spark, str(tmp_path / "events"))


def day_of(spark, first_seq, day, n=3, **fields):
    return make_events(spark, *[{"seq": first_seq + i, "ts": NOON + timedelta(days=day, seconds=i), **fields} for i in range(n)])


def seqs(df):
    return sorted(r.seq for r in df.select("seq").collect())


def test_a_repeated_key_counts_once(spark, store):
    assert store.scan().count() == 0 and store.keys() == []
    store.commit(day_of(spark, 0, 0), "batch-0")
    store.commit(day_of(spark, 10, 0), "batch-1")
    store.commit(day_of(spark, 20, 4), "batch-1")  # the same batch on another day
    assert seqs(scan_events(spark, store.path)) == [0, 1, 2, 20, 21, 22]
    assert seqs(store.scan(key="batch-1")) == [20, 21, 22] and store.scan(key="none").count() == 0
    store.append(day_of(spark, 30, 0))
    store.append(day_of(spark, 30, 0))
    assert store.scan().count() == 12 and sum(store.counts().values()) == 12


def test_what_is_not_listed_is_not_read(spark, store):
    """A writer that died before its commit leaves files that no reader sees and vacuum removes."""
    store.commit(day_of(spark, 0, 0), "batch-0")
    store._store(day_of(spark, 50, 0))
    assert seqs(store.scan()) == [0, 1, 2]
    store.vacuum()
    assert len(store._files.globStatus(store._at("data/*"))) == 1


def test_an_empty_commit(spark, store):
    store.commit(day_of(spark, 0, 0).where("false"), "batch-0")
    assert store.scan().count() == 0 and store.keys() == ["batch-0"]
    store.compact(0)
    store.commit(day_of(spark, 0, 0), "batch-1")
    assert seqs(store.scan()) == [0, 1, 2]


def test_compaction_leaves_totals_and_readers_alone(spark, store):
    for batch in range(6):
        store.commit(day_of(spark, 10 * batch, batch % 2, source="auth" if batch % 3 else "fim"), f"batch-{batch}")
    before, counts, open_reader = seqs(store.scan()), store.counts(), store.scan()
    store.compact()
    assert len(store.keys()) == 2 and store.keys()[-1] == "batch-5"
    assert seqs(store.scan()) == before == seqs(open_reader) and store.counts() == counts
    folder = store._list()["entries"][store.keys()[0]]["folder"]
    parts = [p.getPath().toString() for p in store._files.globStatus(store._at(f"data/{folder}/*/*"))]
    files = [store._files.globStatus(store._fs.Path(f"{p}/*.parquet")) for p in parts]
    assert len(parts) == 4 and all(len(f) == 1 for f in files)
    store.commit(day_of(spark, 777, 0), "batch-2")  # gathered already
    store.commit(day_of(spark, 60, 0), "batch-5")  # runs again
    assert seqs(store.scan()) == sorted([s for s in before if s < 50] + [60, 61, 62])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_days_first(spark, store):
    """Only the days that can hold the newest rows are read, also when the newest days have no match."""
    for day in range(0, 400, 40):
        store.append(day_of(spark, day, day, n=5, severity="CRITICAL" if day == 80 else "INFO", source="auth"))
    everything = store.scan()
    for n, severity, source in ((3, None, None), (7, None, ""), (3, "CRITICAL", None), (6, "CRITICAL", "auth"), (2, "INFO", "auth"), (2, None, "fim"), (1000, None, None)):
        found = search.search_events(store.newest(n, severity, source), severity, source, n)
        assert [r.seq for r in found.collect()] == [r.seq for r in search.search_events(everything, severity, source, n).collect()]
    assert store.newest_days(3) == (NOON + timedelta(days=360)).date()
    assert store.newest_days(3, "CRITICAL") == (NOON + timedelta(days=80)).date()
    assert store.newest_days(6, "CRITICAL") is None
    text = plan(search.latest_events(store.newest(3), 3))
    assert "event_date" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_newest_of_each_reads_no_more_days_than_hold_them(spark, store):
    """Days 0 to 5 have 3 events of auth each, and days 0 and 1 one of fim."""
    days = [day_of(spark, 10 * day, day, source="auth") for day in range(6)] + [day_of(spark, 100 + day, day, n=1, source="fim") for day in range(2)]
    store.commit(reduce(DataFrame.union, days), "batch-0")
    found = store.scan(key="batch-0").where(store.newest_of_each(4, "batch-0"))
    assert seqs(found) == [40, 41, 42, 50, 51, 52, 100, 101]
    scan = found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("DataFilters")[0]
    assert "event_date" in scan and "source" in scan  # the other days are not opened
    assert store.scan(key="none").where(store.newest_of_each(4, "none")).count() == 0


def test_no_dictionary_is_built_of_raw_lines(spark, store, tmp_path):
    """Lines differ, so a dictionary of them is work for nothing; names that repeat keep theirs."""
    store.append(day_of(spark, 0, 0, raw="May 01 12:00:00 a b: c", action="login"))
    for path in (tmp_path / "events" / "data").rglob("*.parquet"):
        group = pq.ParquetFile(path).metadata.row_group(0)
        coded = {group.column(i).path_in_schema: group.column(i).has_dictionary_page for i in range(group.num_columns)}
        assert coded["action"] and not coded["raw"]
    assert store.scan().where("raw = 'May 01 12:00:00 a b: c'").count() == 3
