import hashlib
import math
import zlib
from collections import defaultdict

import xxhash
from hypothesis import given
from hypothesis import strategies as st

from vigilog.llm import sharding
from vigilog.llm.sharding import longest_first, shard_documents

from .conftest import odd_rows, prose


@given(st.lists(st.integers(0, 1000), max_size=60), st.integers(1, 7))
def test_each_item_goes_to_the_least_loaded(sizes, shards):
    items = [(f"i{k:03}", s) for k, s in enumerate(sizes)]
    size, loads = dict(items), [0] * shards
    placed = longest_first(items, shards)
    assert [size[i] for i, _ in placed] == sorted(sizes, reverse=True)
    for item, shard in placed:
        assert loads[shard] == min(loads)
        loads[shard] += size[item]


def check(df, rows, shards):
    found = shard_documents(df, shards).collect()
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in found) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots, of = defaultdict(list), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        of[r["size"], r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of.values())
    loads = [sum(r["size"] for r in found if r.shard == k) for k in range(shards)]
    return loads


def test_groups_stay_together_and_loads_are_near_equal(spark):
    rows = [(i, prose(i, 20 + i % 300)) for i in range(900)] + [(1000 + i, "copied " * 30) for i in range(40)]
    loads = check(spark.createDataFrame(rows, "doc_id long, text string"), rows, 8)
    assert max(loads) - min(loads) < 0.01 * sum(loads) / 8


def test_odd_texts_and_an_empty_table(odd, empty):
    check(odd.select("doc_id", "text"), [r[:2] for r in odd_rows()], 3)
    assert shard_documents(empty).count() == 0


def signed_hash(*parts):
    """Spark's xxhash64 of strings."""
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode(), seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def test_whole_table_against_a_plain_schedule(spark):
    """The shard of every row: large groups and bundles, largest first, each to the least loaded shard by a linear search."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(None, None), (5, ""), (7, "x" * 100_000), (7, "x" * 100_000)]
    shards, groups = 5, defaultdict(int)
    name = {t: hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows}
    for _, t in rows:
        groups[name[t]] += len((t or "").encode()) + sharding.ROW_BYTES
    total, items, item_of = sum(groups.values()), defaultdict(int), {}
    for g, size in groups.items():
        drawn = signed_hash(g) % (1 << (sharding.LEVELS - 1)) + 1
        level = sharding.LEVELS - 1 - math.ceil(math.log2(drawn))
        small = f"bundle:{level}:{signed_hash(g, 'bundle') % sharding.BUNDLES}"
        item_of[g] = g if size * sharding.LARGE * shards > total else small
        items[item_of[g]] += size
    loads, shard_of = [0] * shards, {}
    for item, size in sorted(items.items(), key=lambda x: (-x[1], x[0])):
        shard_of[item] = loads.index(min(loads))
        loads[shard_of[item]] += size
    wanted = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), shard_of[item_of[name[t]]]) for i, t in rows)
    found = shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards).collect()
    assert sorted((str(r.doc_id), r["size"], r.text_crc32, r.shard) for r in found) == wanted
    assert any(item_of[g] == g for g in groups) and any(item_of[g] != g for g in groups)
