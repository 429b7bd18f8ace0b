"""Sharding by longest processing time: groups, largest first, each to the least loaded shard, through a heap.

Rows of equal texts form a group and stay together. There may be billions of groups, and
the schedule needs few items: groups above a fixed share of all bytes are items of their
own (the share bounds their number), the others are gathered into bundles by a hash. Bundle
sizes halve from level to level, so the last items placed are tiny and level the shards.
The number of items is the same for any amount of data; only they reach the driver.

Defined cases: a null text counts as empty, with the empty text's group and checksum 0;
null or repeated ids are rows like others; a group larger than a shard's share fills a
shard beyond the mean, as it must stay whole; an empty table gives no rows. Only the named
columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.session import materialize

SHARDS = 40
ROW_BYTES = 16
LARGE = 256  # a group above 1 / (LARGE * shards) of all bytes is an item: LARGE * shards of them at most
LEVELS = 11
BUNDLES = 512  # for each level
RUN = 20_000  # rows that a task numbers together, about


def longest_first(items: Iterable[tuple[str, int]], shards: int) -> list[tuple[str, int]]:
    """(item, shard): items by falling size, ties by name, each to the least loaded shard, ties to the lowest."""
    loads = [(0, s) for s in range(shards)]
    placed = []
    for item, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = loads[0]
        heapq.heapreplace(loads, (load + size, shard))
        placed.append((item, shard))
    return placed


def _bundle(group: Column) -> Column:
    """Half of the groups go to level 0, a quarter to level 1, and so on; each level has as many bundles."""
    drawn = F.pmod(F.xxhash64(group), F.lit(1 << (LEVELS - 1))) + 1
    level = (LEVELS - 1) - F.ceil(F.log2(drawn))
    return F.concat_ws(":", F.lit("bundle"), level.cast("string"), F.pmod(F.xxhash64(group, F.lit("bundle")), F.lit(BUNDLES)).cast("string"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row; slots count from 0 in each shard."""
    value = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = materialize(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(value) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(value).alias("text_crc32"),
            F.sha2(value, 256).alias("group"),
        ),
        "sizes",
    )
    totals = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).first()
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    own = F.col("bytes") * (LARGE * shards) > (totals["bytes"] or 0)
    named = materialize(groups.select("group", "bytes", F.when(own, F.col("group")).otherwise(_bundle(F.col("group"))).alias("item")), "items")
    items = named.groupBy("item").agg(F.sum("bytes").alias("bytes")).collect()  # LARGE * shards + LEVELS * BUNDLES at most
    schedule = docs.sparkSession.createDataFrame(longest_first(((r["item"], r["bytes"]) for r in items), shards), "item string, shard int")
    item = F.broadcast(schedule)
    runs = max(8, -(-totals["n"] // (shards * RUN)))
    large = named.where(F.col("item") == F.col("group")).select(F.col("group").alias("large"))  # at most LARGE * shards
    placed = materialize(
        rows.join(F.broadcast(large), F.col("group") == F.col("large"), "left")
        .withColumn("item", F.coalesce("large", _bundle(F.col("group"))))
        .join(item, "item")
        .select("doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(runs)).cast("int").alias("run")),
        "placed",
    )
    # slots: rows are numbered in runs, which start where the shard's runs before them end
    counted = placed.groupBy("shard", "run").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    starts = counted.select("shard", "run", F.coalesce(before, F.lit(0)).alias("start"))
    at = F.row_number().over(Window.partitionBy("shard", "run").orderBy("doc_id", "text_crc32", "size")) - 1
    return (
        placed.withColumn("at", at)
        .join(starts, ["shard", "run"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("at")).cast("long").alias("slot"))
    )
