"""Benchmark decontamination: fingerprints of item-sized windows, found by Hamming blocks, verified exactly.

A window as similar to an item as PERCENT asks misses at most a fifth of the item's
shingles, so it holds one of any fifth (and one more) of them. For each item these are the
shingles that are rarest in the corpus. A document that has one of them gets windows of the
item's length laid over that place, and the hit carries the item: other items of the same
length are never met. Nothing is lost, and the rest of the corpus costs one hash lookup per word.

The windows' SimHash is looked up through blocks: with ``RADIUS + 1`` blocks, two
fingerprints within the radius agree in one block at least, so an equality join on
(item, block, bits) finds all carried pairs within it. What is left is compared exactly by the
Jaccard similarity of the shingles, weighted by how often each occurs. All of it is
DataFrame operations.

Defined cases: null and empty texts are clean; an item without words is ignored; an item
under five words is one shingle, compared with windows of its length; a document shorter
than an item is one window for it; repeated documents get the same verdict each, and their
ids may be null; items are told apart by their words, equal ones are one item with several
ids; an item without an id makes a text leaked for ``judged`` and ``keep_clean``, which name
no id for it, and ``with_leaks`` reports only items that have one; other columns pass through
whatever their names; empty tables give no leaks.

Tables that grow with the corpus are joined by shuffles, whatever size Spark takes their files
for: a window lies in a file with two bytes, in memory with a hundred. A broadcast one is counted first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.llm.common import WHITE, clash_free, light, light_or_shuffled, shuffled
from vigilog.session import materialize

SHINGLE = 5
PERCENT = 80
RADIUS = 19
BITS = 64

# Lanes: three bits of a fingerprint, each spread to a counter of 21 bits, in one long.
_LANE = 21
_SPREAD = 1 | 1 << 20 | 1 << 40
_MASK = 1 | 1 << _LANE | 1 << 2 * _LANE
_GROUPS = -(-BITS // 3)


def _words(text: Column) -> Column:
    core = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(WHITE))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, "[ \t-\r]+"))


def _word_hashes(text: Column) -> Column:
    return F.transform(_words(text), lambda w: F.xxhash64(w))


def _shingles(hashes: Column, size: int, n: Column) -> Column:
    """Runs of ``size`` word hashes, as an array of structs."""
    runs = F.arrays_zip(*(F.slice(hashes, k + 1, n).alias(f"w{k}") for k in range(size)))
    return F.slice(runs, 1, F.greatest(n - (size - 1), F.lit(0)))


def _shingle_hash(run: Column, size: int) -> Column:
    return F.xxhash64(*(run[f"w{k}"] for k in range(size)))


def _run_hashes(hashes: Column, size: int, n: Column) -> Column:
    return F.transform(_shingles(hashes, size, n), lambda r: _shingle_hash(r, size))


def _item_tables(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item, size, length, run hashes in order) of the distinct items that have words, and (item, item_id) of all of them."""
    hashed = items.select("item_id", _word_hashes(F.col("text")).alias("hashes")).where(F.size("hashes") > 0)
    numbered = materialize(hashed.select("hashes").distinct().withColumn("item", F.monotonically_increasing_id()), "item-numbers")
    named = materialize(hashed.join(numbered, "hashes").select("item", "item_id").distinct(), "item-ids")
    length = F.size("hashes")
    kinds = [
        numbered.where(length == size if size < SHINGLE else length >= size).select(
            "item",
            F.lit(size).alias("size"),
            length.alias("length"),
            _run_hashes(F.col("hashes"), size, length).alias("runs"),
        )
        for size in range(1, SHINGLE + 1)
    ]
    table = kinds[0]
    for k in kinds[1:]:
        table = table.union(k)
    return materialize(table, "items"), named


def _lanes(run: Column) -> list[Column]:
    return [
        F.sum((F.shiftrightunsigned(run, 3 * g).bitwiseAND(F.lit(7).cast("long")) * F.lit(_SPREAD)).bitwiseAND(F.lit(_MASK))).alias(f"s{g}")
        for g in range(_GROUPS)
    ]


def _with_fingerprints(runs: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash of the runs of each key: a bit is set if most runs have it set."""
    counted = runs.groupBy(*keys).agg(F.count("*").alias("m"), *_lanes(F.col("run")))
    bits = [
        F.when(
            2 * F.shiftright(F.col(f"s{b // 3}"), _LANE * (b % 3)).bitwiseAND(F.lit((1 << _LANE) - 1)) > F.col("m"),
            F.lit(1 << b if b < 63 else -(1 << 63)),
        ).otherwise(F.lit(0).cast("long"))
        for b in range(BITS)
    ]
    value = bits[0]
    for b in bits[1:]:
        value = value.bitwiseOR(b)
    return counted.select(*keys, value.alias("print"))


def _blocks(fingerprint: Column, radius: int) -> Column:
    """(number, bits) of ``radius + 1`` parts of a fingerprint."""
    edges = [BITS * k // (radius + 1) for k in range(radius + 2)]
    return F.array(
        *(
            F.struct(
                F.lit(k).alias("block"),
                F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << high - low) - 1 if high - low < 64 else -1).cast("long")).alias("part"),
            )
            for k, (low, high) in enumerate(zip(edges, edges[1:]))
        )
    )


def _numbered(runs: Column) -> Column:
    """A set that stands for the weighted runs: the k-th occurrence of a run is an element of its own."""
    ordered = F.sort_array(runs)
    return F.transform(ordered, lambda r, i: F.xxhash64(r, i + 1 - F.array_position(ordered, r)))


def _rarest(table: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """(size, run, item, length): the runs of each item that are rarest in the corpus, of which a window so similar has one.

    With repeats counted they are just more than the share that such a window may lack.
    """
    own = table.select("item", "size", "length", F.size("runs").alias("m"), F.explode("runs").alias("run"))
    each = own.groupBy("item", "size", "length", "m", "run").agg(F.count("*").alias("times")).join(shuffled(counts), ["size", "run"], "left")
    in_order = Window.partitionBy("item").orderBy(F.coalesce("seen", F.lit(0)), "run")  # the runs of one item
    before = F.coalesce(F.sum("times").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    enough = F.floor((100 - percent) * F.col("m") / 100) + 1
    return each.withColumn("before", before).where((F.col("before") < enough) & F.col("seen").isNotNull()).select("size", "run", "item", "length")


def find_leaks(docs: DataFrame, items: DataFrame, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """(key, digest, item_id, start, similarity): windows of distinct texts that repeat an item.

    ``docs`` needs a column ``text``, ``items`` needs ``item_id`` and ``text``. ``key`` is
    the text's xxhash64, ``digest`` its md5; ``start`` counts words from 0.
    """
    table, named = _item_tables(items)
    lengths = [(r["size"], r["length"]) for r in table.select("size", "length").distinct().collect()]  # one row per length
    sizes = sorted({size for size, _ in lengths})
    keyed = docs.where("text IS NOT NULL").select(F.xxhash64("text").alias("key"), "text")
    found = None
    for size in sizes:
        known = light(materialize(table.where(F.col("size") == size).select(F.explode("runs").alias("run")).distinct(), "item-runs"))
        hashed = keyed.withColumn("hashes", _word_hashes(F.col("text"))).select("key", "hashes")
        runs = hashed.select("key", F.posexplode(_shingles(F.col("hashes"), size, F.size("hashes"))).alias("at", "r"))
        hits = runs.select("key", F.lit(size).alias("size"), "at", _shingle_hash(F.col("r"), size).alias("run")).join(known, "run")
        found = hits if found is None else found.union(hits.select(*found.columns))
    if found is None:
        return docs.sparkSession.createDataFrame([], "key long, digest string, item_id long, start int, similarity double")
    met = materialize(found, "met")
    rare = light_or_shuffled(materialize(_rarest(table, met.groupBy("size", "run").agg(F.count("*").alias("seen")), percent), "rarest"))
    hits = materialize(
        met.join(rare, ["size", "run"]).groupBy("key", "item", "size", "length").agg(F.collect_set("at").alias("ats")), "hits"
    )

    # the windows: of each distinct text with a hit, where a hit lies inside
    hit_keys = light(materialize(hits.select("key").distinct(), "hit-keys"))
    texts = keyed.join(hit_keys, "key").groupBy("key", F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.first("text").alias("text"))
    texts = materialize(texts.withColumn("hashes", _word_hashes(F.col("text"))).drop("text"), "hit-texts")
    last = F.greatest(F.size("hashes") - F.col("length"), F.lit(0))
    starts = F.array_distinct(
        F.flatten(
            F.transform(
                "ats",
                lambda at: F.sequence(
                    F.greatest(at - (F.col("length") - F.col("size")), F.lit(0)).cast("int"),
                    F.greatest(F.least(at, last), F.greatest(at - (F.col("length") - F.col("size")), F.lit(0))).cast("int"),
                ),
            )
        )
    )
    name = ["key", "digest", "length", "start"]
    carried = materialize(
        texts.join(light_or_shuffled(hits, "ats"), "key")
        .select("key", "digest", "item", "size", "length", last.alias("last"), F.explode(starts).alias("start"))
        .where("start <= last")
        .drop("last"),
        "carried",
    )
    laid = shuffled(carried.select(*name, "size").distinct()).join(texts, ["key", "digest"])
    parts = []
    for size in sizes:
        slices = F.slice("hashes", F.col("start") + 1, F.col("length"))
        own = laid.where(F.col("size") == size).withColumn("part", slices)
        parts.append(
            own.select(
                "key",
                "digest",
                "length",
                "start",
                _run_hashes(F.col("part"), size, F.size("part")).alias("runs"),
            )
        )
    windows = parts[0]
    for p in parts[1:]:
        windows = windows.union(p)
    windows = materialize(windows, "windows")

    prints = _with_fingerprints(windows.select(*name, F.explode("runs").alias("run")), name)
    of_items = _with_fingerprints(table.select("item", "length", F.explode("runs").alias("run")), ["item", "length"])
    left = (
        shuffled(carried.select(*name, "item"))
        .join(prints, name)
        .select(*name, "item", "print", F.explode(_blocks(F.col("print"), radius)).alias("b"))
        .select(*name, "item", "print", "b.*")
    )
    right = of_items.select("item", F.col("print").alias("item_print"), F.explode(_blocks(F.col("print"), radius)).alias("b")).select(
        "item", "item_print", "b.*"
    )
    near = (
        left.join(light_or_shuffled(materialize(right, "item-blocks")), ["item", "block", "part"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
        .select(*name, "item")
        .distinct()
    )
    compared = (
        near.join(shuffled(windows), name)
        .join(light_or_shuffled(table.select("item", F.col("runs").alias("item_runs")), "item_runs"), "item")
        .withColumn("a", _numbered(F.col("runs")))
        .withColumn("b", _numbered(F.col("item_runs")))
        .withColumn("both", F.size(F.array_intersect("a", "b")))
        .withColumn("all", F.size("a") + F.size("b") - F.col("both"))
    )
    return compared.where(100 * F.col("both") >= percent * F.col("all")).join(light_or_shuffled(named), "item").select(
        "key", "digest", "item_id", "start", (F.col("both") / F.col("all")).alias("similarity")
    )


def _items(items: DataFrame) -> DataFrame:
    return items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))


def judged(docs: DataFrame, items: DataFrame, text: str = "text", percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """``docs`` with ``leaked``, ``leaked_items`` (sorted ids of the items that have one) and ``similarity`` (the greatest, 0 for a clean text)."""
    safe, names = clash_free(docs.drop("leaked", "leaked_items", "similarity"))
    leaks = find_leaks(safe.select(F.col(names[text]).alias("text")), _items(items), percent, radius)
    by_text = materialize(
        leaks.groupBy("key", "digest").agg(F.sort_array(F.collect_set("item_id")).alias("leaked_items"), F.max("similarity").alias("similarity")),
        "leaks",
    )
    value = F.col(names[text])
    joined = safe.withColumns({"key": F.xxhash64(value), "md5": F.md5(value.cast("binary"))}).join(
        light_or_shuffled(by_text.withColumnRenamed("key", "leak_key"), "leaked_items"),
        (F.col("key") == F.col("leak_key")) & (F.col("md5") == F.col("digest")),
        "left",
    )
    return joined.select(
        *(F.col(new).alias(old) for old, new in names.items()),
        F.col("similarity").isNotNull().alias("leaked"),
        F.coalesce("leaked_items", F.array().cast("array<long>")).alias("leaked_items"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
    )


def with_leaks(docs: DataFrame, items: DataFrame, text: str = "text", percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """``docs`` with ``leaked_items`` (sorted ids, empty for a clean text) and ``similarity`` (the greatest, 0 for a clean one), of the items with an id."""
    safe, names = clash_free(docs.drop("leaked_items", "similarity"))
    found = judged(safe, items.where("item_id IS NOT NULL"), names[text], percent, radius)
    return found.select(*(F.col(new).alias(old) for old, new in names.items()), "leaked_items", "similarity")


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that repeat no benchmark item."""
    safe, names = clash_free(docs)
    found = judged(safe, items, names[text])
    return found.where(~F.col("leaked")).select(*(F.col(new).alias(old) for old, new in names.items()))
