"""Prefix trie of conversations, its subtree totals rolled up in bands of depth.

Each distinct sequence of first turns is a node. A node's key is the depth and 128 bits
that every turn up to it has been mixed into (exclusive or of hashes of place and turn), so
a parent's key follows from the child's, and running keys are combined from blocks.

Depth-band rollup: levels are cut into bands of ``HEIGHT``. A node gives its values only to
its ancestors within the band, so it is copied ``HEIGHT`` times at most. The tops of the
bands then form a trie of their own, a ``HEIGHT``-th as deep, whose totals are found in the
same way; the completed total of a top is carried to its ancestors in the band above. The
number of rounds grows with the logarithm of the depth.

Nothing is gathered by conversation or by node: turns are put in order by one range sort,
which splits a conversation of any length, and are numbered from counts of its pieces; a
node of many members is added up within the tasks first; the few parents of very many
children are joined apart, by a broadcast of 1,000 rows at most.

Defined cases: rows without a conversation id are left out; turns come in order of number
(null first), those of one number in order of a checksum of role and text, so repeated rows
are turns of their own and the order of the table does not matter; null role or text counts
as empty; no conversations give no nodes. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.llm.common import light
from vigilog.session import materialize

HEIGHT = 16
GROUP = 5  # conversations that are rebuilt on the first one's turns
HEADS = 9  # lengths of the part taken from there: 0 to 8
BLOCK = 4096  # turns of a conversation that are mixed in one window
LISTED = 10  # ids that agree but for so many low bits are listed together
WIDE = 1000  # a parent of more than one in so many nodes is joined apart; there are fewer than that

KEY = ["depth", "a", "b"]


def ordered_turns(conversations: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> tuple[DataFrame, DataFrame]:
    """Turns (conv, piece, at, digest, bytes) in order of ``at``, and pieces (conv, piece, first, n, before).

    A piece is what a partition of the range sort holds of a conversation; a turn's place
    in it is at - first + before + 1.
    """
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    narrow = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.md5(F.concat(F.length(r).cast("string"), F.lit(":"), r, t)).alias("digest"),
        F.octet_length(t).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),  # splits what is equal in all else
    )
    order = ["conv", F.asc_nulls_first("turn"), "digest", "row"]
    ranged = materialize(narrow, "narrow").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(
        ranged.select("conv", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("at"), "digest", "bytes"), "turns"
    )
    pieces = placed.groupBy("conv", "piece").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    return placed, materialize(pieces.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "pieces")


def _head(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def rebuilt(placed: DataFrame, pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, depth, digest, bytes, length) of the rebuilt conversations, and all of these (conv, length).

    The first h turns are those of the first conversation of the group of ``GROUP``, h
    depending on the id; the conversation's own turns after its first h follow.
    """
    base = F.try_subtract("conv", F.pmod("conv", F.lit(GROUP)))
    sizes = pieces.groupBy("conv").agg(F.sum("n").alias("n")).withColumn("base", F.coalesce(base, "conv"))
    of_base = F.max(F.when(F.col("conv") == F.col("base"), F.col("n"))).over(Window.partitionBy("base"))  # GROUP rows
    heads = sizes.withColumn("head", _head(F.col("conv"))).withColumn("taken", F.least("head", F.coalesce(of_base, F.lit(0))))
    length = F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))
    convs = materialize(heads.select("conv", "head", "taken", length.alias("length")), "convs")

    known = pieces.join(convs, "conv")
    numbered = placed.join(known, ["conv", "piece"]).withColumn("place", F.col("at") - F.col("first") + F.col("before") + 1)
    own = numbered.where(F.col("place") > F.col("head")).select(
        "conv", (F.col("place") - F.col("head") + F.col("taken")).alias("depth"), "digest", "bytes", "length"
    )
    lent = (
        numbered.where((F.pmod("conv", F.lit(GROUP)) == 0) & (F.col("place") < HEADS))
        .select(F.explode(F.array(*[F.try_add("conv", F.lit(k)) for k in range(GROUP)])).alias("conv"), F.col("place").alias("depth"), "digest", "bytes")
        .where(F.col("depth") <= _head(F.col("conv")))
        .join(convs.select("conv", "length"), "conv")
    )
    return own.unionByName(lent), convs.select("conv", "length")


def keyed(turns: DataFrame) -> DataFrame:
    """(conv, depth, a, b, parent_a, parent_b, bytes, last): the key of each prefix; ``last`` if the conversation ends there."""
    own = {"ga": F.xxhash64("depth", "digest"), "gb": F.xxhash64(F.lit("second"), "digest", "depth")}
    mixed = turns.withColumns(own).withColumn("block", F.floor(F.col("depth") / BLOCK))
    totals = mixed.where(F.col("length") >= BLOCK).groupBy("conv", "block").agg(F.bit_xor("ga").alias("ta"), F.bit_xor("gb").alias("tb"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    before = materialize(
        totals.select("conv", "block", F.bit_xor("ta").over(earlier).alias("ta"), F.bit_xor("tb").over(earlier).alias("tb")).where("ta IS NOT NULL"),
        "mixed",
    )
    so_far = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = mixed.withColumns({"ra": F.bit_xor("ga").over(so_far), "rb": F.bit_xor("gb").over(so_far)})
    whole = running.join(light(before), ["conv", "block"], "left").withColumns(
        {x: F.col(f"r{x}").bitwiseXOR(F.coalesce(f"t{x}", F.lit(0).cast("long"))) for x in "ab"}
    )
    parents = [F.col(x).bitwiseXOR(F.col(f"g{x}")).alias(f"parent_{x}") for x in "ab"]
    return whole.select("conv", "depth", "a", "b", *parents, "bytes", (F.col("depth") == F.col("length")).alias("last"))


def band_totals(nodes: DataFrame, paths: DataFrame, values: list[str], deepest: int, height: int = HEIGHT) -> DataFrame:
    """(depth, a, b, conv, *values): each node's values summed over its subtree.

    ``nodes`` are (depth, a, b, conv, *values), conv being a member; ``paths`` are (conv,
    depth, a, b), the keys along every member that stands for a node.
    """
    band = F.floor(F.col("depth") / height)
    lines = paths.groupBy("conv", band.alias("band")).agg(F.collect_list(F.struct(*KEY)).alias("line"))  # height entries at most
    if deepest >= height:
        lines = materialize(lines, "lines")
    sums = [F.sum(v).alias(v) for v in values]
    above = nodes.withColumn("band", band).join(lines, ["conv", "band"])
    given = above.select("conv", F.col("depth").alias("from"), *values, F.explode(F.filter("line", lambda x: x["depth"] <= F.col("depth"))).alias("up"))
    itself = F.max(F.when(F.col("from") == F.col("up.depth"), F.col("conv"))).alias("conv")
    within = given.groupBy(*[F.col(f"up.{k}").alias(k) for k in KEY]).agg(itself, *sums).select(*KEY, "conv", *values)
    if deepest < height:
        return within
    within = materialize(within, "within")

    def tops(df: DataFrame) -> DataFrame:
        return df.where(F.col("depth") % height == 0).withColumn("depth", F.floor(F.col("depth") / height))

    done = band_totals(tops(within), tops(paths), values, deepest // height, height)
    carried = (
        done.where("depth > 0")
        .withColumn("band", F.col("depth") - 1)
        .join(lines, ["conv", "band"])
        .select(F.explode("line").alias("up"), *values)
        .select(*[F.col(f"up.{k}").alias(k) for k in KEY], F.lit(None).cast("long").alias("conv"), *values)
    )
    return within.unionByName(carried).groupBy(*KEY).agg(F.max("conv").alias("conv"), *sums)


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` (with n_children) and the ``parent_conv_id`` of each."""
    least = nodes.count() // WIDE
    above = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv").alias("parent_conv_id"), "n_children"
    )
    key = ["depth", "parent_a", "parent_b"]
    wide = above.where(F.col("n_children") > least).drop("n_children").withColumnRenamed("parent_conv_id", "wide")
    tagged = nodes.join(F.broadcast(wide), key, "left")
    apart = tagged.where("wide IS NOT NULL OR depth = 0").withColumn("parent_conv_id", F.col("wide"))
    rest = tagged.where("wide IS NULL AND depth > 0").join(above.where(F.col("n_children") <= least).drop("n_children"), key)
    return apart.unionByName(rest).drop("wide")


def prefix_trie(turns: DataFrame, convs: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """Nodes and, for each node, the conversations that end there.

    Nodes are (depth, a, b, conv, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens), conv being the least member; ends are (depth, a, b, block, ids), ids
    ascending within and over blocks. ``turns`` and ``convs`` are as ``rebuilt`` gives them.
    """
    members = materialize(keyed(turns), "members")
    zero = F.lit(0).cast("long")
    top = [zero.alias(x) for x in KEY]
    inner = members.groupBy(*KEY).agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), *[F.max(x).alias(x) for x in ("bytes", "parent_a", "parent_b")]
    )
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0")
    nodes = materialize(inner.unionByName(root.select(*top, "conv", "n_convs", zero.alias("bytes"), zero.alias("parent_a"), zero.alias("parent_b"))), "nodes")
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("a"), F.col("parent_b").alias("b"))
        .agg(F.count("*").alias("n_children"))
    )
    family = materialize(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", zero)), "family")

    own = {"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")}
    paths = members.select("conv", *KEY).unionByName(convs.select("conv", *top))
    deepest = family.agg(F.max("depth")).first()[0] or 0
    values = list(own)
    totals = band_totals(family.withColumns(own).select(*KEY, "conv", *values), paths, values, deepest, height)
    found = _with_parents(family.drop("bytes")).drop("parent_a", "parent_b").join(totals.drop("conv"), KEY)

    ended = members.where("last").select(*KEY, "conv").unionByName(convs.where("length = 0").select(*top, "conv"))
    ends = ended.groupBy(*KEY, F.shiftright("conv", LISTED).alias("block")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    return found, ends


def _joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, a, b, text) sorted by key: the SHA-256 of each key's texts, joined by commas."""
    key, state = None, hashlib.sha256()
    for batch in batches:
        rows = []
        for *now, text in zip(*(batch.column(c).to_pylist() for c in range(4))):
            if now != key:
                if key is not None:
                    rows.append((*key, state.hexdigest()))
                key, state = now, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        yield _digests(rows)
    if key is not None:
        yield _digests([(*key, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    types = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[*KEY, "sha256"])


def listed_digests(ends: DataFrame) -> DataFrame:
    """(depth, a, b, sha256) of each node's ids, comma-joined: a stream over sorted blocks, whose state is 32 bytes."""
    text = F.concat_ws(",", F.col("ids").cast("array<string>")).alias("text")
    blocks = ends.select(*KEY, "block", text).repartition(*KEY).sortWithinPartitions(*KEY, "block")
    return blocks.select(*KEY, "text").mapInArrow(_joined_digests, "depth long, a long, b long, sha256 string")
