"""Jaccard similarity join on word shingles, filtered under several global token orders.

Two sets that reach the threshold must share a token among the first ``n - ceil(t n) + 1``
of each, under whatever global order the tokens have. So a pair is a candidate only if it
passes this test under every one of several orders; survivors are compared exactly.

Steps
1. Texts with the same set form one class; a hot copied text is one class from here on.
   Texts are read once: the sets are stored in chunks, which all later steps read.
2. The very first tokens under random orders tie classes to the most typical class that
   shares several of them. Pairs found so are verified, and components formed. This links
   near all of a large group of near copies by a star instead of all its pairs.
3. The full prefix filter under the main order (rare tokens first, so that passages many
   texts share come last) then finds every pair whose classes lie in different components
   and share a token early enough in both for their sizes, and enough of them in all.
4. Of what is left the prefixes under the other orders are fetched and intersected pair by
   pair. Only pairs that share a token under every order have their sets fetched and compared.

The result is exact: the first pass only takes away pairs that are connected already.

Defined cases: null and empty texts have an empty set and are linked with nothing; a row
without an id takes part through its text, but is nobody's ``component_id`` (its own is
that of its component, null if no member has an id); ids are integers, other types are an
error; repeated rows each get a row; an empty table gives none. Only the two named columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm.common import WIDE_SHARE, clash_free, join_counted, light, settled, ship, small_batches
from vigilog.llm.components import components
from vigilog.llm.membership import Membership
from vigilog.llm.words import SHINGLE, distinct, give_back, pieces, sequence_hashes, shingle_set, word_hashes
from vigilog.session import materialize

PERCENT = 80
ORDERS = 3  # prefixes that a pair must share under each of
FIRST_TOKENS = 6  # orders whose first token ties classes in step 2
FIRST_SHARED = 2
STORED = 100_000  # tokens in a chunk of sets, about
COUNTED = 1_000_000  # tokens a task looks through at a time for those that several sets hold
SLICE = 4_000_000  # bytes of text read together, about
SEEN = 50_000  # sets a task remembers
RANKED = 1 << 20  # most tokens with a rank of their own in the main order, 9 bytes each
PER_TASK = 64  # members compared with one copy of a class, or one in WIDE_SHARE of all pairs if that is more


def _multiplier(order: int) -> np.uint64:
    return np.uint64(pow(0x2545F4914F6CDD1D, 2 * order + 3, 1 << 64) | 1)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _first(tokens: np.ndarray, keys: np.ndarray, percent: int) -> np.ndarray:
    """The prefix of a set under the order of ``keys``, not in order."""
    size = prefix_size(len(tokens), percent)
    return tokens if size >= len(tokens) else tokens[np.argpartition(keys, size - 1)[:size]]


def _first_in_order(tokens: np.ndarray, keys: np.ndarray, percent: int) -> np.ndarray:
    size = prefix_size(len(tokens), percent)
    at = np.argpartition(keys, size - 1)[:size] if size < len(tokens) else np.arange(len(tokens))
    return tokens[at[np.argsort(keys[at])]]


def _node(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _digest(tokens: np.ndarray) -> bytes:
    return blake2b(tokens.tobytes(), digest_size=16).digest()


# A set's number is that of its chunk, and its place in it; a chunk's is that of its task, and its place there.
_PLACE_BITS = 20

_DESCRIBED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("n", pa.int64()),
        ("digest", pa.binary()),
        ("node", pa.int64()),
        ("sid", pa.int64()),
        ("first", pa.list_(pa.int64())),
        ("chunk", pa.int64()),
        ("nodes", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("tokens", pa.binary()),
        ("token", pa.int64()),
        ("seen", pa.int64()),
    ]
)
_DESCRIBED_SQL = (
    "doc_id long, text_key long, n long, digest binary, node long, sid long, first array<long>, "
    "chunk long, nodes array<long>, sizes array<long>, tokens binary, token long, seen long"
)


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _DESCRIBED], schema=_DESCRIBED
    )


def _text_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    words, ends = word_hashes(texts)
    runs = sequence_hashes(words, SHINGLE)
    low = 0
    for high in ends.tolist():
        n = high - low
        yield distinct(runs[low : high - SHINGLE + 1]) if n >= SHINGLE else shingle_set(words[low:high])
        low = high


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text, rows with the sets in chunks, and rows with the tokens that several sets of a chunk hold.

    A set is stored once for the texts a task meets in a row (SEEN of them at most); copies
    in other tasks are stored there, too, and left aside when classes are formed.
    """
    multipliers = np.array([_multiplier(k) for k in range(FIRST_TOKENS)])[:, None]
    seen: dict[bytes, tuple[int, list[int]]] = {}
    waiting: list[np.ndarray] = []
    counted: list[np.ndarray] = []
    nodes: list[int] = []
    size, chunk = 0, TaskContext.get().partitionId() << _PLACE_BITS

    def stored() -> pa.RecordBatch:
        tokens = np.concatenate(waiting)
        counted.append(tokens)
        return _rows(chunk=[chunk], nodes=[nodes], sizes=[[len(s) for s in waiting]], tokens=[tokens.tobytes()])

    def often() -> pa.RecordBatch:
        token, count = np.unique(np.concatenate(counted), return_counts=True)
        counted.clear()
        return _rows(token=token[count > 1].view(np.int64), seen=count[count > 1])

    for batch in batches:
        for part in pieces(batch, 2, SLICE):
            digests, sids, sizes, first = [], [], [], []
            for s in _text_sets(part.column(2)):
                digest = _digest(s)
                if len(s) and digest not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen[digest] = chunk << _PLACE_BITS | len(waiting), (s.view(np.int64)[(s * multipliers).argmin(1)]).tolist()
                    waiting.append(s)
                    nodes.append(_node(digest))
                    size += len(s)
                sid, tokens = seen[digest] if len(s) else (None, [])
                digests.append(digest)
                sids.append(sid)
                sizes.append(len(s))
                first.append(tokens)
                if size >= STORED or len(waiting) >= (1 << _PLACE_BITS) - 1:
                    yield stored()
                    waiting, nodes, size, chunk = [], [], 0, chunk + 1
                    if sum(map(len, counted)) >= COUNTED:
                        yield often()
            yield _rows(
                doc_id=part.column(0), text_key=part.column(1), n=sizes, digest=digests, node=[_node(d) for d in digests], sid=sids, first=first
            )
    if waiting:
        yield stored()
    if counted:
        yield often()
    seen.clear()
    give_back()


def _stored_sets(batches: Iterator[pa.RecordBatch], wanted: Membership | None = None) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Numbers and sets of each chunk (chunk, nodes, sizes, tokens), of those only whose node may be ``wanted``."""
    for batch in batches:
        for row in range(batch.num_rows):
            chunk, nodes, sizes, tokens = (batch.column(c)[row] for c in range(4))
            ends = np.cumsum(np.asarray(sizes.values)).tolist()
            tokens = np.frombuffer(tokens.as_buffer(), np.uint64)
            keep = range(len(ends)) if wanted is None else np.flatnonzero(wanted.may_hold(np.asarray(nodes.values))).tolist()
            base = chunk.as_py() << _PLACE_BITS
            yield [base | k for k in keep], [tokens[ends[k - 1] if k else 0 : ends[k]] for k in keep]


_CHUNK = ("chunk", "nodes", "sizes", "tokens")


def _prefixes(common: np.ndarray, level: np.ndarray, percent: int):
    """Of each set its prefix under the main order: rare tokens first, then by a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sids, sets in _stored_sets(batches):
            prefixes = []
            for s in sets:
                keys = (s * _multiplier(0)) >> np.uint64(6)
                if len(common):
                    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                    keys |= np.where(common[at] == s, level[at], 0).astype(np.uint64) << np.uint64(58)
                prefixes.append(_first_in_order(s, keys, percent).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))], names=["cid", "prefix"])

    return run


def _other_prefixes(wanted: Membership, percent: int):
    """Of each set its prefixes under the other orders, as 32 bits of the tokens: enough to rule pairs out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sids, sets in _stored_sets(batches, wanted):
            short = [[(_first(s, s * _multiplier(k), percent) >> np.uint64(32)).astype(np.uint32).view(np.int32) for s in sets] for k in range(1, ORDERS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sids, pa.int64()), *[pa.array(p, pa.list_(pa.int32())) for p in short]], names=["cid", *_OTHERS]
            )

    return run


_OTHERS = [f"p{k}" for k in range(1, ORDERS)]


def _kept_tokens(wanted: Membership):
    """A row for each token of a prefix that other components may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            size = np.asarray(pc.list_value_length(lists))
            row = np.repeat(np.arange(batch.num_rows), size)
            token = np.asarray(lists.flatten())
            pos = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
            keep = wanted.may_hold(token)
            at = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[keep]), pa.array(pos[keep])] + [batch.column(c).take(at) for c in (1, 2, 3)],
                names=["token", "pos", "comp", "cid", "n"],
            )

    return run


def _wanted_sets(wanted: Membership):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sids, sets in _stored_sets(batches, wanted):
            yield pa.RecordBatch.from_arrays(
                [pa.array(sids, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cid", "tokens"]
            )

    return run


def _compare(percent: int):
    """Rows come sorted: a class's own set, then those to compare with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, None
        for batch in batches:
            a, b = [], []
            for pivot, salt, member, tokens in zip(*(batch.column(c).to_pylist() for c in range(4))):
                s = np.frombuffer(tokens, np.uint64)
                if member is None:
                    key, own = (pivot, salt), s
                    continue
                if key != (pivot, salt):
                    raise ValueError("a class without its own set")
                merged = np.sort(np.concatenate((own, s)))
                both = int((merged[1:] == merged[:-1]).sum())
                if 100 * both >= percent * (len(own) + len(s) - both):
                    a.append(pivot)
                    b.append(member)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["u", "v"])

    return run


def _in_every_order(chunks: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share a prefix token under the other orders as well."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    wanted = materialize(ends.join(classes.select("cid", "node"), "cid"), "ends")
    short = chunks.mapInArrow(
        _other_prefixes(Membership.of(wanted, F.col("node")), percent), "cid long, " + ", ".join(f"{p} array<int>" for p in _OTHERS)
    )
    held = materialize(short.join(light(wanted.select("cid")), "cid", "left_semi"), "orders")
    a, b = (held.select(F.col("cid").alias(side), *[F.col(p).alias(side + p) for p in _OTHERS]) for side in "ab")
    total = pairs.count()
    counted = materialize(pairs.groupBy("a").agg(F.count("*").alias("_m")).join(a, "a"), "firsts")
    both = join_counted(pairs, counted, ["a"], "_m", total).drop("_m")
    counted = materialize(pairs.groupBy("b").agg(F.count("*").alias("_m")).join(b, "b"), "seconds")
    both = join_counted(both, counted, ["b"], "_m", total)
    shared = [F.arrays_overlap(F.col("a" + p), F.col("b" + p)) for p in _OTHERS]
    return both.where(reduce(Column.__and__, shared)).select("a", "b")


def _verify(chunks: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of class numbers whose sets reach the threshold, as (u, v).

    Only sets of classes in a pair are fetched. A class with many partners is copied, so
    that no task compares more than a small share of all pairs with it.
    """
    pairs = materialize(pairs.select("a", "b").distinct(), "pairs")
    total = pairs.count()
    per_task = max(PER_TASK, total // WIDE_SHARE)
    parts = materialize(pairs.groupBy("a").agg(F.count("*").alias("_m")).withColumn("last", F.floor(F.col("_m") / per_task).cast("int")), "parts")
    salted = join_counted(pairs, parts, ["a"], "_m", total).select(
        "a", F.pmod(F.xxhash64("b"), F.col("last") + 1).cast("int").alias("salt"), "b", F.col("b").alias("cid")
    )
    own = parts.select(
        "a", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("salt"), F.lit(None).cast("long").alias("b"), F.col("a").alias("cid")
    )
    needs = materialize(salted.union(own).join(classes.select("cid", "node"), "cid"), "needs")
    sets = chunks.mapInArrow(_wanted_sets(Membership.of(needs, F.col("node"))), "cid long, tokens binary")
    ordered = (
        sets.join(light(needs.drop("node")), "cid")
        .select("a", "salt", "b", "tokens")
        .repartition("a", "salt")
        .sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    )
    return ordered.mapInArrow(_compare(percent), "u long, v long").distinct()


def _alike(x: str, y: str, percent: int):
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _star_pairs(classes: DataFrame, percent: int) -> DataFrame:
    """Each class with a hub that shares its first token under several orders.

    The hub of the classes with one first token is the most typical: that whose first
    tokens are shared by most. An original is closer to its edited copies than they are
    to each other, and has the tokens that most of them keep.
    """
    first = materialize(classes.select("cid", "n", "copies", F.posexplode("first").alias("k", "token")), "first")
    total = first.count()
    shared = materialize(first.groupBy("k", "token").agg(F.count("*").alias("members")).where("members > 1"), "shared")
    keyed = materialize(join_counted(first, shared, ["k", "token"], "members", total), "keyed")
    typical = keyed.groupBy("cid").agg(F.sum("members").alias("typical"))
    hubs = materialize(
        keyed.join(typical, "cid")
        .groupBy("k", "token", "members")
        .agg(F.max(F.struct("typical", "copies", (-F.col("cid")).alias("minus"), F.col("n").alias("size"))).alias("hub"))
        .select("k", "token", "members", (-F.col("hub.minus")).alias("a"), F.col("hub.size").alias("size")),
        "hubs",
    )
    tied = join_counted(keyed.drop("members"), hubs, ["k", "token"], "members", total).where((F.col("cid") != F.col("a")) & _alike("n", "size", percent))
    return tied.groupBy("a", F.col("cid").alias("b")).count().where(F.col("count") >= FIRST_SHARED)


def _cross_pairs(chunks: DataFrame, classes: DataFrame, common: tuple[np.ndarray, np.ndarray], percent: int) -> DataFrame:
    """Pairs of classes of different components that pass the main order's prefix filter."""
    prefixes = materialize(chunks.mapInArrow(_prefixes(*common, percent), "cid long, prefix array<long>"), "prefixes")
    held = prefixes.join(light(classes.select("comp", "cid", "n")), "cid").select("prefix", "comp", "cid", "n")
    shared = materialize(
        held.select(F.explode("prefix").alias("token"), "comp")
        .groupBy("token")
        .agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        .where("low < high")
        .select("token"),
        "shared",
    )
    rows = held.mapInArrow(_kept_tokens(Membership.of(shared, F.col("token"))), "token long, pos long, comp long, cid long, n long")
    # A pair needs a common token that is early enough in both: (100 + p) * (n - pos) >= p * (n + m), m the other's size.
    slack = 100 * F.col("n") - (100 + percent) * F.col("pos")
    near = materialize(
        rows.join(light(shared), "token", "left_semi").distinct().select("token", "comp", "cid", "n", slack.alias("slack")), "near"
    )
    # Components first, the one with fewer members first of two: the many of a large one are looked at only for survivors.
    groups = near.groupBy("token", "comp").agg(F.count("*").alias("c"), F.min("n").alias("n"), F.max("slack").alias("slack"))
    fewer, more = (groups.select("token", *[F.col(x).alias(side + x) for x in ("comp", "c", "n", "slack")]) for side in ("a_", "b_"))
    ordered = (F.col("a_c") < F.col("b_c")) | (F.col("a_c") == F.col("b_c")) & (F.col("a_comp") < F.col("b_comp"))
    early = (F.col("a_slack") >= percent * F.col("b_n")) & (F.col("b_slack") >= percent * F.col("a_n"))
    met = fewer.join(more, "token").where(ordered & early).select("token", "a_comp", "b_comp", "b_n")
    x, y = (near.select("token", *[F.col(f).alias(side + t) for f, t in (("comp", "comp"), ("cid", ""), ("n", "size"), ("slack", "early"))]) for side in ("a_", "b_"))
    first = met.join(x, ["token", "a_comp"]).where(F.col("a_early") >= percent * F.col("b_n"))
    fits = (F.col("a_early") >= percent * F.col("b_size")) & (F.col("b_early") >= percent * F.col("a_size"))
    pairs = first.join(y, ["token", "b_comp"]).where(fits & _alike("a_size", "b_size", percent))
    found = pairs.select(F.col("a_").alias("a"), F.col("b_").alias("b")).distinct()
    # Common tokens up to the end of the shorter prefix are all counted; behind it are at most the rest of that set.
    tokens = near.groupBy("cid", "n").agg(F.collect_set("token").alias("tokens"))  # of one prefix
    a, b = (tokens.select(F.col("cid").alias(side), F.col("n").alias(f"n{side}"), F.col("tokens").alias(f"t{side}")) for side in "ab")
    rest = F.greatest(*(F.ceil(F.col(n) * percent / F.lit(100)) - 1 for n in ("na", "nb")))
    needed = F.ceil((F.col("na") + F.col("nb")) * percent / F.lit(100 + percent))
    counted = found.join(a, "a").join(b, "b").where(F.size(F.array_intersect("ta", "tb")) + rest >= needed)
    return counted.select("a", "b")


def _labelled(docs: DataFrame, percent: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_key, n, root, component_id) for every row; ``root`` names its component, null for an empty set."""
    ship(docs.sparkSession)
    value = F.col(text).cast("string")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(value).alias("text_key"), value.alias("text"))
    with small_batches(docs.sparkSession):  # all steps in Python write their results within
        described = settled(docs.sparkSession, "sets", lambda: texts.mapInArrow(_describe, _DESCRIBED_SQL), compression="none")
        rows, labels = _labels(described, percent)
    return rows.select("doc_id", "text_key", "n", "digest").join(light(labels), "digest", "left").drop("digest")


def _labels(described: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows of texts, and (digest, root, component_id) of every class."""
    spark = described.sparkSession
    rows = described.where("digest IS NOT NULL").select("doc_id", "text_key", "n", "digest", "node", "sid", "first")
    chunks = described.where("chunk IS NOT NULL").select(*_CHUNK)
    classes = settled(
        spark,
        "classes",
        lambda: rows.where("n > 0")
        .groupBy("digest", "node", "n", "first")
        .agg(F.min("sid").alias("cid"), F.min("doc_id").alias("first_id"), F.count("*").alias("copies")),
    )
    ranks = (
        described.where("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen")).orderBy(F.desc("seen"), "token").limit(RANKED)
    ).toArrow()
    common = ranks.column("token").to_numpy().view(np.uint64)
    level = np.minimum(np.log2(ranks.column("seen").to_numpy().astype(float)).astype(np.int64), 63)
    order = np.argsort(common)
    ranked = common[order], level[order].astype(np.uint8)

    tied = settled(spark, "tied", lambda: components(_verify(chunks, classes, _star_pairs(classes, percent), percent)))
    comps = settled(
        spark,
        "comps",
        lambda: classes.join(light(tied), classes["cid"] == tied["node"], "left").select(classes["*"], F.coalesce("root", "cid").alias("comp")),
    )
    pairs = settled(spark, "cross", lambda: _cross_pairs(chunks, comps, ranked, percent))
    likely = settled(spark, "likely", lambda: _in_every_order(chunks, comps, pairs, percent))
    links = settled(spark, "links", lambda: _verify(chunks, comps, likely, percent))

    def labelled() -> DataFrame:
        comp_of = comps.select("cid", "comp")
        edges = links.join(comp_of.select(F.col("cid").alias("u"), F.col("comp").alias("cu")), "u").join(
            comp_of.select(F.col("cid").alias("v"), F.col("comp").alias("cv")), "v"
        )
        joined = components(edges.select(F.col("cu").alias("u"), F.col("cv").alias("v")))
        rooted = materialize(
            comps.join(joined.select(F.col("node").alias("comp"), "root"), "comp", "left").select(
                "digest", "first_id", F.coalesce("root", "comp").alias("root")
            ),
            "rooted",
        )
        least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
        return rooted.join(least, "root").select("digest", "root", "component_id")

    labels = settled(spark, "labels", labelled)
    return rows, labels


def jaccard_components(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    found = _labelled(docs, percent, doc_id, text)
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one_of_each(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: of the least id (null last), then of the least text checksum, then any of equal rows.

    Rows are told apart by id and text, so rows of one id with different texts are judged
    apart, and copies without an id are copies as well. Rows with an empty set all stay.
    """
    spark = docs.sparkSession
    found = settled(spark, "components", lambda: _labelled(docs, percent, doc_id, text).where("n > 0").select("doc_id", "text_key", "root"))
    which = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    keys = found.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("rows"))
    firsts = keys.groupBy("root").agg(F.min(which).alias("first"), F.count("*").alias("members"))

    def odd_rows() -> DataFrame:
        total, chosen = materialize(keys, "keys"), materialize(firsts, "firsts")
        judged = join_counted(total, chosen, ["root"], "members", total.count()).select(
            F.col("doc_id").alias("id"), "text_key", F.expr("first.doc_id <=> doc_id AND first.text_key = text_key").alias("stays"), "rows"
        )
        return judged.where("NOT stays OR rows > 1")

    odd = settled(spark, "odd", odd_rows)

    safe, names = clash_free(docs)
    keyed = safe.withColumns({"id": F.col(names[doc_id]).cast("long"), "text_key": F.xxhash64(F.col(names[text]).cast("string"))})
    o = odd.select(F.col("id").alias("other"), F.col("text_key").alias("other_key"), "stays")
    same = keyed["id"].eqNullSafe(F.col("other")) & (keyed["text_key"] == F.col("other_key"))
    back = [F.col(new).alias(old) for old, new in names.items()]
    if not odd.where("stays").limit(1).count():
        return keyed.join(light(o), same, "left_anti").select(*back)
    marked = keyed.join(light(o), same, "left")
    single = marked.where("other_key IS NULL").select(*back)
    # rows that are there several times: one of them stays
    return single.unionByName(marked.where("stays").dropDuplicates(["id", "text_key"]).select(*back))
