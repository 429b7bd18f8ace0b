"""Language-model scores by deleted interpolation of word n-grams, of three words by default.

The probability of a word mixes estimates of all orders: how often it followed the last two
words, the last one, how often it occurs, and a uniform one. The weights depend on how often
the context was seen (by powers of two) and are learned by expectation-maximisation on
held-out counts: a fifth of the documents, each occurrence taken out of the counts before
it is predicted. Weights of the pair, word and uniform estimates are learned first; each
longer order is then mixed with the model below it. At the first word of a text, which
has no longer context, every order gives the pair estimate.

No table of n-grams is ever held in one place. Texts are cut into chunks of about
``CHUNK`` tokens. A chunk asks for its distinct n-grams once, however often they occur;
the requests, which carry the chunk's own counts, are dealt out by n-gram, added up, and
the totals sent back. So a frequent word costs a number for each chunk, and the buckets
that add up are of equal size. Requests, answers and chunks are packed column by column.
Words have numbers of 64 bits; of longer n-grams only as many bits are kept as tell them
apart but for one in a million.

Defined cases: a null or empty text is the end token alone; a null id counts as 0 when
documents are held out; repeated rows are scored one by one, each with the same score;
without training rows every count is 0 and the uniform estimate is left; an empty table
gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.llm.common import ship
from vigilog.llm.words import mix, pieces, word_hashes
from vigilog.session import materialize

FOLDS, TEST, TUNING = 5, 1, 0  # remainder of documents that are not learned from; that weights are learned on
CHUNK = 1_000_000  # tokens
BUCKET = 2_000_000  # numbers that are added up at a time, about
LEVELS = 40  # of context frequency
STEPS = 20  # bins a factor of ten, for the tuning counts
ROUNDS = 60

_END = np.uint64(0x5851F42D4C957F2D)  # stands for the end of a text, which is also the context of its first word
_LEARNED, _HELD_OUT, _TUNING = 0, 1, 2


def pack(numbers: np.ndarray) -> bytes:
    """64-bit numbers, byte by byte of each place, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1).T.tobytes(), np.uint64)


def pack_sorted(numbers: np.ndarray) -> bytes:
    return pack(np.diff(numbers, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


_CHUNKS = "chunk long, kind int, doc_ids array<long>, sizes array<long>, words binary, tokens binary"


ORDER = 3


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of one kind as numbers: distinct words, and the place of each token among them."""
    open_chunks: dict[int, tuple[list, list]] = {}
    chunk = TaskContext.get().partitionId() << 32

    def row(kind: int) -> pa.RecordBatch:
        nonlocal chunk
        ids, parts = open_chunks.pop(kind)
        words, at = np.unique(np.concatenate(parts), return_inverse=True)
        chunk += 1
        columns = [[chunk - 1], [kind], [ids], [[len(p) for p in parts]], [pack_sorted(words)], [pack(at)]]
        types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["chunk", "kind", "doc_ids", "sizes", "words", "tokens"]
        )

    tokens: dict[int, int] = {}
    for batch in batches:
        for part in pieces(batch, 1):
            found, ends = word_hashes(part.column(1))
            low = 0
            for doc_id, kind, high in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), ends.tolist()):
                ids, parts = open_chunks.setdefault(kind, ([], []))
                ids.append(doc_id)
                parts.append(np.append(found[low:high], _END))
                low = high
                tokens[kind] = tokens.get(kind, 0) + len(parts[-1])
                if tokens[kind] >= CHUNK:
                    tokens[kind] = 0
                    yield row(kind)
    for kind in list(open_chunks):
        yield row(kind)


class Chunk:
    """The distinct n-grams of a chunk in ascending order; words are odd numbers, longer ones even ones without their ``cleared`` low bits.

    ``places[k]`` are the places of the n-grams of k + 1 words that end at each token, and
    ``contexts[k]`` those of the k words before it.
    """

    def __init__(self, sizes, words: bytes, tokens: bytes, order: int = ORDER, cleared: int = 1):
        values, at = unpack_sorted(words), unpack(tokens).astype(np.int64)
        self.ends = np.cumsum(np.asarray(sizes, np.int64))
        first = np.append(0, self.ends[:-1])
        keep = ~np.uint64((1 << cleared) - 1)
        runs = values[at]
        own, keys, inside = mix(runs), [mix(values) | np.uint64(1)], [at]
        for k in range(1, order):
            before = np.empty_like(runs)
            before[1:] = runs[:-1]
            before[first] = _END
            runs = mix(before * np.uint64(3) + own + np.uint64(k - 1))
            distinct, place = np.unique(runs & keep, return_inverse=True)
            keys.append(distinct)
            inside.append(place)
        together = np.concatenate(keys)
        order_of = np.argsort(together)
        self.keys = together[order_of]
        place_of = np.empty(len(order_of), np.int64)
        place_of[order_of] = np.arange(len(order_of))
        starts = np.cumsum([0, *map(len, keys)])
        self.places = [place_of[i + s] for i, s in zip(inside, starts)]
        end = place_of[np.searchsorted(values, _END)]
        self.contexts = [None]
        for k in range(1, order):
            context = np.empty_like(at)
            context[1:] = self.places[k - 1][:-1]
            context[first] = end
            if k > 1:  # the first word of a text has the pair's context and estimate
                self.places[k][first] = self.places[1][first]
            self.contexts.append(context)
        self.order = order

    def counts(self) -> np.ndarray:
        total = np.bincount(self.places[0], minlength=len(self.keys))
        first = np.append(0, self.ends[:-1])
        for k in range(1, self.order):
            counted = self.places[k] if k == 1 else np.delete(self.places[k], first)
            total = total + np.bincount(counted, minlength=len(self.keys))
        return total


def _cleared(total: int) -> int:
    """Low bits that longer n-grams can do without: whole bytes, as those pack away, and one bit at least."""
    spare = 64 - (max(total, 1).bit_length() + 20)
    return max(1, spare // 8 * 8)


def _edges(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that sorted keys fall into, and where each begins."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    begin = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1))
    return bucket[begin], begin


def _requests(bits: int, order: int, cleared: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, kind, sizes, words, tokens = (batch.column(c)[i].as_py() for c in range(5))
                chunk = Chunk(sizes, words, tokens, order, cleared)
                counts = chunk.counts().astype(np.uint64) * np.uint64(kind != _HELD_OUT)
                buckets, begin = _edges(chunk.keys, bits)
                end = [*begin[1:].tolist(), len(chunk.keys)]
                spans = list(zip(begin.tolist(), end))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(buckets, pa.int64()),
                        pa.array([number] * len(spans), pa.int64()),
                        pa.array([pack_sorted(chunk.keys[a:b]) for a, b in spans], pa.binary()),
                        pa.array([pack(counts[a:b]) for a, b in spans], pa.binary()),
                    ],
                    names=["bucket", "chunk", "keys", "counts"],
                )

    return run


_ANSWERS = "bucket long, chunk long, totals binary, words long, tokens long"


def _add_up(group: pa.Table) -> pa.Table:
    """The totals of a bucket's n-grams for each chunk that asked, and its share of the vocabulary."""
    keys = [unpack_sorted(k) for k in group.column("keys").to_pylist()]
    counts = np.concatenate([unpack(c) for c in group.column("counts").to_pylist()])
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(at, counts.astype(np.float64), len(known)).astype(np.uint64)  # exact up to 2**53
    each = totals[at]
    ends = np.cumsum([len(k) for k in keys]).tolist()
    packed = [pack(each[e - len(k) : e]) for k, e in zip(keys, ends)]
    odd = known & np.uint64(1) == 1
    n, none = len(packed), pa.nulls(1, pa.int64())
    bucket = group.column("bucket")[0].as_py()
    return pa.table(
        {
            "bucket": pa.array([bucket] * (n + 1), pa.int64()),
            "chunk": pa.chunked_array([*group.column("chunk").chunks, none]),
            "totals": pa.array([*packed, None], pa.binary()),
            "words": pa.array([None] * n + [int((totals[odd] > 0).sum())], pa.int64()),
            "tokens": pa.array([None] * n + [int(totals[odd].sum())], pa.int64()),
        }
    )


def _resolved(own: pa.Table, answers: pa.Table, order: int, cleared: int) -> tuple[Chunk, np.ndarray]:
    chunk = Chunk(*(own.column(c)[0].as_py() for c in ("sizes", "words", "tokens")), order, cleared)
    parts = sorted(zip(answers.column("bucket").to_pylist(), answers.column("totals").to_pylist()))
    return chunk, np.concatenate([unpack(t) for _, t in parts]).astype(np.float64)


class Model(NamedTuple):
    """What scoring needs: sizes, the mixture weights (pair, word, uniform) by level, and those of each longer order."""

    n_tokens: int
    n_words: int
    order: int
    cleared: int
    weights: np.ndarray | None = None
    longer: tuple[np.ndarray, ...] = ()

    def probability(self, chunk: Chunk, totals: np.ndarray, upto: int, taken: int = 0) -> np.ndarray:
        """Of each token by the orders below ``upto``; ``taken`` is 1 if each occurrence is taken out of the counts."""
        word, pair, context = (totals[x] - taken for x in (chunk.places[0], chunk.places[1], chunk.contexts[1]))
        w = self.weights[_level(context)]
        p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * word / max(self.n_tokens - taken, 1) + w[:, 2] / (self.n_words + 1)
        for k in range(2, upto):
            gram, context = totals[chunk.places[k]] - taken, totals[chunk.contexts[k]] - taken
            share = self.longer[k - 2][_level(context)]
            p = share * gram / np.maximum(context, 1) + (1 - share) * p
        return p


def _level(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two of its count."""
    return np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + 1, LEVELS - 1), 0)


def _bin(p: np.ndarray) -> np.ndarray:
    """-1 for 0, else how many 1 / STEPS of a factor of ten below 1."""
    return np.where(p > 0, np.rint(-STEPS * np.log10(np.where(p > 0, p, 1.0))), -1).astype(np.int64)


def _tuning_counts(model: Model, k: int):
    """How often each combination of context level and estimates occurs, without the occurrence itself.

    The estimates are those of the pair and the word, or for longer orders that of the order and of the model below it.
    """

    def run(own: pa.Table, answers: pa.Table) -> pa.Table:
        found = {"level": [], "high_bin": [], "low_bin": [], "n": []}
        if own.num_rows:
            chunk, totals = _resolved(own, answers, model.order, model.cleared)
            gram, context = totals[chunk.places[k]] - 1, totals[chunk.contexts[k]] - 1
            below = (totals[chunk.places[0]] - 1) / max(model.n_tokens - 1, 1) if k == 1 else model.probability(chunk, totals, k, taken=1)
            cells = np.stack((_level(context), _bin(gram / np.maximum(context, 1)), _bin(below)))
            cells, n = np.unique(cells, axis=1, return_counts=True)
            found = dict(zip(found, (*cells, n)))
        return pa.table({name: pa.array(v, pa.int64()) for name, v in found.items()})

    return run


def _of_bin(found: np.ndarray) -> np.ndarray:
    return np.where(found >= 0, 10.0 ** (-found / STEPS), 0.0)


def learn_share(level: np.ndarray, high_bin: np.ndarray, low_bin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weight of an order against the model below it at each context level, by expectation-maximisation."""
    high, low = _of_bin(high_bin), _of_bin(low_bin)
    share = np.full(LEVELS, 0.5)
    for _ in range(ROUNDS):
        s = share[level]
        taken = n * s * high / np.maximum(s * high + (1 - s) * low, 1e-300)
        share = (np.bincount(level, taken, LEVELS) + 0.01) / (np.bincount(level, n, LEVELS) + 0.02)
    return share


def learn_weights(level: np.ndarray, pair_bin: np.ndarray, word_bin: np.ndarray, n: np.ndarray, n_words: int) -> np.ndarray:
    """Mixture weights (pair, word, uniform) of each context level, by expectation-maximisation."""
    estimate = np.stack(
        [
            _of_bin(pair_bin),
            _of_bin(word_bin),
            np.full(len(n), 1.0 / (n_words + 1)),
        ]
    )
    weights = np.full((LEVELS, 3), 1 / 3)
    for _ in range(ROUNDS):
        share = weights[level].T * estimate
        share *= n / share.sum(0)
        sums = np.stack([np.bincount(level, s, LEVELS) for s in share], 1) + 0.01  # no weight ever becomes 0
        weights = sums / sums.sum(1, keepdims=True)
    return weights


_SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _scores(model: Model):
    def run(own: pa.Table, answers: pa.Table) -> pa.Table:
        found = {"doc_id": [], "n_tokens": [], "n_known": [], "base_score": [], "score": []}
        if own.num_rows:
            chunk, totals = _resolved(own, answers, model.order, model.cleared)
            word = totals[chunk.places[0]]
            base = np.log10((word + 0.5) / (model.n_tokens + 0.5 * (model.n_words + 1)))
            begin = np.concatenate(([0], chunk.ends[:-1]))
            mixed = model.probability(chunk, totals, model.order)
            sums = [np.add.reduceat(x, begin) for x in ((word > 0).astype(np.int64), base, np.log10(mixed))]
            found = dict(zip(found, (own.column("doc_ids")[0].as_py(), own.column("sizes")[0].as_py(), *sums)))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(found.items(), types)})

    return run


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row; ``order`` is 2 or more."""
    if order < 2:
        raise ValueError("the order must be 2 or more")
    ship(docs.sparkSession)
    fold = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS, F.lit(0))
    kind = F.when(fold == TEST, _HELD_OUT).when(fold == TUNING, _TUNING).otherwise(_LEARNED)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), kind.alias("kind"))
    chunks = materialize(texts.mapInArrow(_chunks, _CHUNKS), "chunks")

    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    bits = max(0, int(total // BUCKET).bit_length())
    cleared = _cleared(total)
    asked = chunks.select("chunk", "kind", "sizes", "words", "tokens").mapInArrow(
        _requests(bits, order, cleared), "bucket long, chunk long, keys binary, counts binary"
    )
    answered = materialize(asked.groupBy("bucket").applyInArrow(_add_up, _ANSWERS), "answers")
    sums = answered.where("chunk IS NULL").agg(F.sum("words").alias("words"), F.sum("tokens").alias("tokens")).first()
    model = Model(sums["tokens"] or 0, sums["words"] or 0, order, cleared)
    answers = answered.where("chunk IS NOT NULL").select("chunk", "bucket", "totals")

    tuning = chunks.where(F.col("kind") == _TUNING)
    own_answers = answers.join(tuning.select("chunk"), "chunk", "left_semi")
    for k in range(1, order):
        cells = (
            tuning.groupBy("chunk")
            .cogroup(own_answers.groupBy("chunk"))
            .applyInArrow(_tuning_counts(model, k), "level long, high_bin long, low_bin long, n long")
            .groupBy("level", "high_bin", "low_bin")
            .agg(F.sum("n").alias("n"))
            .orderBy("level", "high_bin", "low_bin")
            .toArrow()  # bins only, whatever the number of texts
        )
        columns = [cells.column(c).to_numpy() for c in ("level", "high_bin", "low_bin", "n")]
        if k == 1:
            model = model._replace(weights=learn_weights(*columns, model.n_words))
        else:
            model = model._replace(longer=(*model.longer, learn_share(*columns)))
    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_scores(model), _SCORES)
    n_tokens = model.n_tokens
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS, F.lit(0)) == TEST
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
