"""Token ids in compressed files: canonical length-limited Huffman codes, blocks that decode on their own.

``write_token_file`` tokenises every text once, counts ids over all of them, computes the
codes from the counts, and writes blocks of whole documents in ascending id order. A block
holds its documents' ids and lengths, the code bits, and the bit offset of every
``STRIDE``-th token; the code lengths, which fix the canonical codes, are written beside.
Files go through Spark's writer, so a lost executor's work is done again and committed once.

``read_token_file`` decodes blocks apart from each other. Within a block the stretches
between checkpoints are decoded side by side, each step one table lookup for all of them.

Defined cases: a null or empty text has the end id alone; repeated ids and rows are each
kept, those of one id in the order of their content; rows without an id come first; an
empty table gives files without blocks; only the two named columns are read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilog.llm.common import light, ship
from vigilog.llm.words import pieces
from vigilog.session import materialize

END = 1
LONGEST = 16  # bits of a code, more if the ids need it
BLOCK = 1 << 18  # tokens in a block, about
STRIDE = 256
PART = 4_000_000  # tokens in a part of the files, about
SLICE = 32_000_000  # bytes of text tokenised together, about
_MARKS = b".,;:!?"
_LATIN = "\u024f"  # last of the letters whose class, case and normal form are the same in all versions of Unicode


def _byte_level() -> dict[int, int]:
    """The public byte-level table: printable bytes stand for themselves, the others for code points from 256 on."""
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (32, 160, 173)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


_BYTE_LEVEL = _byte_level()


def _plain_letters(word: bytes) -> bool:
    """Whether the word is lower-case Latin letters, accents included, and nothing else."""
    text = word.decode()
    return text.isalpha() and max(text) <= _LATIN and text == text.lower()


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer's file, read on the driver and sent with the tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


class Words(dict):
    """Ids of the words met so far. White space only separates, so a text's ids are those of its words.

    Forgets all when it holds ``most`` words, so its memory is bounded.
    """

    most = 900_000

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(source)
        # special tokens are met in their own case only; all else is the same in lower case
        self.special = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = True
        self.letters = self._maps()
        self.by_word = self._splits()

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _splits(self) -> bool:
        """Whether this tokenizer treats white space, marks and plain words as assumed here; if not, texts are encoded whole."""
        probe = "the  quick\tbrown\nfox, it's 12.5 done... (jumps)\r\nover!"
        same = b"".join(map(self.__getitem__, probe.encode().split())) == self._whole(probe) == self._whole(probe.upper())
        self.clear()
        return same

    def _maps(self) -> bool:
        """Whether this tokenizer's model takes letters beyond ASCII as their bytes, by the public byte-level table."""
        probe = "élève größe niño œuvre łódź čaj"
        same = all(self[w] == self._whole(w.decode()) for w in probe.encode().split())
        self.clear()
        return same

    def _model(self, pieces: str) -> bytes:
        return array("I", [t.id for t in self.tokenizer.model.tokenize(pieces)]).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        core = word.rstrip(_MARKS)
        if word.isalpha() and word.islower():
            ids = self._model(word.decode())
        elif self.letters and _plain_letters(word):
            ids = self._model(word.decode("latin-1").translate(_BYTE_LEVEL))
        elif core and len(core) < len(word) and core[-1:].isalnum():  # a letter or digit before the marks ends a token
            ids = self[core] + self[word[len(core) :]]
        else:
            ids = self._whole(word.decode())
        self[word] = ids
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts as one array, the end id behind each text, and where each text's ids end.

        The words of all texts are told apart first, so that each is looked up once.
        """
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            ids = [self._whole(t) for t in texts.to_pylist()]
            joined, ends = b"".join(ids), np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
        else:
            low = pc.ascii_lower(texts)
            for special in self.special:
                low = pc.if_else(pc.match_substring(low, special.decode()), texts, low)
            lists = pc.ascii_split_whitespace(low)
            words = lists.flatten().cast(pa.binary()).dictionary_encode()
            found = pa.array([self[w] for w in words.dictionary.to_pylist()], pa.large_binary()).take(words.indices)
            at = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1)
            joined, ends = found.buffers()[2].to_pybytes()[: int(at[-1])] if len(found) else b"", at[np.asarray(lists.offsets)[1:]] // 4
        ids = np.insert(np.frombuffer(joined, np.uint32), ends, END)
        return ids, ends + np.arange(1, len(ends) + 1)


@lru_cache(1)
def _words(source: str) -> Words:
    return Words(source)


def _tokenise(source: str):
    """A row per text with its ids, compressed, and rows with the counts of a task's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words, pack, counts = _words(source), zstandard.ZstdCompressor(level=1), np.zeros(0, np.int64)
        for batch in batches:
            for part in pieces(batch, 1, SLICE):
                ids, ends = words.encode(part.column(1))
                some = np.bincount(ids)
                size = max(len(some), len(counts))
                counts = np.pad(counts, (0, size - len(counts))) + np.pad(some, (0, size - len(some)))
                none = pa.nulls(len(ends), pa.int64())
                starts = np.append(0, ends[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(ends - starts),
                        pa.array([pack.compress(_narrow(ids[a:b])) for a, b in zip(starts.tolist(), ends.tolist())], pa.binary()),
                        none,
                        none,
                    ],
                    names=["doc_id", "n", "data", "token", "seen"],
                )
        token = np.flatnonzero(counts)
        none = pa.nulls(len(token))
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()), pa.array(token), pa.array(counts[token])],
            names=["doc_id", "n", "data", "token", "seen"],
        )

    return run


def _narrow(ids: np.ndarray) -> bytes:
    """32-bit ids as two planes of 16 bits; the upper one is mostly zero and packs away."""
    return ids.view(np.uint16).reshape(-1, 2).T.tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(np.frombuffer(data, np.uint16).reshape(2, -1).T.tobytes(), np.uint32)


def code_lengths(counts: np.ndarray, longest: int) -> np.ndarray:
    """Lengths of an optimal code of at most ``longest`` bits for counts above zero, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << longest:
        raise ValueError(f"{n} ids need codes of more than {longest} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    levels, row = [], leaves
    is_leaf = np.ones(n, bool)
    for _ in range(longest - 1):
        levels.append(is_leaf)
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate((leaves, pairs))
        merged = np.argsort(both, kind="stable")
        row, is_leaf = both[merged], merged < n
    levels.append(is_leaf)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (take - chosen)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Codes:
    """Canonical codes of ids with given lengths: in order of length, then id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order], lengths[order]
        self.bits = int(self.lengths[-1]) if len(ids) else 1
        width = np.int64(1) << (self.bits - self.lengths)
        first = np.cumsum(width) - width  # left-aligned codes
        self.codes = first >> (self.bits - self.lengths)
        size = int(self.ids.max()) + 1 if len(ids) else 0
        self.code_of, self.length_of = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code_of[self.ids], self.length_of[self.ids] = self.codes, self.lengths
        # the id and the length for every value of the next ``bits`` bits
        self.table_id, self.table_length = np.zeros(1 << self.bits, np.uint32), np.ones(1 << self.bits, np.int64)
        self.table_id[: int(width.sum())] = np.repeat(self.ids, width)
        self.table_length[: int(width.sum())] = np.repeat(self.lengths, width)

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of ``ids``, and the bit offset of every STRIDE-th."""
        length = self.length_of[ids]
        end = np.cumsum(length)
        start = end - length
        words = np.zeros((int(end[-1]) >> 5) + 3 if len(ids) else 2, np.uint64)
        if len(ids):
            value = self.code_of[ids] << (64 - (start & 31) - length).astype(np.uint64)
            at = start >> 5
            edge = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
            words[at[edge]] += np.add.reduceat(value >> np.uint64(32), edge)
            words[at[edge] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), edge)
        return words.astype(">u4").tobytes(), start[::STRIDE]

    def unpack(self, data: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        if not n:
            return np.empty(0, np.uint32)
        words = np.frombuffer(data, ">u4").astype(np.uint64)
        pair = words[:-1] << np.uint64(32) | words[1:]
        at = checkpoints.astype(np.int64).copy()
        out = np.empty((STRIDE, len(at)), np.uint32)
        mask, top = np.uint64((1 << self.bits) - 1), 64 - self.bits
        for step in range(min(STRIDE, n)):
            if step == n - (len(at) - 1) * STRIDE:  # the last stretch is over
                at = at[:-1]
            value = (pair[at >> 5] >> (top - (at & 31)).astype(np.uint64)) & mask
            out[step, : len(at)] = self.table_id[value]
            at = at + self.table_length[value]
        return out.T.ravel()[:n]


_BLOCKS = pa.schema(
    [
        ("part", pa.int32()),
        ("at", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("checkpoints", pa.list_(pa.int64())),
        ("bits", pa.binary()),
    ]
)
_BLOCKS_SQL = "part int, at long, doc_ids array<long>, sizes array<long>, checkpoints array<long>, bits binary"


def _write_blocks(ids: np.ndarray, lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, unpack = Codes(ids, lengths), zstandard.ZstdDecompressor()
        part, at = TaskContext.get().partitionId(), 0
        names, parts, size = [], [], 0

        def block() -> pa.RecordBatch:
            bits, checkpoints = codes.pack(np.concatenate(parts))
            row = {"part": part, "at": at, "doc_ids": names, "sizes": [len(p) for p in parts], "checkpoints": checkpoints.tolist(), "bits": bits}
            return pa.RecordBatch.from_pylist([row], _BLOCKS)

        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names.append(doc_id)
                parts.append(_wide(unpack.decompress(data)))
                size += len(parts[-1])
                if size >= BLOCK:
                    yield block()
                    at, names, parts, size = at + size, [], [], 0
        if names:
            yield block()

    return run


def _read_blocks(ids: np.ndarray, lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(ids, lengths)
        for batch in batches:
            for row in range(batch.num_rows):
                start, names, sizes, checkpoints, bits = (batch.column(c)[row].as_py() for c in range(5))
                sizes = np.array(sizes, np.int64)
                tokens = codes.unpack(bits, np.array(checkpoints, np.int64), int(sizes.sum())).astype("<u4")
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()),
                        pa.array(start + ends - sizes),
                        pa.array(sizes),
                        pa.array([tokens[e - s : e].tobytes() for s, e in zip(sizes.tolist(), ends.tolist())], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return run


def write_token_file(docs: DataFrame, path: str, source: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the token ids of every text below ``path``: ``codes`` and ``blocks``."""
    ship(docs.sparkSession)
    columns = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    coded = materialize(columns.mapInArrow(_tokenise(source), "doc_id long, n long, data binary, token long, seen long"), "tokens")
    counts = coded.where("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen")).orderBy("token").toArrow()  # one row per id
    ids, seen = counts.column("token").to_numpy(), counts.column("seen").to_numpy()
    lengths = code_lengths(seen, max(LONGEST, int(len(ids)).bit_length()))
    table = pa.table({"token": ids.astype(np.int64), "length": lengths.astype(np.int32)})
    docs.sparkSession.createDataFrame(table).coalesce(1).write.parquet(f"{path}/codes")
    rows = coded.where("data IS NOT NULL").select("doc_id", "data")
    order = ["doc_id", F.xxhash64("data")]  # the second deals out rows that share an id
    dealt = rows.repartitionByRange(max(1, int(seen.sum()) // PART), *order).sortWithinPartitions(*order)
    dealt.mapInArrow(_write_blocks(ids, lengths), _BLOCKS_SQL).write.parquet(f"{path}/blocks", compression="uncompressed")


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``start`` counts the ids before, ``ids`` are little-endian 32-bit numbers."""
    ship(spark)
    codes = spark.read.parquet(f"{path}/codes").toArrow()
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row per part
    starts = materialize(parts.select("part", F.coalesce(before, F.lit(0)).alias("before")), "parts")
    placed = blocks.join(light(starts), "part").select((F.col("before") + F.col("at")).alias("start"), "doc_ids", "sizes", "checkpoints", "bits")
    read = _read_blocks(codes.column("token").to_numpy(), codes.column("length").to_numpy().astype(np.int64))
    return placed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
