"""Words and word shingles as 64-bit numbers, for tasks that read whole texts in Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_64_intdigest

SHINGLE = 5

# Odd multipliers of the 64-bit mixing steps.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """The hash of a word, remembered. Forgets all when it holds ``limit`` words, so its memory is bounded."""

    limit = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split_words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ with A-Z lower-cased; none for a null text."""
    return text.encode().lower().split() if text else []


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts (strings), as one array, and where each text's words end.

    The words are told apart first, so that each distinct one is hashed once.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, ends = lists.flatten(), np.asarray(lists.offsets)[1:].astype(np.int64)
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)  # white space at an end leaves an empty word
    known = words.cast(pa.binary()).dictionary_encode()
    hashes = np.fromiter(map(xxh3_64_intdigest, known.dictionary.to_pylist()), np.uint64, len(known.dictionary))
    found = hashes[known.indices.to_numpy()]
    if not filled.all():
        ends = np.append(0, np.cumsum(filled))[ends]
        found = found[filled]
    return found, ends


def give_back() -> None:
    """Return memory that this worker has freed to the system, before it waits for its next task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX_A
    values = (values ^ (values >> np.uint64(27))) * _MIX_B
    return values ^ (values >> np.uint64(31))


def sequence_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    mixed = mix(words)
    total = words[:n].copy()
    for k in range(1, size):
        total *= _STEP
        total += mixed[k : k + n]
    return mix(total + np.uint64(size))


def shingle_set(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingles; a shorter text is one shingle, an empty one has none."""
    return distinct(sequence_hashes(words, min(size, max(1, len(words)))))


def distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    found = np.sort(numbers)
    return found[np.append(True, found[1:] != found[:-1])] if len(found) else found


def pieces(batch: pa.RecordBatch, column: int, most_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` that hold about ``most_bytes`` of text, one row at least."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    part = np.cumsum(sizes) // most_bytes
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
    for low, high in zip(starts, starts[1:]):
        yield batch.slice(low, high - low)
