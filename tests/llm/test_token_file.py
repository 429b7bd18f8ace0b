import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vigilog.llm import token_file
from vigilog.llm.token_file import STRIDE, Codes, Words, code_lengths, read_token_file, tokenizer_json, write_token_file

from .conftest import odd_rows, prose

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def encoded(words, texts):
    ids, ends = words.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, ends[:-1])]


def test_ids_are_those_of_the_library():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcDEé'sre .,!?\t\x0b\x0c\n\x1c\x85\xa0́<|>ΣÀ12日①😀") for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["x <|endoftext|> y", "<|EndOfText|>a", "a<|startoftext|>b", "don't I'LL we've", "", " ", None, "a's, b.' 's."]
    words = Words(tokenizer_json())
    assert words.by_word
    texts += ["".join(rng.choice("aàâçéèêëîïôùûüÿœæßäöñáíóúłźčžåøÉÇĿǆǅªºĳŉſ") for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    texts += [chr(c) * 2 + "b" for c in range(1, 0x300)]
    assert words.letters
    for text, found in zip(texts, encoded(words, texts), strict=True):
        assert found == ids_of(text), text
    assert encoded(words, texts[5:9]) == [ids_of(t) for t in texts[5:9]]
    sliced = words.encode(pa.array(texts, pa.string()).slice(100, 50))
    assert [x.tolist() for x in np.split(sliced[0], sliced[1][:-1])] == [ids_of(t) for t in texts[100:150]]


def test_a_tokenizer_that_keeps_white_space_gets_whole_texts():
    source = tokenizer_json(public_tokenizers.path("byte_bpe_50k.json"))
    words, library = Words(source), Tokenizer.from_str(source)
    assert not words.by_word
    text = " two  words\n"
    assert encoded(words, [text])[0] == [*library.encode(text, add_special_tokens=False).ids, 1]


def cost_without_limit(counts):
    import heapq

    heap, total = [(c, k) for k, c in enumerate(counts)], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], a[1]))
    return total


@settings(deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=2, max_size=80))
def test_lengths_are_optimal(counts):
    counts = np.array(counts)
    free = code_lengths(counts, 40)
    assert (2.0 ** -free).sum() == 1 and (free * counts).sum() == cost_without_limit(counts.tolist())
    tight = code_lengths(counts, 7)
    assert tight.max() <= 7 and (2.0 ** -tight).sum() <= 1 and (tight * counts).sum() >= (free * counts).sum()


def test_too_many_ids_for_the_limit():
    with pytest.raises(ValueError):
        code_lengths(np.ones(9, np.int64), 3)


@pytest.mark.parametrize("n", [0, 1, 2, STRIDE - 1, STRIDE, STRIDE + 1, 10 * STRIDE, 5000])
def test_bits_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.pareto(0.7, n) * 3).astype(np.int64) % 60_000
    known, count = np.unique(np.append(ids, 5), return_counts=True)
    codes = Codes(known, code_lengths(count, 16))
    data, checkpoints = codes.pack(ids)
    assert codes.unpack(data, checkpoints, n).tolist() == ids.tolist() and len(checkpoints) == -(-n // STRIDE)


def test_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_file, "PART", 3_000)
    rows = [r[:2] for r in odd_rows()] + [(1000 - i, prose(i, i)) for i in range(200)]
    path = str(tmp_path / "file")
    write_token_file(spark.createDataFrame(rows, "doc_id long, text string"), path, tokenizer_json())
    found = read_token_file(spark, path).collect()
    assert len(found) == len(rows)
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    in_order = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert in_order == [None] * 2 + sorted(i for i in in_order if i is not None)
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((str(r.doc_id), r.n_tokens, zlib.crc32(r.ids)) for r in found) == sorted(
        (str(i), len(ids_of(t)), crc(ids_of(t))) for i, t in rows
    )


def test_empty_table(spark, empty, tmp_path):
    write_token_file(empty, str(tmp_path / "none"), tokenizer_json())
    assert read_token_file(spark, str(tmp_path / "none")).count() == 0
