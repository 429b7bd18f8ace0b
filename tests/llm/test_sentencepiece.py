import random
import tracemalloc

import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

from vigilog.llm.sentencepiece_viterbi import decode_pieces, encode_pieces, model_path, pieces_of, read_model, with_pieces

from .conftest import odd_rows, prose


def decoded(pieces, ids):
    return pieces.decode(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


def texts():
    rng = random.Random(1)
    odd = ["", "a", " ", "  ", "   x", "x   ", "\n\n a\n  b", "①②  ③", "日本語 テスト", "foo\tbar", "  " * 25 + "x", " " * 40, "😀😀 x", "a" * 100, "ﬁ", " \n \n"]
    odd += ["".join(rng.choice("abcdeéü ①\n.,日本thein ▁") for _ in range(rng.randrange(60))) for _ in range(2000)]
    return odd + [r[1] for r in odd_rows() if r[1]] + [prose(k, 300) for k in range(20)]


def test_ids_are_those_of_the_library():
    pieces, library = pieces_of(read_model()), sentencepiece.SentencePieceProcessor(model_file=model_path())
    for text, ids in zip(texts(), pieces.encode(texts())):
        assert ids.tolist() == library.encode(text), text
        assert decoded(pieces, ids.tolist()) == text.replace("▁", " ") == library.decode(ids.tolist()) or "\n" in text or text != text.strip()
        assert decoded(pieces, ids.tolist()) == text.replace("▁", " ")


def test_decoding_lists():
    pieces = pieces_of(read_model())
    lists = pa.array([[0], [13, 13], None, [], [15043, 2787], [5, 205]], pa.list_(pa.int32()))
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    wanted = [None if x is None else "".join(library.id_to_piece(i) for i in x) for x in lists.to_pylist()]
    assert wanted[4].startswith("▁") and wanted[3] == ""
    got = pieces.decode(lists).to_pylist()
    assert got[2:5] == [None, "", wanted[4].replace("▁", " ").removeprefix(" ")]
    assert pieces.decode(lists.slice(4)).to_pylist() == got[4:] and pieces.decode(lists.slice(0, 0)).to_pylist() == []


def test_memory_for_words_is_bounded():
    pieces = type(pieces_of(read_model()))(read_model())
    pieces.most_words = 50
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    many = [prose(k, 30) for k in range(30)]
    assert [x.tolist() for x in pieces.encode(many)] == library.encode(many)
    assert len(pieces.words) < 400


def test_columns(odd, empty):
    model = read_model()
    rows = odd.withColumn("ids", encode_pieces(F.col("text"), model)).withColumn("back", decode_pieces(F.col("ids"), model)).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    for r in rows:
        assert r.ids == (None if r.text is None else library.encode(r.text))
        assert r.back == (r.text and r.text.replace("▁", " "))
    done = with_pieces(odd.withColumn("ids", F.lit(1)), model)
    assert done.columns == [*odd.columns, "ids", "token_ids"] and done.count() == odd.count()
    assert with_pieces(empty, model).count() == 0


def test_long_words():
    rng = random.Random(3)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(100_000))
    unspaced = "".join(rng.choice("日本語のテストあいうえお漢字😀①é") for _ in range(100_000))
    long = [letters, unspaced, "\n" + letters[:50_000] + "x", "a" * 100_000, "  " + letters[:50_000] + "y z"]
    pieces, library = type(pieces_of(read_model()))(read_model()), sentencepiece.SentencePieceProcessor(model_file=model_path())
    tracemalloc.start()
    found = pieces.encode(long)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for text, ids in zip(long, found):
        assert ids.tolist() == library.encode(text)
        assert decoded(pieces, ids.tolist()) == text
    assert most < 200_000_000


def test_memory_for_long_words_is_bounded():
    pieces, library = type(pieces_of(read_model()))(read_model()), sentencepiece.SentencePieceProcessor(model_file=model_path())
    pieces.most_letters = 5_000
    rng = random.Random(4)
    many = ["".join(rng.choice("abcdeéü日本") for _ in range(rng.randrange(1, 900))) for _ in range(60)]
    assert [x.tolist() for x in pieces.encode(many)] == library.encode(many)
    assert sum(map(len, pieces.words)) < 10_000
