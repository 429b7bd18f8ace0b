"""The pipeline against the same five steps in plain Python."""

import os
import sys
import types

import pytest
import sentencepiece

from vigilog.llm.quality_rules import quality_rules
from vigilog.llm.secret_scans import Scanner
from vigilog.llm.sentencepiece_viterbi import model_path

from .conftest import SCHEMA, odd_rows, prose
from .test_decontamination import brute as leaks
from .test_jaccard_join import edited, one_of_each

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    items = [(i, prose(500 + i, 30)) for i in range(4)]
    rows = odd_rows()
    rows += [(100 + i, edited(prose(i % 20, 150), i, 6), "en", "s", 5) for i in range(60)]
    rows += [(300 + i, prose(30 + i, 80) + " " + items[i % 4][1], "en", "s", 5) for i in range(8)]
    rows += [(400 + i, prose(60 + i, 80) + f' token = "{i:040x}" ' + prose(90 + i, 20), "en", "s", 5) for i in range(8)]
    rows += [(500 + i, " ".join(w + "###" for w in prose(i, 100).split()), "en", "s", 5) for i in range(5)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return types.SimpleNamespace(folder=folder, rows=rows, items=items)


def test_stages_and_result(spark, tables):
    good = {r.doc_id for r in quality_rules(spark.createDataFrame(tables.rows, SCHEMA)).where("kept").collect()}
    left = [r for r in tables.rows if r[0] in good and not (r[0] is None and r[1] is None)]
    stays, empty = one_of_each([r[:2] for r in left])
    assert not empty and all(len(choices) == 1 for choices in stays)
    by_row = {r[:2]: r for r in left}
    kept = [by_row[choices[0]] for choices in stays]
    kept = [r for r in kept if not leaks(r[1], tables.items)]
    scan, library = Scanner(), sentencepiece.SentencePieceProcessor(model_file=model_path())
    expected = []
    for i, text, lang, source, n in kept:
        clean = scan.redact(text)
        expected.append((i, clean, lang, source, n if clean == text else len(clean), library.encode(clean)))
    found = corpus_pipeline.run(spark, tables.folder)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "token_ids"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    ids = {r[0] for r in kept}
    assert len(ids & set(range(400, 408))) == 8 and not ids & set(range(300, 308)) and not ids & set(range(500, 505))


def test_stages_keep_the_columns_of_documents(spark, tables):
    docs = spark.read.parquet(f"{tables.folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tables.folder).columns == docs.columns
