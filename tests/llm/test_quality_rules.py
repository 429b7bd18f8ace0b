import re
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigilog.llm.quality_rules import Rule, keep_good, measure, quality_rules
from vigilog.llm.queries import QUERIES

from .conftest import SCHEMA, odd_rows, prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    count = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if count[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_counts_of_odd_texts(odd):
    rows = quality_rules(odd).select("text", *COUNTS, "base_failed", "kept").collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        expected = brute(r.text)
        assert tuple(r[c] for c in COUNTS) == expected, r.text
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (r.base_failed and r.kept)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0b #é", max_size=60), min_size=20, max_size=60))
def test_counts_of_random_texts(spark, texts):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    for r in quality_rules(df).select("text", *COUNTS).collect():
        assert tuple(r[c] for c in COUNTS) == brute(r.text)


def test_verdicts(spark):
    good = prose(3, 100)
    texts = [good, good.upper(), " ".join(w + "###" for w in good.split()), "\n".join([good[:40]] * 20 + [good]), " ".join(map(str, range(1000, 1100)))]
    rows = quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.kept for r in rows] == [True, False, False, False, False]
    assert "upper_ratio" in rows[1].failed_rules and "symbol_ratio" in rows[2].failed_rules and "digit_ratio" in rows[4].failed_rules


def test_own_table_of_rules(spark):
    df = spark.createDataFrame([(1, prose(3, 100))], "doc_id long, text string")
    assert quality_rules(df, (Rule("n_words", 101, None),)).first().failed_rules == ["n_words"]
    assert quality_rules(df, (Rule("n_words", None, 100),)).first().kept
    assert quality_rules(df, ()).first().kept


def test_keeps_columns_that_clash(spark, empty):
    df = spark.createDataFrame([(1, prose(3, 100), "x", "y"), (2, "short", "x", "y")], "doc_id long, text string, kept string, n_words string")
    assert [tuple(r) for r in keep_good(df).collect()] == [(1, prose(3, 100), "x", "y")]
    assert keep_good(empty).columns == empty.columns and keep_good(empty).count() == 0


def test_runs_without_python(odd):
    plan = quality_rules(odd.withColumn("text", F.upper("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_no_text_is_too_long(spark):
    letters = "bcdfghjklm"
    long = " ".join("the" if i % 5 == 0 else "".join(letters[int(d)] for d in str(i)) for i in range(1_000_100))
    docs = spark.createDataFrame([(1, long), (2, "short")], "doc_id long, text string")
    assert [(r.doc_id, len(r.text)) for r in keep_good(docs).collect()] == [(1, len(long))]
    assert [(r.doc_id, r.kept) for r in quality_rules(docs).orderBy("doc_id").collect()] == [(1, True), (2, False)]


def test_other_languages_are_judged_by_the_other_rules(spark):
    """Clean prose in letters without a listed language stays; prose of the listed languages needs its words."""
    polish = "Każdy człowiek może być szczęśliwy, gdy zażywa świeżego powietrza i dużo śpi na łące pełnej kwiatów. "
    russian = "Каждый человек может быть счастлив, если он гуляет на свежем воздухе и хорошо спит по ночам дома. "
    chinese = "每个人都可以幸福只要呼吸新鲜空气并且睡得好。" * 3 + " "
    danish = "Det er godt at gå en tur og sove godt om natten, og det er ikke dyrt for den som har tid til at gå. "
    texts = [" ".join(w if j % 2 else f"{w}{i}" for i in range(6) for j, w in enumerate(s.split())) for s in (polish, russian, danish)]
    texts.insert(2, " ".join(f"{chinese}{i}" for i in range(60)))
    texts += [texts[0].replace("ż", "#"), " ".join(f"palabr{c}d{d}x" for c in "abcdefgh" for d in "abcdefgh")]
    rows = quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.kept for r in rows] == [True, True, True, True, False, False]
    assert rows[1].stop_word_ratio is None and rows[5].failed_rules == ["stop_word_ratio"]


def test_columns_of_any_name_are_kept(spark):
    names = ["__words", "__lines", "__win", "__hash", "__ordered", "x"]
    df = spark.createDataFrame([(1, prose(3, 100), *range(6))], f"doc_id long, text string, {', '.join(n + ' long' for n in names)}")
    for found in (quality_rules(df), measure(df)):
        assert [found.first()[n] for n in names] == list(range(6)) and found.columns[:8] == df.columns


@pytest.mark.parametrize("name, table", [("op1_quality_rules", "documents"), ("op2_url_filters", "pages")])
def test_queries_equal_their_sql(spark, name, table):
    path = "/root/testdata/sf0.001"
    job, sql = QUERIES[name]
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
    wanted = connection.sql(sql)
    found = job(spark, path).select(*wanted.columns).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted.fetchall())) and found
