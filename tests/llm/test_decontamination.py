from collections import Counter

from pyspark.sql import functions as F

from vigilog.llm import common, decontamination
from vigilog.llm.decontamination import judged, keep_clean, with_leaks
from vigilog.session import materialize

from .conftest import odd_rows, prose


def runs(words, size):
    return [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]


def brute(text, items):
    """Ids of the items that some window as long as the item reaches 0.8 with."""
    words, found = (text or "").lower().split(), set()
    for item, passage in items:
        own = (passage or "").lower().split()
        if not own or not words:
            continue
        size = min(5, len(own))
        a = Counter(runs(own, size))
        for s in range(max(0, len(words) - len(own)) + 1):
            b = Counter(runs(words[s : s + len(own)], size))
            if b and 100 * sum((a & b).values()) >= 80 * sum((a | b).values()):
                found.add(item)
    return sorted(found)


def test_against_all_windows(spark):
    items = [(i, prose(500 + i, 15 + 3 * i)) for i in range(12)] + [(50, None), (51, ""), (52, "lone words here"), (None, "x"), (53, "a b a b a b a b a b a b")]
    cut = items[8][1].split()
    texts = [t[:2] for t in odd_rows() if t[0] not in (7, 8)]
    texts += [(100 + i, prose(i, 50) + "\n" + items[i % 12][1].upper() + " " + prose(i + 60, 30)) for i in range(12)]
    texts += [
        (200, " ".join(cut[1:])),  # shorter than the item
        (201, " ".join(cut[: len(cut) // 2])),  # half of it: clean
        (202, prose(3, 20) + " " + " ".join(cut[:-1]) + " other " + prose(4, 20)),
        (203, "and lone words here too"),
        (204, " ".join([*cut[:20], "inserted", *cut[20:]])),
        (205, "a b " * 30),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("similarity", F.lit("mine")).withColumn("key", F.lit(1))
    rows = with_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(rows) == len(texts)
    known = [(i, t) for i, t in items if i is not None]
    for r in rows:
        assert r.leaked_items == brute(r.text, known), r.text
        assert (r.similarity >= 0.8) == bool(r.leaked_items)
    assert sum(bool(r.leaked_items) for r in rows) >= 14


def test_clean_rows_stay_whole(spark, odd, empty):
    items = spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string")
    kept = keep_clean(odd, items)
    assert kept.columns == odd.columns
    leaked = {4, 5, 6}
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in odd.collect() if r.doc_id not in leaked)
    assert keep_clean(empty, items).count() == 0
    assert keep_clean(odd, items.where("false")).count() == odd.count()


def test_runs_without_python(spark, odd):
    table = spark.range(5).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    items = table.selectExpr("doc_id AS item_id", "text")
    plan = with_leaks(table, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_items_without_an_id_of_their_own(spark):
    items = [(7, prose(500 + i, 40)) for i in range(6)] + [(None, prose(520 + i, 40)) for i in range(6)] + [(i, prose(540, 40)) for i in (8, 9)]
    items += [(7, "two short words"), (None, "lone")]
    texts = [(i, prose(i, 50) + " " + items[i][1] + " " + prose(i + 60, 30)) for i in range(len(items))] + [(90, prose(90, 80))]
    schema = "doc_id long, text string"
    docs, table = spark.createDataFrame(texts, schema), spark.createDataFrame(items, "item_id long, text string")
    rows = judged(docs, table).collect()
    assert len(rows) == len(texts)
    for r in rows:
        found = brute(r.text, list(enumerate(items_text for _, items_text in items)))  # each item by its place
        assert r.leaked == bool(found) == (r.similarity >= 0.8), r.doc_id
        assert r.leaked_items == sorted({items[k][0] for k in found} - {None}), r.doc_id
    assert [r.doc_id for r in keep_clean(docs, table).collect()] == [90]


def test_items_of_one_length_do_not_meet(spark, monkeypatch):
    """A thousand items as long as each other: a window is compared with the items that it shares a rare shingle with."""
    items = [(i, prose(5000 + i, 24)) for i in range(1000)]
    docs = [(i, prose(i, 40) + " " + items[7 * i][1] + " " + prose(900 + i, 20)) for i in range(60)] + [(100 + i, prose(i, 200)) for i in range(20)]
    sizes = {}

    def counted(df, name):
        found = materialize(df, name)
        sizes[name] = found.count()
        return found

    monkeypatch.setattr(decontamination, "materialize", counted)
    schema = "doc_id long, text string"
    rows = judged(spark.createDataFrame(docs, schema), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: r.leaked_items for r in rows} == {i: [7 * i] if i < 60 else [] for i, _ in docs}
    assert sizes["carried"] < 5 * 60 * 24  # of 60 x 24 x 1000 pairs that a lookup by length gives


def test_a_passage_of_many_items(spark):
    """Items that share most of their words, permuted and repeated ones: the rarest shingles still find every leak."""
    shared = prose(700, 30)
    items = [(i, shared + " " + prose(710 + i, 6 + i)) for i in range(6)] + [(20, "x y z " * 12), (21, " ".join(shared.split()[15:] + shared.split()[:15]))]
    texts = [(i, prose(i, 30) + " " + t + " " + prose(i + 40, 30)) for i, (_, t) in enumerate(items)]
    texts += [(50, shared), (51, "x y z " * 30), (52, " ".join(shared.split()[::-1])), (53, (shared + " ") * 3)]
    docs, table = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for r in with_leaks(docs, table).collect():
        assert r.leaked_items == brute(r.text, items), r.doc_id


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(common, "LIGHT_ROWS", -1)
    items = [(i, prose(500 + i, 15 + i)) for i in range(6)]
    texts = [(i, prose(i, 50) + " " + items[i][1]) for i in range(6)] + [(9, prose(9, 60))]
    found = with_leaks(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: r.leaked_items for r in found.collect()} == {i: [i] if i < 6 else [] for i, _ in texts}


def test_growing_tables_are_not_broadcast_by_their_files(spark, monkeypatch):
    """Small files are no leave to broadcast: rows that repeat their values are a hundred times as large in the driver's memory."""
    monkeypatch.setattr(common, "LIGHT_ROWS", -1)
    items = [(i, prose(500 + i, 15 + i)) for i in range(6)] + [(7, "two words")]
    texts = [(i, prose(i, 50) + " " + items[i][1]) for i in range(7)] + [(9, prose(9, 60))]
    plans = {}

    def planned(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return materialize(df, name)

    monkeypatch.setattr(decontamination, "materialize", planned)
    found = judged(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    plans["result"] = found._jdf.queryExecution().executedPlan().toString()
    joined = ("rarest", "hits", "carried", "windows", "leaks", "result")
    assert all("SortMergeJoin" in plans[k] for k in joined)
    assert not [k for k in joined if "Broadcast" in plans[k]]
    assert {r.doc_id: r.leaked_items for r in found.collect()} == {i: [items[i][0]] if i < 7 else [] for i, _ in texts}


def test_a_few_texts_with_many_ids_are_not_broadcast(spark, monkeypatch):
    """Of lists of ids the elements count: an item may have any number of ids."""
    monkeypatch.setattr(common, "LIGHT_ROWS", 50)
    passage = prose(500, 30)
    items = [(i, passage) for i in range(60)]
    texts = [(1, prose(1, 20) + " " + passage), (2, prose(2, 60))]
    found = judged(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.leaked_items for r in found.collect()} == {1: list(range(60)), 2: []}
