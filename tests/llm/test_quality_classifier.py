import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from vigilog.llm import quality_classifier as qc

PATH = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{PATH}/{t}.parquet") for t in ("documents", "labels"))
    model = qc.learn(docs, labels)
    scored = docs.join(labels, "doc_id").where(qc.held_out(F.col("doc_id"))).select("quality", qc.quality_score(F.col("text"), model).alias("score"))
    rows = [tuple(r) for r in scored.collect()]
    good, bad = ([s for q, s in rows if q == label] for label in (1, 0))
    assert len(good) > 300 and len(bad) > 50
    assert np.mean([s >= qc.CUT for s in good]) > 0.99
    assert np.mean([s >= qc.CUT for s in bad]) < 0.02
    assert np.mean([[g > b for b in bad] for g in good]) > 0.99


def test_newton_finds_the_least_loss():
    """Against plain gradient descent over the same pairs."""
    rng = np.random.default_rng(5)
    winners, losers = rng.normal(0.5, 1, (60, 3)), rng.normal(0, 1, (40, 3))
    a, b = qc.preference_pairs(60, 40)
    assert set(a) == set(range(60)) and set(b) == set(range(40))
    diff = winners[a] - losers[b]
    w = np.zeros(3)
    for _ in range(4000):
        w -= 0.5 * (1e-3 * w - diff.T @ (1 / (1 + np.exp(diff @ w))) / len(diff))
    assert np.allclose(qc.bradley_terry(winners, losers), w, atol=1e-4)


def test_threshold_against_all_cuts():
    rng = np.random.default_rng(6)
    for _ in range(200):
        n = rng.integers(2, 15)
        values, good, weight = rng.integers(0, 6, n).astype(float), rng.random(n) < 0.5, rng.random(n) + 0.1
        wrong = lambda t: weight[(values >= t) != good].sum()
        least = min(wrong(t) for t in [*values, values.max() + 1])
        assert wrong(qc.best_quantile(values, good, weight)) == pytest.approx(least)


def test_scores_cross_the_cut_at_the_threshold():
    model = qc.Model(np.zeros(1), np.ones(1), 2.0, 3.0)
    scores = model.scores(np.array([[-1e9], [1.9999], [2.0], [2.0001], [1e9]]))
    assert (scores >= qc.CUT).tolist() == [False, False, True, True, True]
    assert 0 <= scores.min() and scores.max() <= 1 and np.all(np.diff(scores) >= 0)


def test_features_of_odd_texts():
    for text in (None, "", " \n", "a", "日本語 😀", "\x00\x01", "-", "x" * 100_000, "\n\n", prose(3, 20_000)):
        f = qc.features(text)
        assert f.shape == (len(qc.FEATURES),) and np.isfinite(f).all() and np.abs(f).max() <= 4
    assert qc.features(None).tolist() == qc.features(" \n").tolist()


def test_odd_rows_and_labels(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1, 0), (9, 0, 0), (13, 0, 1), (6, 1, 0), (None, 1, 1), (99, 0, 0), (7, None, 0), (8, 7, 0), (10, 0, 0), (10, 1, 0)], "doc_id long, quality int, f int")
    model = qc.learn(odd, labels)
    taught = [i for i in (4, 9, 13, 6, 10) if zlib.crc32(str(i).encode()) % 5]
    assert taught and model is not None
    scored = odd.withColumn("score", qc.quality_score(F.col("text"), model)).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    by_text = {}
    for r in scored:
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
    assert [tuple(r) for r in qc.keep_preferred(odd, model).select("doc_id").collect()] == [(r["doc_id"],) for r in scored if r["score"] >= qc.CUT]
    assert qc.learn(odd, labels.where("quality = 1")) is None
    assert qc.learn(empty, labels) is None
    assert {r[0] for r in odd.select(qc.quality_score(F.col("text"), None)).collect()} == {0.5}
    assert empty.select(qc.quality_score(F.col("text"), model)).collect() == []


def test_bound_of_the_sample(spark):
    """The first rows by hash of the id, of either label; the same model in any order of rows."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    whole, same = qc.learn(docs, labels), qc.learn(docs.orderBy(F.desc("doc_id")).repartition(3), labels)
    assert np.array_equal(whole.weights, same.weights) and whole.threshold == same.threshold
    few = qc.learn(docs, labels, sample=30)
    assert not np.array_equal(whole.weights, few.weights)
