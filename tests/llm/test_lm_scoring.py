import math
import zlib
from collections import Counter

import numpy as np
import pytest

from vigilog.llm import lm_scoring
from vigilog.llm.lm_scoring import learn_share, learn_weights, pack, pack_sorted, score_documents, unpack, unpack_sorted

from .conftest import odd_rows, prose


def fold(i):
    return zlib.crc32(str(i).encode()) % 5 if i is not None else 0


def counts_of(rows, order):
    """Counts of the n-grams of each length in training texts; a text begins with the end of another."""
    counts = [Counter() for _ in range(order)]
    for i, t in rows:
        if fold(i) != 1:
            w = [None, *(t or "").encode().lower().split(), None]
            counts[0].update(w[1:])
            for k in range(1, order):
                counts[k].update(tuple(w[j - k : j + 1]) for j in range(max(1, k), len(w)))
    return counts


def probability(counts, n, v, model, w, j):
    """Of word j of w by all orders, as the definition has it."""
    level = lambda c: 0 if not c else min(int(math.log2(c)) + 1, lm_scoring.LEVELS - 1)
    seen = counts[0][w[j - 1]]
    x = model.weights[level(seen)]
    pair = counts[1][w[j - 1], w[j]] / seen if seen else 0
    p = x[0] * pair + x[1] * counts[0][w[j]] / n + x[2] / (v + 1)
    for k in range(2, len(counts)):
        context = counts[k - 1][tuple(w[j - k : j])] if j >= k else counts[0][None] if j == 1 else counts[j - 1][tuple(w[:j])] if j > 1 else 0
        gram = counts[k][tuple(w[j - k : j + 1])] if j >= k else counts[1][w[0], w[1]]
        share = model.longer[k - 2][level(context)]
        p = share * (gram / context if context else 0) + (1 - share) * p
    return p


def check(spark, rows, model, order):
    counts = counts_of(rows, order)
    n, v = sum(counts[0].values()), len(counts[0])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = score_documents(df, order=order).collect()
    expected = []
    for i, t in rows:
        w = [None, *(t or "").encode().lower().split(), None]
        base = sum(math.log10((counts[0][x] + 0.5) / (n + 0.5 * (v + 1))) for x in w[1:])
        own = sum(math.log10(probability(counts, n, v, model, w, j)) for j in range(1, len(w)))
        expected.append((i, fold(i) == 1, len(w) - 1, sum(counts[0][x] > 0 for x in w[1:]), n, round(base, 6), round(own, 6)))
    got = [(*r[:5], round(r.base_score, 6), round(r.score, 6)) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected))


@pytest.mark.parametrize("order", [2, 3])
def test_scores_against_dictionaries(spark, monkeypatch, order):
    class Kept:
        longer = ()

    learn, share = lm_scoring.learn_weights, lm_scoring.learn_share

    def keep_weights(*a):
        Kept.weights = learn(*a)
        return Kept.weights

    def keep_share(*a):
        Kept.longer = (*Kept.longer, share(*a))
        return Kept.longer[-1]

    monkeypatch.setattr(lm_scoring, "learn_weights", keep_weights)
    monkeypatch.setattr(lm_scoring, "learn_share", keep_share)
    monkeypatch.setattr(lm_scoring, "BUCKET", 2_000)  # several buckets
    rows = [r[:2] for r in odd_rows() if r[0] not in (7, 8)] + [(100 + i, prose(i % 9, 100)) for i in range(60)]
    check(spark, rows, Kept, order)
    assert len(Kept.longer) == order - 2


def test_longer_orders_predict_better(spark):
    """Held-out texts of a language whose words follow from the last two, not from the last one."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):
        w = [int(x) for x in rng.integers(0, 12, 2)]
        while len(w) < 60:
            w.append((5 * w[-2] + 7 * w[-1] + 3) % 12 if rng.random() < 0.9 else int(rng.integers(0, 12)))
        rows.append((i, " ".join(f"w{x}" for x in w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    two, three = (sum(r.score for r in score_documents(df, order=k).collect() if r.held_out) for k in (2, 3))
    assert three > two + 1000
    with pytest.raises(ValueError):
        score_documents(df, order=1)


def test_shares_follow_the_better_estimate():
    level, n = np.array([3, 3, 5]), np.array([90, 10, 100])
    share = learn_share(level, np.array([4, -1, 60]), np.array([60, 60, 20]), n)
    assert 0.8 < share[3] < 0.95 and share[5] < 0.05 and ((share > 0) & (share < 1)).all()


def test_spare_bits():
    assert [lm_scoring._cleared(n) for n in (0, 10**6, 10**8, 10**10, 10**14)] == [40, 24, 16, 8, 1]


def test_empty_table(empty):
    assert score_documents(empty).count() == 0


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 40} v{(i * 7 + k) % 40}" for k in range(50))) for i in range(100)]
    found = [r for r in score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.held_out]
    assert found and all(r.score > r.base_score for r in found)


def test_weights_follow_the_better_estimate():
    level, n = np.array([3, 3, 5]), np.array([90, 10, 100])
    w = learn_weights(level, np.array([4, -1, -1]), np.array([60, 60, 20]), n, 1000)
    assert w[3, 0] > 0.5 and w[5, 1] > 0.9 and (w > 0).all() and np.allclose(w.sum(1), 1)


def test_packing():
    x = np.array([0, 1, 2**64 - 1, 5], np.uint64)
    assert (unpack(pack(x)) == x).all() and (unpack_sorted(pack_sorted(np.sort(x))) == np.sort(x)).all()
    assert len(unpack(pack(x[:0]))) == 0
