import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from vigilog.llm import common, jaccard_join
from vigilog.llm.components import components
from vigilog.llm.jaccard_join import jaccard_components, keep_one_of_each, prefix_size
from vigilog.llm.membership import Membership
from vigilog.llm.words import WordHashes, shingle_set, split_words, word_hashes

from .conftest import odd_rows, prose


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def linked(rows):
    """The set of each row, and which component it is in, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    return sets, [find(k) for k in range(len(rows))]


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets, component = linked(rows)
    least = {}
    for (i, _), c in zip(rows, component):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted(((i, len(s), i if not s else least.get(c)) for (i, _), s, c in zip(rows, sets, component)), key=str)


def one_of_each(rows):
    """Of each component the ids that may stay, of which one row does, and all rows without words."""
    sets, component = linked(rows)
    groups = {}
    for (i, t), s, c in zip(rows, sets, component):
        if s:
            groups.setdefault(c, []).append((i is None, i, t))
    stays = [sorted({(i, t) for none, i, t in g if (none, i) == min((n, x) for n, x, _ in g)}, key=str) if len({n for n, _, _ in g}) == 1 else
             sorted({(i, t) for _, i, t in g if i == min(x for n, x, _ in g if not n)}, key=str) for g in groups.values()]
    return stays, [r for r, s in zip(rows, sets) if not s]


def edited(text, seed, most):
    rng, words = random.Random(seed), text.split()
    for _ in range(rng.randrange(most)):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_components(df).collect()), key=str) == brute(rows)


def test_odd_texts(spark):
    check(spark, [r[:2] for r in odd_rows()])


def test_near_copies_chains_and_a_passage_that_many_share(spark):
    passage = prose(50, 40)
    rows = [(i, edited(prose(i % 6, 120), i, 9)) for i in range(120)]  # groups whose members are only partly alike
    rows += [(200 + i, prose(100 + i, 60) + " " + passage) for i in range(30)]
    rows += [(300 + i, passage + f" tail{i}") for i in range(30)]
    chain = prose(60, 300).split()
    rows += [(400 + i, " ".join(chain[i * 8 : i * 8 + 200])) for i in range(10)]  # each like the next, not like the last
    check(spark, rows)


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(common, "LIGHT_ROWS", -1)
    check(spark, [(i, edited(prose(i % 5, 90), i, 7)) for i in range(40)])


def test_empty_table(empty):
    assert jaccard_components(empty).count() == 0


def check_kept(kept, rows):
    stays, empty = one_of_each(rows)
    left = [tuple(r) for r in kept]
    assert len(left) == len(stays) + len(empty)
    for choices in stays:
        assert sum(r in choices for r in left) == 1, choices
    for row in set(empty):
        assert left.count(row) == empty.count(row)


def test_one_row_of_each_group_stays(spark):
    """Ids that several texts bear, rows that are there several times, copies without an id."""
    a, b, c, d, e, f = (prose(k, 70) for k in range(6))
    rows = [(1, a), (1, b), (2, c), (5, c), (5, d), (None, e), (None, e + " more"), (8, f), (8, f), (8, f), (9, f)]
    rows += [(None, None), (None, None), (None, ""), (3, " "), (6, a + " x"), (None, d + " y"), (None, "two words"), (None, "two words")]
    kept = keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_kept(kept, rows)
    assert {(1, a), (1, b), (2, c), (5, d), (8, f)} <= set(map(tuple, kept))
    unique = [(i, prose(i, 60)) for i in range(5)] + [(7, prose(3, 60))]
    check_kept(keep_one_of_each(spark.createDataFrame(unique, "doc_id long, text string")).collect(), unique)


def test_one_of_each_with_clashing_columns(odd, empty):
    for name in ("__gone", "id", "text_key", "stays", "other", "root"):
        rows = odd.withColumnRenamed("source", name)
        kept = keep_one_of_each(rows)
        assert kept.columns == rows.columns
    check_kept([r[:2] for r in kept.collect()], [r[:2] for r in odd_rows()])
    assert keep_one_of_each(empty).collect() == []


def test_hot_keys_and_memory_bounds_change_nothing(spark, monkeypatch):
    """Hubs whose key many classes share are joined apart; tasks that remember few sets store some twice; many small chunks."""
    monkeypatch.setattr(common, "WIDE_SHARE", 4)
    monkeypatch.setattr(jaccard_join, "PER_TASK", 3)
    check(spark, [(i, edited(prose(i % 3, 90), i, 5)) for i in range(60)] + [(100 + i, prose(i % 4, 30)) for i in range(20)])
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text_key": i, "text": prose(i % 7, 40 + i % 7)} for i in range(60)])
    for seen, counted in ((3, 100), (10**6, 10**6)):
        monkeypatch.setattr(jaccard_join, "SEEN", seen)
        monkeypatch.setattr(jaccard_join, "STORED", counted)
        monkeypatch.setattr(jaccard_join, "COUNTED", 2 * counted)
        monkeypatch.setattr(jaccard_join.TaskContext, "get", staticmethod(lambda: SimpleNamespace(partitionId=lambda: 5)))
        table = pa.Table.from_batches(jaccard_join._describe(iter([batch, batch])))
        stored = {}
        for part in table.filter(pc.is_valid(table["chunk"])).select(list(jaccard_join._CHUNK)).to_batches():
            for sids, sets in jaccard_join._stored_sets(iter([part])):
                stored.update(zip(sids, sets))
        texts = table.filter(pc.is_valid(table["digest"])).to_pylist()
        assert len(texts) == 120
        for r in texts:
            assert r["n"] == len(stored[r["sid"]]) and jaccard_join._digest(stored[r["sid"]]) == r["digest"]


def test_words_of_many_texts_at_once():
    rng = random.Random(8)
    texts = ["".join(rng.choice("abÀß日 \t\n\x0b\x1c\x85ZQ") for _ in range(rng.randrange(30))) for _ in range(500)] + [None, "", "  "]
    h = WordHashes()
    for array in (pa.array(texts), pa.array(texts).slice(17, 300)):
        found, ends = word_hashes(array)
        split = np.split(found, ends[:-1])
        assert [x.tolist() for x in split] == [h.of(split_words(t)).tolist() for t in array.to_pylist()]


def test_prefix_filter_loses_no_pair():
    for seed in range(30):
        text = prose(seed, 100)
        h = WordHashes()
        a, b = (shingle_set(h.of(split_words(t))) for t in (text, edited(text, seed, 5)))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            for order in (3, 5, 7):
                x, y = (s[np.argsort(s * np.uint64(order))][: prefix_size(len(s), 80)] for s in (a, b))
                assert len(np.intersect1d(x, y))


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 3), (5, 4)], [(i, i + 1) for i in range(50)], [(0, i) for i in range(30)]])
def test_components(spark, edges):
    found = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    root = {}
    for u, v in edges:
        root.setdefault(u, u), root.setdefault(v, v)
    for _ in edges:
        for u, v in edges:
            root[u] = root[v] = min(root[u], root[v])
    assert found == {k: v for k, v in root.items() if any(u != w and k in (u, w) for u, w in edges)}


def test_membership_never_denies(spark):
    numbers = np.array([-5, 0, 3, 2**40, -(2**60)])
    df = spark.createDataFrame([(int(x),) for x in numbers], "x long")
    small = Membership.of(df, df["x"], 1 << 10)
    assert small.may_hold(numbers).all() and not small.may_hold(np.array([7, 8, 9])).any()
