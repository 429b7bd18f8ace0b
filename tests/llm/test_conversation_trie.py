import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from vigilog.llm import conversation_trie as trie
from vigilog.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends) with whole sequences as keys."""
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            found[c].append(((turn is not None, turn or 0), digest, role, text))
    turns = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in found.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(int)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 9
        sequence = turns.get(c - c % 5, [])[:h] + turns[c][h:]
        for d in range(len(sequence) + 1):
            members[tuple(sequence[:d])].append(c)
        ends[tuple(sequence)].append(c)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (members[x][0], len(x), members[x[:-1]][0] if x else -1, len(members[x]), children[x], leaves[x], saved[x], tuple(ends[x])) for x in members
    )


def result(df, height=trie.HEIGHT):
    nodes, ends = trie.prefix_trie(*trie.rebuilt(*trie.ordered_turns(df)), height)
    listed = ends.groupBy(*trie.KEY).agg(F.sort_array(F.flatten(F.collect_list("ids"))).alias("ids"))
    joined = nodes.join(listed, trie.KEY, "left").join(trie.listed_digests(ends), trie.KEY, "left")
    rows = []
    for r in joined.collect():
        ids = tuple(r["ids"] or ())
        assert r["sha256"] == (hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() if ids else None)
        parent = -1 if r["depth"] == 0 else r["parent_conv_id"]
        rows.append((r["conv"], r["depth"], parent, r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], ids))
    return sorted(rows)


def odd_turns():
    """Nulls everywhere, equal numbers, repeated rows, negative and missing first conversations, copies, one long conversation."""
    rng = random.Random(3)
    rows = [
        (rng.choice([None, *range(40), -7, -5, -10]), rng.choice([None, 0, 1, 1, 2, 3, 9]), rng.choice(["u", "a", None, ""]), rng.choice(["a", "b", "é", None]))
        for _ in range(300)
    ]
    rows += [(c, i // 2, "u", "x" * (i % 3)) for c in (50, 55) for i in range(60 + c)]
    return rows + [(c, i, "u", f"common {i}") for c in range(100, 140) for i in range(12)] + [(2**62, 1, "u", "far")]


@pytest.mark.parametrize("height", [16, 4, 2])
def test_against_brute_force(spark, height, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 8)
    monkeypatch.setattr(trie, "LISTED", 2)
    rows = odd_turns()
    assert result(spark.createDataFrame(rows, SCHEMA), height) == brute(rows)


def test_wide_and_narrow_parents_agree(spark, monkeypatch):
    rows = [(c, 0, "u", f"text {c % 50}") for c in range(0, 600, 5)] + [(c, 1, "a", "same") for c in range(0, 600, 5)]
    wanted = brute(rows)
    for wide in (1, 10, 10**9):
        monkeypatch.setattr(trie, "WIDE", wide)
        assert result(spark.createDataFrame(rows, SCHEMA)) == wanted


def test_clashing_columns_and_empty_table(spark):
    rows = [(1, 0, "u", "a", 1, 2), (1, 1, "u", "b", 3, 4), (2, 0, "u", "a", 5, 6)]
    df = spark.createDataFrame(rows, SCHEMA + ", depth long, conv long")
    assert result(df) == brute([r[:4] for r in rows])
    assert result(spark.createDataFrame([], SCHEMA)) == []
    assert result(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA)) == []


def test_a_conversation_of_thousands_of_turns(spark):
    """Its turns lie in several pieces and several blocks, and its totals go through several rounds."""
    rows = [(0, i, "u", "x") for i in range(9000)] + [(5, i, "u", "x") for i in range(9500)]
    nodes, _ = trie.prefix_trie(*trie.rebuilt(*trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))))
    found = {r["depth"]: r for r in nodes.collect()}
    assert len(found) == 9501
    for depth in (0, 1, 15, 16, 17, 4095, 4096, 8999, 9000, 9001, 9500):
        r = found[depth]
        assert (r["n_convs"], r["n_leaves"], r["conv"]) == (2 if depth <= 9000 else 1, 1, 0 if depth <= 9000 else 5)
        assert r["saved_tokens"] == max(0, 9000 - max(depth, 1) + 1)


def test_query_equals_its_sql(spark):
    path = "/root/testdata/sf0.001"
    job, sql = QUERIES["op13_conversation_trie"]
    df = job(spark, path)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/conversations.parquet'")
    wanted = connection.sql(sql)
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, df.select(*wanted.columns).collect()), key=key) == sorted(wanted.fetchall(), key=key)
