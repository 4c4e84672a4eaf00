"""Conversation trie: all prefixes one by one, SQL, chains and crowds, split layouts, odd rows."""

import collections
import hashlib
import zlib

import duckdb
import pandas as pd
import pytest

from stayframe.llm import trie
from stayframe.operators.scale import Sizes

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SHAPE = "conv_id long, turn long, role string, text string"


def plain(convs):
    """Rows for every prefix of ``{conv: [(role, text), ...]}``."""
    members = collections.defaultdict(list)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = collections.Counter(path[:-1] for path in members if path)
    leaves, saved = collections.Counter(), collections.Counter()
    for path, ids in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(ids) - 1) * len(path[-1][1]) if path else 0
    rows = []
    for path, ids in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(convs[c]) == len(path)))
        rows.append((min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), children[path], leaves[path],
                     saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def own_turns(rows):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}


def shared(convs):
    found = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return found


def same(found, wanted):
    assert found.columns == NAMES
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)


def crowd():
    """Chains, branches at every depth, copies, and conversations that end inside edges."""
    rows = []
    for c in range(60):
        rows += [(c, k, "u", f"t{k}") for k in range(c % 23)]  # every length of one chain, in copies
        rows += [(100 + c, k, "u", f"t{k}") for k in range(c % 20)] + [(100 + c, 50, "a", f"own {c % 31}"), (100 + c, 51, "a", "more")]
    rows += [(300 + c, k, "u", f"{k} {(c >> k) & 1}") for c in range(32) for k in range(5)]
    return rows


def test_all_prefixes(spark, monkeypatch):
    rows = crowd()
    df = spark.createDataFrame(rows, SHAPE).repartition(3)
    wanted = plain(own_turns(rows))
    same(trie.conversation_trie(df), wanted)
    # conversations, edges and the rows of one node in many chunks
    monkeypatch.setattr(trie, "LAYOUT", Sizes(group_limit=7))
    monkeypatch.setattr(trie, "EDGE", 3)
    monkeypatch.setattr(trie, "PIECE", 2)
    same(trie.conversation_trie(df), wanted)


@pytest.mark.parametrize("batches", [1, 5])
def test_batches_do_not_matter(spark, batches):
    rows = crowd()
    convs = own_turns(rows)
    df = spark.createDataFrame(rows, SHAPE)
    same(trie.shared_trie(df, batches), plain(shared(convs)))


def test_odd_rows(spark):
    rows = [(0, None, None, None), (0, 0, "u", "a"), (0, 1, "u", None), (1, 0, "u", "a"), (1, 0, "u", "a"), (5, 3, None, ""), (None, 0, "u", "x"),
            (-250, 0, "u", "neg"), (-200, 1, "u", "a"), (-3, 1, "u", "a"), (7, 0, "u", "a" * 50_000), (7, 1, "ü", "é🤖"), (203, 0, "u", "no base"),
            (7, 2, "u", "ab"), (8, 2, "ua", "b")]
    df = spark.createDataFrame([(*r, 1) for r in rows], f"{SHAPE}, depth int")
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    found = con.sql(trie.ORACLE)
    same(trie.shared_trie(df), found.select(*[duckdb.ColumnExpression(c) for c in NAMES]).fetchall())
    same(trie.conversation_trie(df), plain(own_turns(rows)))
    assert trie.shared_trie(df.limit(0)).collect() == []


def test_only_turnless(spark):
    """All turns of a conversation whose base is absent may go; the root remains."""
    gone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 3)
    df = spark.createDataFrame([(gone, 0, "u", "a"), (gone, 1, "u", "b")], SHAPE)
    digest = hashlib.sha256(str(gone).encode()).hexdigest()
    assert [tuple(r) for r in trie.shared_trie(df).collect()] == [(gone, 0, None, 1, 0, 1, 0, digest)]


def test_fattest(spark):
    pairs = [(a, b) for b in range(1, 70) for a in range(b)]
    df = spark.createDataFrame(pairs, "a int, b int")
    for row in df.select("a", "b", trie.fattest(df.a, df.b).alias("f")).collect():
        assert row["f"] == max(range(row["a"] + 1, row["b"] + 1), key=lambda x: x & -x)
