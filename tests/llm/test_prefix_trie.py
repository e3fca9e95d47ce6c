"""Prefix trie of conversations against a brute-force trie."""

import hashlib
import random
import zlib

import pytest

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes of the contract, from sets of members of every prefix."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    seqs = {c: [r[2:] for r in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in seqs.items():
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own if c == base else seqs.get(base, [])[:h] + own[h:])
    members = {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        ends = sorted(c for c in m if rebuilt[c] == p)
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids),
                    sum(1 for q in below if not any(len(r) == len(q) + 1 and r[:-1] == q for r in below)),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    turns, convs = prefix_trie.shared_openings(prefix_trie.placed(df))
    rows = prefix_trie.with_ends_digest(prefix_trie.build(turns, convs)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(map(tuple, rows.collect()), key=str)


def rows_of(seed, n, turns=7):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rng.choice([0, 3, 7, 100, 101, 205, -5, -105, rng.randrange(400), None])
        for _ in range(rng.randrange(turns)):
            rows.append((c, rng.choice([None, 0, 1, 2, 3]), rng.choice(["user", "bot", "", None]), rng.choice(["a", "bb", "été", "", None])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = rows_of(seed, 60)
    rows += [(c, t, "user", "hello") for c in range(300, 340) for t in range(3)]       # many equal conversations
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_long_conversation_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = [(c, t, "user", f"t{t % 3}") for c in (1, 2, 100, 207) for t in range(23 + c % 4)] + [(5, 0, "bot", "x" * 5000)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_table_and_odd_columns(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    rows = rows_of(3, 20)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as depth", "2 as pos", "map('a', 1) as k1", "0 as part")
    assert result(df) == brute(rows)
    renamed = spark.createDataFrame(rows, SCHEMA).toDF("c.id", "turn.no", "role", "the text")
    got = prefix_trie.placed(renamed, "c.id", "turn.no", "role", "the text")
    assert got.count() == sum(r[0] is not None for r in rows)


def test_leaves_and_sequences(spark):
    rows = [(1, 0, "u", "a"), (2, 0, "u", "a"), (2, 1, "b", "c"), (3, 0, "u", "a")]
    trie = prefix_trie.build(prefix_trie.placed(spark.createDataFrame(rows, SCHEMA)),
                             spark.createDataFrame([(1,), (2,), (3,), (4,)], "conv long"))
    seqs = {r.conv_id: (r.depth, r.weight, r.is_leaf) for r in trie.sequences.collect()}
    assert seqs == {1: (1, 2, False), 2: (2, 1, True), 4: (0, 1, False)}
    assert {(r.conv_id, tuple(r.ids)) for r in trie.ends.collect()} == {(1, (1, 3)), (2, (2,)), (4, (4,))}
