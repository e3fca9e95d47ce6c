import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
from conftest import SMALL  # noqa: E402
from tidemark.llm import minhash_dedup as mh  # noqa: E402
from tidemark.llm.queries import QUERIES  # noqa: E402


def check(spark_rows, want):
    got = {r.doc_id: r for r in spark_rows}
    assert len(got) == len(want)
    for i, (n, c) in want.items():
        assert (got[i].n_shingles, got[i].component_id) == (n, c), (i, n, c, got[i])
        assert got[i].kept == (i == c)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    check(QUERIES["op5_minhash_dedup"](spark, SMALL).collect(), brute.near_groups(rows, 4, 80))


def planted(seed, groups, size, words=120):
    """Groups of near copies (chains and stars around the limit), exact
    copies, a passage that all share, and odd texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7)))
    passage, rows = [word() for _ in range(70)], []
    for _ in range(groups):
        base = [word() for _ in range(words)]
        for k in range(size):
            t = list(base) if r.random() < .7 else rows[-1][1].split()[:words] if rows else list(base)
            for _ in range(r.randint(0, 6)):
                t[r.randrange(len(t))] = word()
            if r.random() < .3:
                t = t + passage
            rows.append((len(rows), " ".join(t)))
    rows += [(len(rows) + i, t) for i, t in enumerate(
        [None, "", " \t\n", "one two", "ONE  two", "one two three", "É é", "é é", rows[0][1].upper(), rows[0][1]])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("short", [32, 3])
def test_planted_groups(spark, monkeypatch, short):
    monkeypatch.setattr(mh, "SHORT", short)
    monkeypatch.setattr(mh, "BLOCK", 7)
    rows = planted(5, 12, 25)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(mh.near_duplicates(df, width=4, hub_rounds=2 if short == 32 else 1).collect(), brute.near_groups(rows, 4, 80))


def test_empty_null_and_repeats(spark):
    schema = "doc_id long, text string, cid long, component_id string"
    assert mh.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    long = " ".join(f"w{i}" for i in range(20))
    rows = [(None, long, 1, "a"), (4, long, 2, "b"), (3, long + " x", 3, "c"), (4, long, 2, "b"), (9, None, 1, "z"),
            (None, None, 1, "q"), (None, "p q r s t u", 0, "n")]
    df = spark.createDataFrame(rows, schema)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in mh.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 16, 3, False), (4, 16, 3, False), (4, 16, 3, False), (3, 17, 3, True),
                          (9, 0, 9, True), (None, 0, None, True), (None, 2, None, True)], key=str)
    left = mh.keep_one(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id, r.component_id) for r in left.collect() if r.doc_id) == [(3, "c"), (9, "z")]
