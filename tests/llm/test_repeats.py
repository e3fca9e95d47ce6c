import hashlib
import random

import numpy as np
import pytest

from conftest import SMALL
from tidemark.llm import repeats as rp
from tidemark.llm.queries import QUERIES


def brute(rows, n=100):
    """doc_id -> (bytes, removed, spans, sha256 of the rest); every window."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - n + 1):
            w = b[s:s + n]
            if w in seen:
                gone[s:s + n] = True
            else:
                seen.add(w)
        left = bytes(c for c, g in zip(b, gone) if not g)
        starts = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(b) else 0
        out[i] = (len(b), int(gone.sum()), starts, hashlib.sha256(left).hexdigest())
    return out


def check(df, rows):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}
    want = brute(rows)
    bad = {i: (want[i][:3], got.get(i, ())[:3]) for i in want if got.get(i) != want[i]}
    assert not bad, (len(bad), list(bad.items())[:5])
    assert len(got) == len(want)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    check(QUERIES["op9_repeats"](spark, SMALL), rows)


def planted(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(r.randint(20, 60)) for _ in range(6)]
    rows = []
    for i in range(90):
        parts = [prose(r.randint(0, 60))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, 40)
            parts += [p[a:a + r.randint(80, 300)], prose(r.randint(0, 8))]
        if r.random() < .2:
            parts.append((word() + " ") * r.randint(10, 120))
        if r.random() < .2 and rows:
            parts = [rows[-1][1][:-3] + "x"]
        rows.append((i * 3, "".join(parts)))
    rows += [(1, None), (2, ""), (4, "a" * 99), (5, "a" * 100), (7, "a" * 400), (8, "ab" * 200), (10, rows[3][1]),
             (11, "z" * 20 + rows[3][1]), (500, "q" * 60000), (501, "qw" * 30000)]
    return rows


@pytest.mark.parametrize("bucket,cap", [(4000, 10_000), (5, 10_000), (40, 3)])
def test_planted_passages(spark, monkeypatch, bucket, cap):
    monkeypatch.setattr(rp, "BUCKET", bucket)
    monkeypatch.setattr(rp, "CAP", cap)
    rows = planted(bucket)
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(a, b, 0, "x", "y") for a, b in rows],
                               "doc_id long, text string, at int, key string, seg string").repartition(5)
    check(rp.remove_repeats(df), rows)


def test_groups_list_all_occurrences(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    p = " ".join(word() for _ in range(30))
    rows = [(i, " ".join(word() for _ in range(30)) + f" {i}# " + p + f" #{i} " + " ".join(word() for _ in range(9)))
            for i in range(7)]
    got = rp.repeat_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    start = {(i, t.index(p)) for i, t in rows}
    by = {}
    for g in got:
        by.setdefault((g.group, g.size), set()).add((g.doc_id, g.start))
    # the "# " before the passage belongs to it: the group starts there, in all seven texts
    assert {(i, s - 2) for i, s in start} in [{(d, s) for d, s in x} for x in by.values()]
    text = dict(rows)
    for (_, size), occ in by.items():
        assert size >= 100 and len(occ) > 1
        assert len({text[d].encode()[s:s + size] for d, s in occ}) == 1


def test_suffix_array_and_interval_tree():
    r = np.random.default_rng(0)
    data = r.integers(97, 99, 600).astype(np.uint8)
    starts = np.arange(500)
    stops = np.minimum(starts + 140, 600)
    sa = rp.SuffixArray(data, starts, stops)
    b = data.tobytes() + bytes(300)
    assert [b[s:s + 250] for s in sa.start] == sorted(b[s:s + 250] for s in starts)
    for i in range(1, 500):
        x, y = b[sa.start[i - 1]:sa.stop[i - 1]], b[sa.start[i]:sa.stop[i]]
        n = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert sa.lcp[i] == n
    first = r.permutation(500)
    reps, groups = rp.interval_tree(np.where(np.arange(500) == 0, 0, np.maximum(sa.lcp, 1)).tolist(), first.tolist(),
                                    [-1] * 500, 1)
    assert sorted(i for i, _ in reps) == sorted(set(range(500)) - {int(np.argmin(first))})
    lcp = np.maximum(sa.lcp, 1)
    for i, size in reps[:60]:                # the longest prefix shared with any earlier suffix
        best = 0
        for j in range(500):
            if first[j] < first[i]:
                a, z = min(i, j), max(i, j)
                best = max(best, lcp[a + 1:z + 1].min())
        assert size == best


def test_empty_null_and_repeats(spark):
    schema = "doc_id long, text string"
    assert rp.remove_repeats(spark.createDataFrame([], schema)).collect() == []
    t = "".join(chr(97 + i * i % 23) + str(i) for i in range(80))
    df = spark.createDataFrame([(5, t), (5, t), (None, t), (6, "0" + t), (None, None), (3, "short")], schema)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in rp.remove_repeats(df).collect())
    n = len(t)
    assert got == sorted([("5", n, 0, 0), ("5", n, 0, 0), ("None", n, n, 1), ("6", n + 1, n, 1), ("None", 0, 0, 0),
                          ("3", 5, 0, 0)])
