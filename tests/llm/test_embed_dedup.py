import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
from conftest import SMALL  # noqa: E402
from tidemark.llm import embed_dedup as ed  # noqa: E402
from tidemark.llm.queries import QUERIES  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, g string, n long"


def expected(rows, cosine=0.98):
    ok = {}
    for i, v, l in rows:
        if v and l is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, np.float32).astype(float)
            ok[i] = (l, a / np.linalg.norm(a))
    u, links = brute.Union(), {i: 0 for i, _, _ in rows}
    ids = list(ok)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            if ok[i][0] == ok[j][0] and len(ok[i][1]) == len(ok[j][1]) and ok[i][1] @ ok[j][1] >= cosine:
                u.join(i, j)
                links[i] += 1
                links[j] += 1
    return {i: (links[i], u.find(i)) for i, _, _ in rows}


def check(df, rows):
    got = {r.vec_id: r for r in df.collect()}
    want = expected(rows)
    assert len(got) == len(want)
    for i, w in want.items():
        assert (got[i].n_links, got[i].component_id) == w, (i, w, got[i])
        assert got[i].kept == (i == w[1])


def test_query_matches_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check(QUERIES["op4_embedding_dedup"](spark, SMALL), rows)


@pytest.mark.parametrize("cell,block,pivots", [(2000, 2048, 4096), (30, 16, 64), (10, 7, 12)])
def test_cells_and_blocks(spark, monkeypatch, cell, block, pivots):
    monkeypatch.setattr(ed, "BLOCK", block)
    r = np.random.default_rng(3)
    base = r.normal(size=(25, 8))
    rows = []
    for i in range(500):
        v = base[r.integers(25)] * r.uniform(.1, 9) + r.normal(size=8) * r.choice([0, .05, .12, .3])
        rows.append((i, [float(np.float32(x)) for x in v], int(r.integers(2))))
    rows += [(500 + i, rows[0][1], 0) for i in range(40)]
    df = spark.createDataFrame([(*x, "q", 1) for x in rows], SCHEMA)
    check(ed.near_duplicates(df, cell=cell, pivots=pivots), rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1),
            (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 2),
            (12, [1e-30, 0.0], 1), (13, [1e30, 0.0], 1), (14, [-1.0, 0.0], 1)]
    df = spark.createDataFrame([(*x, None, 0) for x in rows], SCHEMA)
    check(ed.near_duplicates(df), rows)
    assert ed.near_duplicates(df.limit(0)).collect() == []
    twice = ed.near_duplicates(df.where("vec_id in (8, 9)").union(df.where("vec_id = 9")).union(
        df.where("vec_id = 9").selectExpr("cast(null as long)", "embedding", "label", "g", "n"))).collect()
    assert sorted(str(tuple(r)) for r in twice) == sorted(
        ["(8, 3, 8, True)", "(9, 3, 8, False)", "(9, 3, 8, False)", "(None, 3, 8, False)"])


def test_cosine_of_exactly_the_limit(spark):
    """Integer vectors whose cosine is exactly 98 / 100 link, whatever the
    partitioning; those just below do not."""
    import itertools
    import math
    pairs = []
    for a in itertools.product(range(-9, 10, 2), repeat=4):
        if sum(x * x for x in a) == 100:
            pairs.append(a)
    extra = [(-9, -3, -3, -1), (-9, -3, -3, 1), (9, 3, 3, 1), (90, 30, 30, 10), (-18, -6, -6, 2)]
    vecs = [*dict.fromkeys([*pairs, *extra])]
    df = spark.createDataFrame([(i, "x", [float(c) for c in v]) for i, v in enumerate(vecs)], "vec_id long, label string, embedding array<double>")
    n = [sum(1 for j, b in enumerate(vecs) if i != j and (d := sum(x * y for x, y in zip(a, b))) > 0
             and 10000 * d * d >= 9604 * sum(x * x for x in a) * sum(x * x for x in b)) for i, a in enumerate(vecs)]
    for parts, cell in ((1, 2000), (7, 20)):
        got = {r.vec_id: r.n_links for r in ed.near_duplicates(df.repartition(parts), cell=cell).collect()}
        assert [got[i] for i in range(len(vecs))] == n
    assert max(n) > 0 and math.isclose(98 / 100, 0.98)
