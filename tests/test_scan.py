"""The chunked running scan equals a plain per-key window, for every kind
and frame, with chunks small enough that most carries cross chunks."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import scan


def _rows(seed, n=400, keys=4, hot=0.5):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = 0 if rnd.random() < hot else rnd.randrange(1, keys)   # one hot key
        v = None if rnd.random() < 0.1 else round(rnd.uniform(-50, 50), 2)
        out.append((k, rnd.randrange(0, 200), i, v))
    return out


def _brute(rows, kind, frame):
    df = pd.DataFrame(rows, columns=["k", "t", "seq", "v"]).sort_values(["k", "t", "seq"])
    res = {}
    for _, g in df.groupby("k"):
        vals = g["v"].tolist()
        seqs = g["seq"].tolist()
        for i, s in enumerate(seqs):
            sl = {"upto": vals[:i + 1], "before": vals[:i], "from": vals[i:],
                  "after": vals[i + 1:]}[frame]
            nn = [x for x in sl if x is not None and x == x]
            if kind == "count":
                r = len(nn)
            elif not nn:
                r = None
            else:
                r = {"sum": lambda: round(sum(nn), 6), "min": lambda: min(nn),
                     "max": lambda: max(nn), "first": lambda: nn[0],
                     "last": lambda: nn[-1]}[kind]()
            res[s] = r
    return res


@pytest.mark.parametrize("kind", ["sum", "count", "min", "max", "first", "last"])
@pytest.mark.parametrize("frame", ["upto", "before", "from", "after"])
@pytest.mark.parametrize("fanout", [None, 3])
def test_running_equals_window(spark, kind, frame, fanout):
    rows = _rows(hash((kind, frame)) % 1000)
    df = spark.createDataFrame(rows, "k int, t int, seq int, v double")
    out = scan.running(df, ["k"], [F.col("t"), F.col("seq")], {"r": (kind, F.col("v"))},
                       frame=frame, chunk=F.floor(F.col("t") / 7), carry_fanout=fanout)
    got = {r["seq"]: (round(r["r"], 6) if kind == "sum" and r["r"] is not None else r["r"])
           for r in out.collect()}
    assert got == _brute(rows, kind, frame)


def test_previous_and_following_unkeyed(spark):
    rows = _rows(7, n=300)
    df = spark.createDataFrame(rows, "k int, t int, seq int, v double")
    prev = scan.previous(df, [], [F.col("t"), F.col("seq")], {"p": F.col("seq")},
                         chunk=F.floor(F.col("t") / 5))
    nxt = scan.following(df, [], [F.col("t"), F.col("seq")], {"n": F.col("seq")},
                         chunk=F.floor(F.col("t") / 5))
    order = [s for _, _, s, _ in sorted(rows, key=lambda r: (r[1], r[2]))]
    exp_prev = {s: (order[i - 1] if i else None) for i, s in enumerate(order)}
    exp_next = {s: (order[i + 1] if i + 1 < len(order) else None) for i, s in enumerate(order)}
    assert {r["seq"]: r["p"] for r in prev.collect()} == exp_prev
    assert {r["seq"]: r["n"] for r in nxt.collect()} == exp_next


def test_hot_key_is_split_over_chunks(spark):
    """The in-chunk window is partitioned by (key, chunk), not by key."""
    rows = _rows(3)
    df = spark.createDataFrame(rows, "k int, t int, seq int, v double")
    out = scan.running(df, ["k"], [F.col("t"), F.col("seq")], {"r": ("sum", F.col("v"))},
                       chunk=F.floor(F.col("t") / 7))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__key" in plan and "__chunk" in plan


def test_carry_join_reuses_window_partitioning(spark):
    """Without broadcast, the full-size side is shuffled once (by key and
    chunk); the carry join reuses that partitioning."""
    rows = _rows(4)
    df = spark.createDataFrame(rows, "k int, t int, seq int, v double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = scan.running(df, ["k"], [F.col("t"), F.col("seq")], {"r": ("sum", F.col("v"))},
                           chunk=F.floor(F.col("t") / 7))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    full = [l for l in plan.splitlines() if "Exchange hashpartitioning(__key" in l
            and "__chunk" in l]
    # one exchange of the rows, one of the partial summaries: never a second
    # shuffle of the rows for the join
    assert "SortMergeJoin" in plan and len(full) == 2


@pytest.mark.parametrize("frame", ["upto", "before", "from", "after"])
@pytest.mark.parametrize("keys", [["k"], []])
def test_row_chunks_equal_window(spark, frame, keys):
    rows = _rows(11, n=900, keys=40) + [(None, 5, 2000 + i, 1.0) for i in range(90)] + [(3, None, 3000 + i, 2.0) for i in range(3)]
    df = spark.createDataFrame(rows, "k int, t int, seq int, v double")
    order = [F.col("t"), F.col("seq")]
    for kind in ("sum", "count", "first", "last"):
        got = scan.running(df, keys, order, {"r": (kind, F.col("v"))}, frame=frame, chunk_rows=40)
        plain = scan.running(df, keys, order, {"r": (kind, F.col("v"))}, frame=frame, chunk=F.lit(0))
        by = lambda d: {r["seq"]: r["r"] if r["r"] is None else round(r["r"], 6) for r in d.collect()}
        assert by(got) == by(plain)


@pytest.mark.parametrize("frame", ["upto", "before", "from", "after"])
def test_only_hot_keys_are_cut_by_given_chunks(spark, frame):
    """Given chunks with `hot_only` equal the plain window, with null keys and
    chunks; only hot keys are cut, and only they have summaries."""
    rows = [(None if i % 11 == 0 else 1 if i % 3 else i, None if i % 13 == 0 else i // 4, i, float(i * 7 % 50) if i % 5 else None)
            for i in range(600)]
    df = spark.createDataFrame(rows, "k int, t int, seq int, v double")
    order = [F.col("t"), F.col("seq")]
    for kind in ["sum", "count", "min", "max", "first", "last"]:
        got = scan.running(df, ["k"], order, {"r": (kind, F.col("v"))}, frame=frame, chunk=F.floor(F.col("t") / 2),
                           chunk_rows=40, hot_only=True)
        plain = scan.running(df, ["k"], order, {"r": (kind, F.col("v"))}, frame=frame, chunk=F.lit(0))
        assert got.columns == plain.columns
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    base = df.select("*", F.coalesce("k", F.lit(-1)).alias("key"), F.floor(F.col("t") / 2).alias("given"))
    cut, hot = scan.range_chunks(base, "key", "given", {"s": (F.count(F.lit(1)), F.sum("s"))}, rows=40)
    assert {r["key"] for r in hot.collect()} == {1, -1}
    sizes = {(r["key"], r["__chunk"]): r["count"] for r in cut.groupBy("key", "__chunk").count().collect()}
    assert {(r["key"], r["__chunk"]): r["s"] for r in hot.collect()} == {k: n for k, n in sizes.items() if k[0] in (1, -1)}
    assert max(n for (k, _), n in sizes.items() if k == 1) <= 80 and all(c == 0 for k, c in sizes if k not in (1, -1))


def test_one_key_that_is_never_null_is_shuffled_once(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "b a")], "doc_id bigint, text string").select(
        "doc_id", F.posexplode(F.split("text", " ")).alias("pos", "word"))
    out = scan.row_number(df, ["word"], ["doc_id", "pos"], chunk=F.col("doc_id"), chunk_rows=1, hot_only=True)
    assert sorted(map(tuple, out.collect())) == [(1, 0, "a", 1), (1, 1, "b", 1), (1, 2, "a", 2), (2, 0, "b", 2), (2, 1, "a", 3)]
    assert "named_struct" not in out._jdf.queryExecution().optimizedPlan().toString().split("Window")[-1]


def test_row_chunks_balance_a_burst(spark):
    """One key holds a third of the rows, all of them in one second; the
    chunks it is cut into are near the asked size, sparse keys stay whole."""
    n = 30_000
    df = spark.range(n).select(F.expr("case when id % 3 = 0 then 0 else id % 997 + 1 end").alias("k"),
                               F.expr("case when id % 3 = 0 then 1000 else id end").alias("t"), F.col("id").alias("seq"))
    cut, hot = scan.row_chunks(df, "k", [F.col("t"), F.col("seq")], rows=500)
    sizes = {(r["k"], r["__chunk"]): r["count"] for r in cut.groupBy("k", "__chunk").count().collect()}
    assert hot.count() == 1
    hot_sizes = sorted(c for (k, _), c in sizes.items() if k == 0)
    assert sum(hot_sizes) == n // 3 and 14 <= len(hot_sizes) <= 30
    assert hot_sizes[-1] <= 2 * hot_sizes[len(hot_sizes) // 2]
    assert all(c == 0 for k, c in sizes if k != 0)
    # largest task of the window against the median
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        tasks = sorted(r["count"] for r in cut.repartition("k", "__chunk").groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert tasks[-1] <= 2 * tasks[len(tasks) // 2]


def test_no_hot_key_is_a_plain_window(spark):
    df = spark.createDataFrame(_rows(12), "k int, t int, seq int, v double")
    out = scan.running(df, ["k"], [F.col("t"), F.col("seq")], {"r": ("sum", F.col("v"))})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert scan.running(df.limit(0), ["k"], [F.col("t")], {"r": ("sum", F.col("v"))}).count() == 0
