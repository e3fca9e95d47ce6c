"""User aggregates, whole-window functions and sketches against plain forms."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import aggregate as ag
from tidemark.operators import windows

T0 = dt.datetime(2024, 1, 1)


def _rows(n=4000, seed=1):
    r = random.Random(seed)
    return [(i, T0 + dt.timedelta(seconds=r.randrange(5 * 3600)), r.choice([None, "a", "b", "hot", "hot"]),
             r.choice([None, r.randrange(50)]), r.choice([None, float(r.randrange(20))])) for i in range(n)]


SCHEMA = "seq bigint, ts timestamp, k string, item_id bigint, value double"


def _expected(rows):
    want = {}
    for seq, ts, k, item, value in rows:
        want.setdefault((ts.replace(minute=0, second=0), k), []).append((seq, item, value))
    out = {}
    for key, g in want.items():
        items = [i for _, i, _ in g if i is not None]
        best = min(((-v, s) for s, _, v in g if v is not None), default=None)
        out[key] = (len(g), sum(items) / len(items) if items else None, -best[0] if best else None, best[1] if best else None)
    return out


def _got(df):
    rows = df.collect()
    out = {(r.window_start, r.k): (r.n, r.mean_item, r.top_value, r.top_seq) for r in rows}
    assert len(out) == len(rows)
    return out


def test_user_aggregate_equals_plain_form(spark, monkeypatch):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert _got(ag.window_aggregate(df, "ts", 3600, ["k"], ag.ValueProfile())) == _expected(rows)
    assert _got(ag.window_aggregate(df, "ts", 3600, ["k"], ag.ValueProfile(), salts=3)) == _expected(rows)


def test_states_handed_on_early_and_tiny_batches(spark):
    """A task that runs out of room for states, batches that cut every group."""
    rows = _rows(600, 2)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    run = ag._partial(ag.ValueProfile(), ["k"], ag._fields("k string, " + ag.ValueProfile.STATE))
    old, ag.MAX_STATES = ag.MAX_STATES, 2
    try:
        parts = list(run(df.select("k", "seq", "item_id", "value").toArrow().to_batches(max_chunksize=50)))
    finally:
        ag.MAX_STATES = old
    assert len(parts) > 5 and sum(sum(b.column(1).to_pylist()) for b in parts) == 600
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert _got(ag.window_aggregate(df, "ts", 3600, ["k"], ag.ValueProfile())) == _expected(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_only_states_are_shuffled(spark):
    df = spark.createDataFrame(_rows(50), SCHEMA)
    plan = ag.window_aggregate(df, "ts", 3600, ["k"], ag.ValueProfile())._jdf.queryExecution().executedPlan().toString()
    merge, partial = plan.split("Exchange", 1)      # plans are printed from the result down
    assert merge.count("MapInArrow") == 1 and partial.count("MapInArrow") == 1


def test_nan_and_null_keys_and_no_rows(spark):
    df = spark.createDataFrame([(1, float("nan"), 1, 1.0), (2, float("nan"), None, None), (3, None, 3, 2.0), (4, 0.5, 4, 2.0)],
                               "seq bigint, k double, item_id bigint, value double").repartition(3)
    got = sorted((str(r.k), r.n, r.top_seq) for r in ag.aggregate(df, ["k"], ag.ValueProfile()).collect())
    assert got == [("0.5", 1, 4), ("None", 1, 3), ("nan", 2, 1)]
    assert [r.n for r in ag.aggregate(df, [], ag.ValueProfile()).collect()] == [4]
    assert ag.aggregate(df.where("seq < 0"), ["k"], ag.ValueProfile()).collect() == []
    assert ag.aggregate(df.where("seq < 0"), [], ag.ValueProfile()).collect() == []


def test_whole_window_longer_than_a_batch(spark):
    rows = _rows(3000, 3) + [(9999, None, "a", 1, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    seen = {}
    for _, ts, k, item, _ in rows:
        if ts is not None:
            seen.setdefault((ts.replace(minute=0, second=0), k), set()).add(item)
    want = {key: len(v - {None}) for key, v in seen.items()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        out = ag.whole_window(df, "ts", 3600, ["k"], ag.distinct_in_order("item_id"), "n bigint", ["item_id"], ["item_id"])
        assert {(r.window_start, r.k): r.n for r in out.collect()} == want

        def pieces(key, batches):       # a function that stops early sees only one batch, and nothing of the next window
            t = next(batches)
            yield t.num_rows, key[2]
        out = ag.whole_window(df, "ts", 3600, ["k"], pieces, "n int, same string", ["seq"], ["seq"]).collect()
        assert len(out) == len(want) and all(0 < r.n <= 16 and r.same == r.k for r in out)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_sketches_merge_without_the_rows(spark):
    df = spark.range(60_000).select(F.expr("id % 9000").alias("u"), F.lit("x").alias("k"),
                                    F.expr("timestamp_seconds(1704067200 + id % 172800)").alias("ts"))
    hourly = windows.sketch(df, "ts", 3600, "u", ["k"])
    daily = {r.window_start: r.uv for r in windows.merge_sketches(hourly, 86400, ["k"]).collect()}
    exact = {r.window_start: r.uv for r in windows.tumbling_distinct(df, "ts", 86400, "u", ["k"]).collect()}
    assert daily.keys() == exact.keys() and len(exact) >= 1
    for d, n in exact.items():
        assert abs(daily[d] - n) <= n * windows.sketch_error()
