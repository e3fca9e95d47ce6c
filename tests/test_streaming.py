"""Stream = batch, whatever the micro-batch cut; resume from checkpoint."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tidemark.operators import detectors, patterns, rolling, windows
from tidemark.sources.tables import behaviour_from, behaviour_log
from tidemark.streaming import stateful
from tidemark.streaming.run import EndOfInput, keep, run_stream, run_to_table

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")


def _split_events(spark, folder, parts=4):
    """Events cut into `parts` files by event_id mod parts: every file spans
    the whole time range, so rows reach the stream out of time order."""
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    for i in range(parts):
        ev.filter(F.pmod("event_id", F.lit(parts)) == i).coalesce(1) \
          .write.parquet(f"{folder}/part{i}")
    return ev.schema


def _stream(spark, schema, folder, end, delay="40 days"):
    raw = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
                .parquet(f"{folder}/src"))
    return end.attach(behaviour_from(raw), "ts", delay)


def _stage(folder, names):
    """Add data files to the source folder one by one (oldest first)."""
    import time
    os.makedirs(f"{folder}/src", exist_ok=True)
    for n in names:
        for f in sorted(os.listdir(f"{folder}/{n}")):
            if f.endswith(".parquet"):
                os.link(f"{folder}/{n}/{f}", f"{folder}/src/{n}-{f}")
                os.utime(f"{folder}/src/{n}-{f}")
                time.sleep(0.01)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_out_of_order_micro_batches_equal_batch(spark, scratch):
    schema = _split_events(spark, scratch)
    _stage(scratch, [f"part{i}" for i in range(4)])
    b = behaviour_log(spark, SMALL)

    end = EndOfInput(spark)
    pv = windows.tumbling_count(_stream(spark, schema, scratch, end)
                                .filter(keep(F.col("behavior") == "view")), "ts", 3600)
    got = run_to_table(pv, "t_pv", end=end)
    exp = windows.tumbling_count(b.filter("behavior = 'view'"), "ts", 3600)
    assert _same(got, exp)

    end = EndOfInput(spark)
    ch = stateful.apply(_stream(spark, schema, scratch, end), ["user_id"],
                        stateful.ChangeAlert(["user_id"], 10.0),
                        "seq bigint, ts_us bigint, last_value double, cur_value double")
    got = run_to_table(ch, "t_change", end=end).select("user_id", "seq", "last_value", "cur_value")
    exp = rolling.change_alert(b, ["user_id"], [F.col("ts"), F.col("seq")], "value", 10.0) \
        .select("user_id", "seq", "last_value", "cur_value")
    assert _same(got, exp)

    end = EndOfInput(spark)
    cap = stateful.apply(_stream(spark, schema, scratch, end), ["user_id", "behavior"],
                         stateful.DailyCap(["user_id", "behavior"], 2),
                         "output string, seq bigint, ts_us bigint")
    got = run_to_table(cap, "t_cap", end=end)
    passed, alarms = detectors.daily_cap(b.select("user_id", "behavior", "seq", "ts"),
                                         ["user_id", "behavior"], "ts", "seq", 2)
    assert _same(got.filter("output = 'pass'").select("seq"), passed.select("seq"))
    assert _same(got.filter("output = 'alarm'").select("seq"), alarms.select("seq"))

    end = EndOfInput(spark)
    rise = stateful.apply(_stream(spark, schema, scratch, end), ["user_id"],
                          stateful.RiseTimer(["user_id"], 12 * 3600), "start_us bigint, alert_us bigint")
    alerts = run_to_table(rise, "t_rise", end=end).select(
        "user_id", F.timestamp_micros("start_us").alias("start_ts"))
    first = patterns.sustained_rise_first(b, ["user_id"], "ts", "seq", "value", 12 * 3600) \
        .select("user_id", "start_ts")
    # every first-of-run alert of the batch form is among the stream's alerts
    assert first.exceptAll(alerts).count() == 0
    assert alerts.count() >= first.count()


def test_resume_from_checkpoint_equals_one_run(spark, scratch):
    schema = _split_events(spark, scratch)
    ck, out = f"{scratch}/ck", f"{scratch}/out"

    _stage(scratch, ["part0", "part1"])
    end = EndOfInput(spark)
    pv = windows.tumbling_count(_stream(spark, schema, scratch, end).filter(keep(F.col("behavior") == "view")), "ts", 3600)
    run_stream(pv, "t_resume", out, checkpoint=ck).awaitTermination()
    _stage(scratch, ["part2", "part3"])
    got = run_to_table(pv, "t_resume", path=out, checkpoint=ck, end=end)
    exp = windows.tumbling_count(behaviour_log(spark, SMALL).filter("behavior = 'view'"),
                                 "ts", 3600)
    assert _same(got, exp)
    with pytest.raises(ValueError, match="end of input"):
        run_stream(pv, "t_resume", out, checkpoint=ck)


def test_rate_limited_files_lose_no_row(spark, scratch):
    """Four files in time order, one per micro-batch: every row is counted,
    and the keyed operators, whose timers now fire between micro-batches,
    equal the batch forms."""
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    cut = ev.selectExpr("*", "ntile(4) over (order by ts, event_id) as part")
    for i in range(4):
        cut.where(F.col("part") == i + 1).drop("part").coalesce(1).write.parquet(f"{scratch}/part{i}")
    _stage(scratch, [f"part{i}" for i in range(4)])
    b = behaviour_log(spark, SMALL)
    end = EndOfInput(spark)
    got = run_to_table(windows.tumbling_count(_stream(spark, ev.schema, scratch, end, "1 hour"), "ts", 3600), "t_four", end=end)
    assert got.agg(F.sum("n")).first()[0] == ev.count()
    end = EndOfInput(spark)
    ch = stateful.apply(_stream(spark, ev.schema, scratch, end, "1 hour"), ["user_id"], stateful.ChangeAlert(["user_id"], 10.0),
                        "seq bigint, ts_us bigint, last_value double, cur_value double")
    got = run_to_table(ch, "t_four_change", end=end).select("user_id", "seq", "last_value", "cur_value")
    exp = rolling.change_alert(b, ["user_id"], [F.col("ts"), F.col("seq")], "value", 10.0) \
        .select("user_id", "seq", "last_value", "cur_value")
    assert _same(got, exp)


def test_late_rows_are_dropped(spark, scratch):
    """Ascending-time watermark (0 s).  The 00:00 window is emitted in the
    second micro-batch; a row for it arriving in the third is dropped.
    (Spark closes a window one micro-batch after the watermark passes it, so
    a late row in that very batch would still count: see README.)"""
    import datetime as dt
    schema = "seq bigint, ts timestamp, k string"
    base = dt.datetime(2024, 1, 1)
    batches = [[(1, base, "a"), (2, base + dt.timedelta(hours=2), "a")],
               [(3, base + dt.timedelta(hours=3), "a")],
               [(4, base + dt.timedelta(minutes=5), "a"),          # late: window closed
                (5, base + dt.timedelta(hours=4), "a")]]
    import time
    os.makedirs(f"{scratch}/src")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/b{i}")
        for f in os.listdir(f"{scratch}/b{i}"):
            if f.endswith(".parquet"):
                os.link(f"{scratch}/b{i}/{f}", f"{scratch}/src/{i}-{f}")
                time.sleep(0.05)
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
              .parquet(f"{scratch}/src").withWatermark("ts", "0 seconds"))
    counts = windows.tumbling_count(s, "ts", 3600)
    q = run_stream(counts, "t_late", f"{scratch}/out", checkpoint=f"{scratch}/ck")
    q.awaitTermination()
    got = {r["window_start"]: r["n"] for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert got == {base: 1, base + dt.timedelta(hours=2): 1, base + dt.timedelta(hours=3): 1}


def test_multi_output_routes_tagged_rows(spark, scratch):
    """One pass over the stream, one output folder per tag."""
    from tidemark.streaming.run import multi_output
    rows = [(1, "pass"), (2, "pass"), (3, "alarm")]
    spark.createDataFrame(rows, "seq bigint, output string").write.parquet(f"{scratch}/in")
    s = spark.readStream.schema("seq bigint, output string").parquet(f"{scratch}/in")
    q = multi_output(s, "output", {"pass": f"{scratch}/pass", "alarm": f"{scratch}/alarm"},
                     "t_multi", checkpoint=f"{scratch}/ck")
    q.awaitTermination()
    assert sorted(r["seq"] for r in spark.read.parquet(f"{scratch}/pass").collect()) == [1, 2]
    assert [r["seq"] for r in spark.read.parquet(f"{scratch}/alarm").collect()] == [3]


def test_console_sink_runs(spark, scratch):
    """Labelled print sink drains a stream."""
    from tidemark.streaming.run import console
    spark.createDataFrame([(1,)], "seq bigint").write.parquet(f"{scratch}/in")
    q = console(spark.readStream.schema("seq bigint").parquet(f"{scratch}/in"), "black")
    try:
        q.processAllAvailable()
        assert q.lastProgress["numInputRows"] == 1
    finally:
        q.stop()


def test_pandas_mode_equals_row_mode(spark):
    """The same processor through `transformWithStateInPandas` (rows=False)."""
    from tidemark.streaming.twins import behaviour_stream
    end = EndOfInput(spark)
    out = stateful.apply(behaviour_stream(spark, SMALL, end), ["user_id"],
                         stateful.ChangeAlert(["user_id"], 10.0),
                         "seq bigint, ts_us bigint, last_value double, cur_value double",
                         rows=False)
    got = run_to_table(out, "t_pandas_mode", end=end).select("user_id", "seq", "last_value", "cur_value")
    exp = rolling.change_alert(behaviour_log(spark, SMALL), ["user_id"],
                               [F.col("ts"), F.col("seq")], "value", 10.0) \
        .select("user_id", "seq", "last_value", "cur_value")
    assert _same(got, exp)


def test_order_status_out_of_order_batches_equal_batch(spark, scratch):
    """Rows handled on arrival (order-insensitive processor): the last
    verdict per order equals the batch verdict, whatever the arrival order."""
    from tidemark.sources.tables import order_log
    log = order_log(spark, SMALL).withColumn("seq", F.lit(0).cast("bigint"))
    schema = log.schema
    for i in range(3):
        log.filter(F.pmod(F.xxhash64("order_id", "event_type", "ts"), F.lit(3)) == i).coalesce(1) \
           .write.parquet(f"{scratch}/part{i}")
    _stage(scratch, [f"part{i}" for i in range(3)])
    end = EndOfInput(spark)
    s = end.attach(spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
                   .parquet(f"{scratch}/src"), "ts", "4000 days")
    out = stateful.apply(s, ["order_id"], stateful.OrderStatus(["order_id"], 365 * 86400),
                         "status string, create_us bigint, pay_us bigint, delay_s bigint, n bigint")
    res = run_to_table(out, "t_orders_ooo", end=end)
    last = res.groupBy("order_id").agg(F.max_by("status", "n").alias("status"))
    exp = detectors.order_status(order_log(spark, SMALL), limit_s=365 * 86400) \
        .select("order_id", "status")
    assert _same(last, exp)


def test_one_run_fills_all_outputs_and_a_replayed_epoch_adds_nothing(spark, scratch):
    from tidemark.streaming.run import epoch_writer, read_outputs, run_to_tables
    spark.createDataFrame([(1, "pass"), (2, "pass"), (3, "alarm")], "seq bigint, output string").write.parquet(f"{scratch}/in")
    s = spark.readStream.schema("seq bigint, output string").parquet(f"{scratch}/in")
    got = run_to_tables(s, "output", ["pass", "alarm", "none"], "t_outputs", path=f"{scratch}/out")
    seqs = lambda t: sorted(r["seq"] for r in t.collect())
    assert (seqs(got["pass"]), seqs(got["alarm"]), seqs(got["none"])) == ([1, 2], [3], [])
    write = epoch_writer(f"{scratch}/again", "output")
    batch = spark.read.parquet(f"{scratch}/in")
    for epoch in (0, 1, 1, 0):              # a lost driver runs an epoch again
        write(batch.where(F.col("seq") % 2 == epoch), epoch)
    again = read_outputs(spark, f"{scratch}/again", batch.schema, "output", ["pass", "alarm"])
    assert (seqs(again["pass"]), seqs(again["alarm"])) == ([1, 2], [3])


def test_order_state_ends_after_its_retention(spark, scratch):
    """A late pay inside the retention corrects the verdict; afterwards no
    state is left; every event of another type is reported."""
    import time
    day = 86400
    parts = [[("o1", "create", 0), ("o2", "create", 0), ("o3", "refund", 0), ("o2", "refund", 5), ("o4", "pay", 10)],
             [("x", "create", 1200)], [("w", "create", 1300)], [("o1", "pay", 2000)], [("y", "create", 30 * day)], [("z", "create", 90 * day)]]
    os.makedirs(f"{scratch}/src")
    schema = "order_id string, event_type string, ts timestamp, seq bigint"
    for i, rows in enumerate(parts):
        df = spark.createDataFrame([(o, e, t) for o, e, t in rows], "order_id string, event_type string, s bigint")
        df.select("order_id", "event_type", F.timestamp_seconds("s").alias("ts"), F.lit(0).cast("bigint").alias("seq")) \
          .coalesce(1).write.parquet(f"{scratch}/p{i}")
    _stage(scratch, [f"p{i}" for i in range(len(parts))])
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{scratch}/src").withWatermark("ts", "0 seconds"))
    out = stateful.apply(s, ["order_id"], stateful.OrderStatus(["order_id"], 900, retention_s=7 * day),
                         "status string, create_us bigint, pay_us bigint, delay_s bigint, n bigint")
    q = run_stream(out, "t_retention", f"{scratch}/out", checkpoint=f"{scratch}/ck", trigger="0 seconds", partitions=2)
    try:
        q.processAllAvailable()
        time.sleep(1)
        left = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    finally:
        q.stop()
    rows = [(r.order_id, r.status, r.n) for r in spark.read.parquet(f"{scratch}/out").collect()]
    assert sorted(r for r in rows if r[0] not in "wxyz") == [
        ("o1", "paid_late", 2), ("o1", "unpaid", 1), ("o2", "bad_type", 0), ("o2", "unpaid", 1), ("o3", "bad_type", 0),
        ("o4", "pay_without_create", 1)]
    assert left == 1                        # the last order only


def test_followed_by_and_next_out_of_order_equal_batch(spark, scratch):
    """One busy key, rows dealt to the micro-batches out of order."""
    ev = spark.read.parquet(f"{SMALL}/events.parquet").withColumn("user_id", F.lit(7).cast("bigint"))
    for i in range(3):
        ev.filter(F.pmod("event_id", F.lit(3)) == i).coalesce(1).write.parquet(f"{scratch}/part{i}")
    _stage(scratch, [f"part{i}" for i in range(3)])
    b = behaviour_from(ev)
    a, p = F.col("behavior") == "view", F.col("behavior") == "purchase"
    end = EndOfInput(spark)
    s = _stream(spark, ev.schema, scratch, end).select(
        "user_id", "ts", "seq", F.when(F.col("behavior") == "view", "a").when(F.col("behavior") == "purchase", "b").alias("kind"))
    out = stateful.apply(s, ["user_id"], stateful.FollowedBy(["user_id"], 1800),
                         "output string, a_seq bigint, a_us bigint, b_seq bigint, b_us bigint")
    got = run_to_table(out, "t_followed", end=end)
    exp = patterns.followed_by(b, ["user_id"], "ts", "seq", a, p, 1800)
    assert _same(got.where("output = 'match'").select("a_seq", "b_seq"), exp.where("matched").select("a_seq", "b_seq"))
    assert _same(got.where("output = 'timeout'").select("a_seq"), exp.where("not matched").select("a_seq"))

    end = EndOfInput(spark)
    s = _stream(spark, ev.schema, scratch, end).select("user_id", "ts", "seq", F.coalesce(a, F.lit(False)).alias("is_first"), F.coalesce(p, F.lit(False)).alias("is_second"))
    out = stateful.apply(s, ["user_id"], stateful.NextPattern(["user_id"], 1800),
                         "a_seq bigint, a_us bigint, b_seq bigint, b_us bigint")
    got = run_to_table(out, "t_next", end=end).select("a_seq", "b_seq")
    exp = patterns.next_pattern(b, ["user_id"], "ts", "seq", a, p, 1800).select("a_seq", "b_seq")
    assert exp.count() > 0 and _same(got, exp)


def test_bad_events(spark):
    df = spark.createDataFrame([(1, "create"), (1, "refund"), (2, None), (3, "pay")], "order_id int, event_type string")
    assert sorted(r.order_id for r in detectors.bad_events(df).collect()) == [1, 2]


@pytest.mark.parametrize("delay", ["0 seconds", "3 days", "40 days"])
def test_keys_in_buckets_equal_batch(spark, tmp_path, delay):
    """The daily cap with many keys to a group: state, deadlines and waiting
    rows of each key are its own, over micro-batches in event time and with
    null keys."""
    ev = spark.read.parquet(f"{SMALL}/events.parquet").withColumn("user_id", F.expr("case when user_id % 50 <> 0 then user_id % 30 end"))
    for i, (lo, hi) in enumerate([(0, 9), (9, 10), (10, 22), (22, 99)]):
        day = F.dayofyear("ts")
        ev.filter((day > lo) & (day <= hi)).coalesce(1).write.parquet(f"{tmp_path}/src/part{i}")
    raw = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", "1")
                .parquet(f"{tmp_path}/src/part*"))
    end = EndOfInput(spark)
    cap = stateful.apply(end.attach(behaviour_from(raw), "ts", delay), ["user_id", "behavior"],
                         stateful.DailyCap(["user_id", "behavior"], 2, "day"),
                         "output string, seq bigint, ts_us bigint", buckets=7)
    got = run_to_table(cap, "t_buckets", end=end)
    passed, alarms = detectors.daily_cap(behaviour_from(ev).select("user_id", "behavior", "seq", "ts"),
                                         ["user_id", "behavior"], "ts", "seq", 2, "day")
    for output, exp in (("pass", passed), ("alarm", alarms)):
        assert exp.count() > 20
        assert _same(got.filter(F.col("output") == output).select("user_id", "behavior", "seq"), exp.select("user_id", "behavior", "seq"))
