"""Operator semantics on small hand-built inputs of the reference's record
shapes (FIXTURES.md)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import java_split, seconds_to_ts
from tidemark.operators import detectors, joins, patterns, relational, rolling, scan, topn, windows
from tidemark.sources import text


def _lines(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "seq bigint, value string")


# ------------------------------------------------------------------ decode
def test_decode_keeps_empty_field_and_quotes(spark):
    lines = _lines(spark, ['34729,create,,1558430842', '"ws_006",1577844001,45.0'])
    orders = text.decode_lines(lines.filter("seq = 0"), text.ORDER_EVENT)
    r = orders.collect()[0]
    assert r["tx_id"] == "" and r["event_time"] == 1558430842
    ws = text.decode_lines(lines.filter("seq = 1"), text.WATER_SENSOR).collect()[0]
    assert ws["id"] == '"ws_006"' and ws["vc"] == 45.0


def test_decode_reject_mode_flags_bad_numbers(spark):
    lines = _lines(spark, ["1,create,,12", "x,create,,13", "2,create"])
    out = text.decode_lines(lines, text.ORDER_EVENT, on_error="reject", keep=["seq"])
    assert [r["_bad"] for r in out.orderBy("seq").collect()] == [False, True, True]


@pytest.mark.parametrize("line", ["x,create,,13", "1,create"])
def test_decode_fail_mode_raises(spark, line):
    lines = _lines(spark, [line])
    with pytest.raises(Exception):
        text.decode_lines(lines, text.ORDER_EVENT).collect()


def test_access_log_decode(spark):
    lines = _lines(spark, ["83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/"])
    r = text.decode_access_log(lines).collect()[0]
    assert r["ip"] == "83.149.9.216" and r["method"] == "GET" and r["url"] == "/presentations/"
    assert r["event_time"] == dt.datetime(2015, 5, 17, 10, 5, 3)


def test_java_split_rule(spark):
    df = spark.createDataFrame([("a b  c  ",), ("",), ("   ",), (" x",)], "s string")
    got = [r[0] for r in df.select(java_split("s", " ")).collect()]
    assert got == [["a", "b", "", "c"], [""], [], ["", "x"]]


# ------------------------------------------------------------------ words
LINES = ["red apple", "red pear", "red plum", "one more line"]


def test_word_count(spark):
    docs = spark.createDataFrame([(0, "\n".join(LINES))], "doc_id bigint, text string")
    wc = {r["word"]: r["cnt"] for r in relational.word_count(relational.words_split(docs)).collect()}
    assert wc == {"red": 3, "apple": 1, "pear": 1, "plum": 1, "one": 1, "more": 1, "line": 1}


def test_running_word_count_per_row(spark):
    docs = spark.createDataFrame([(i, l) for i, l in enumerate(LINES)], "doc_id bigint, text string")
    w = relational.words_ws(docs, keep=["doc_id"])
    out = relational.running_word_count(w, [F.col("doc_id"), F.col("pos")],
                                        chunk=F.col("doc_id"))
    red = [r["cnt"] for r in out.filter("word = 'red'").orderBy("doc_id").collect()]
    assert red == [1, 2, 3]


# ------------------------------------------------------------------ split / connect
TT = [("so", 1, 35.0), ("why", 2, 20.0), ("serious", 3, 31.5), ("a", 4, 30.0),
      ("?", 5, 40.0), ("ha", 6, -1.0)]


def test_split_and_connect(spark):
    df = spark.createDataFrame(TT, "id string, timestamp bigint, temperature double")
    tagged = relational.tag(df, [("high", F.col("temperature") > 30)], "low")
    high = {r["id"] for r in relational.select_tags(tagged, "high").collect()}
    low = {r["id"] for r in relational.select_tags(tagged, "low").collect()}
    assert high == {"so", "serious", "?"} and low == {"why", "a", "ha"}
    both = relational.connect_map(
        relational.select_tags(tagged, "high"), relational.select_tags(tagged, "low"),
        lambda d: d.select("id", "temperature", F.lit("warning").alias("msg")),
        lambda d: d.select("id", F.lit("normal").alias("msg")))
    rows = {r["id"]: (r["temperature"], r["msg"]) for r in both.collect()}
    assert rows["so"] == (35.0, "warning") and rows["why"] == (None, "normal")


# ------------------------------------------------------------------ rolling
def test_rolling_reduce_min_and_min_by(spark):
    rows = [("s1", 1, 5.0), ("s1", 2, 3.0), ("s1", 3, 3.0), ("s1", 4, 9.0)]
    df = spark.createDataFrame(rows, "id string, timestamp bigint, temperature double")
    order = [F.col("timestamp")]
    red = rolling.rolling(df, ["id"], order, {"mx": ("max", "timestamp"),
                                              "mn": ("min", "temperature")})
    assert [(r["mx"], r["mn"]) for r in red.orderBy("timestamp").collect()] == \
        [(1, 5.0), (2, 3.0), (3, 3.0), (4, 3.0)]
    mb = rolling.rolling_min_by(df, ["id"], order, "temperature", ["timestamp"])
    # ties keep the earliest row holding the minimum
    assert [r["min_timestamp"] for r in mb.orderBy("timestamp").collect()] == [1, 2, 2, 2]
    mf = rolling.rolling_min_keep_first(df, ["id"], order, "temperature", ["timestamp"])
    assert {r["first_timestamp"] for r in mf.collect()} == {1}


def test_change_alert_first_reading_vs_zero(spark):
    rows = [("s1", 1, 12.0), ("s1", 2, 15.0), ("s1", 3, 40.0)]
    df = spark.createDataFrame(rows, "id string, t bigint, temperature double")
    out = rolling.change_alert(df, ["id"], [F.col("t")], "temperature", 10.0)
    got = [(r["last_value"], r["cur_value"]) for r in out.orderBy("t").collect()]
    assert got == [(0.0, 12.0), (0.0, 0.0), (15.0, 40.0)]


# ------------------------------------------------------------------ patterns / detectors
def _ts(s):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def test_sustained_rise_first_and_cancel(spark):
    # rise at 0 -> fall at 5 (cancels); rise at 6 -> no fall within 10 s -> alert at 16
    rows = [(1, 0, 0, 1.0), (1, 5, 1, 0.5), (1, 6, 2, 2.0), (1, 7, 3, 3.0), (1, 30, 4, 1.0)]
    df = spark.createDataFrame([(k, _ts(t), s, v) for k, t, s, v in rows],
                               "k bigint, ts timestamp, seq bigint, v double")
    out = patterns.sustained_rise_first(df, ["k"], "ts", "seq", "v", 10)
    assert [(r["start_seq"], r["alert_ts"]) for r in out.collect()] == [(2, _ts(16))]


def test_followed_by_same_second_and_timeout(spark):
    # order 34747 style: create and pay in the same second still match
    rows = [(1, 0, 0, "create"), (1, 0, 1, "pay"), (2, 0, 2, "create"), (2, 901, 3, "pay")]
    df = spark.createDataFrame([(k, _ts(t), s, e) for k, t, s, e in rows],
                               "k bigint, ts timestamp, seq bigint, e string")
    out = patterns.followed_by(df, ["k"], "ts", "seq", F.col("e") == "create",
                               F.col("e") == "pay", 900)
    got = {r["k"]: (r["matched"], r["timeout_ts"]) for r in out.collect()}
    assert got == {1: (True, None), 2: (False, _ts(900))}


def test_order_status_all_classes(spark):
    rows = [(1, "create", 0), (1, "pay", 100), (2, "create", 0), (2, "pay", 1000),
            (3, "create", 0), (4, "pay", 50), (5, "refund", 9), (6, "pay", 0), (6, "create", 10)]
    df = spark.createDataFrame([(o, e, _ts(t)) for o, e, t in rows],
                               "order_id bigint, event_type string, ts timestamp")
    got = {r["order_id"]: r["status"] for r in detectors.order_status(df, limit_s=900).collect()}
    assert got == {1: "ok", 2: "paid_late", 3: "unpaid", 4: "pay_without_create",
                   5: "bad_type", 6: "ok"}


def test_daily_cap_resets_at_midnight(spark):
    base = dt.datetime(2024, 1, 1, 23, 59, 0)
    rows = [(1, 1, base + dt.timedelta(seconds=i), i) for i in range(4)] + \
           [(1, 1, dt.datetime(2024, 1, 2, 0, 0, 1), 10)]
    df = spark.createDataFrame(rows, "u bigint, ad bigint, ts timestamp, seq bigint")
    passed, alarms = detectors.daily_cap(df, ["u", "ad"], "ts", "seq", cap=2)
    assert sorted(r["seq"] for r in passed.collect()) == [0, 1, 10]
    assert [r["seq"] for r in alarms.collect()] == [2]


def test_interval_join_equals_filtered_cross_product(spark):
    import random
    rnd = random.Random(5)
    left = [(rnd.randrange(3), i, _ts(rnd.randrange(0, 20000))) for i in range(150)]
    right = [(rnd.randrange(3), i, _ts(rnd.randrange(0, 20000))) for i in range(150)]
    l = spark.createDataFrame(left, "k bigint, lid bigint, lts timestamp")
    r = spark.createDataFrame(right, "k bigint, rid bigint, rts timestamp")
    got = {(x["lid"], x["rid"]) for x in
           joins.interval_join(l, r, ["k"], "lts", "rts", -600, 300).collect()}
    exp = {(a[1], b[1]) for a in left for b in right if a[0] == b[0]
           and a[2] - dt.timedelta(seconds=600) <= b[2] <= a[2] + dt.timedelta(seconds=300)}
    assert got == exp and len(exp) > 0


def test_slice_then_expand_equals_window(spark):
    import random
    rnd = random.Random(9)
    rows = [(_ts(rnd.randrange(0, 50000)), rnd.randrange(4)) for _ in range(500)]
    df = spark.createDataFrame(rows, "ts timestamp, k bigint")
    a = windows.sliding_count(df, "ts", 600, 5, ["k"], expand="slices")
    b = windows.sliding_count(df, "ts", 600, 5, ["k"], expand="window")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sliding_count_tasks_follow_the_rows(spark, monkeypatch):
    """More rows are expanded in more tasks, not in larger ones."""
    monkeypatch.setattr(windows, "EXPANDED_ROWS", 2000)
    df = spark.range(4000).select((F.timestamp_seconds(F.col("id") * 37)).alias("ts"), (F.col("id") % 1000).alias("k"))
    out = windows.sliding_count(df, "ts", 3600, 300, ["k"])
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == out.count() and len(sizes) >= 20 and max(sizes) < 2 * 2000


def test_top_n_ties_by_key(spark):
    rows = [(_ts(3600), 5, 2), (_ts(3600), 7, 2), (_ts(3600), 1, 2), (_ts(3600), 9, 9)]
    df = spark.createDataFrame(rows, "window_end timestamp, item bigint, n bigint")
    top = topn.top_n(df, 3, "window_end", "n", ["item"])
    assert [r["item"] for r in top.orderBy("rank").collect()] == [9, 1, 5]


# ------------------------------------------------------------------ nulls, short lines, both scan directions
def test_access_log_short_line(spark):
    lines = _lines(spark, ["1.2.3.4 u - 17/05/2015:10:05:03 +0000 GET"])
    r = text.decode_access_log(lines, on_error="reject").collect()[0]
    assert r["_bad"] and r["ip"] == "1.2.3.4" and r["method"] == "GET" and r["url"] is None
    with pytest.raises(Exception, match="short access log line"):
        text.decode_access_log(lines, on_error="fail").collect()


def test_null_reading_is_not_a_missing_one(spark):
    rows = [("k", 1, 10.0), ("k", 2, None), ("k", 3, 12.0)]
    df = spark.createDataFrame(rows, "id string, t bigint, v double")
    out = rolling.change_alert(df, ["id"], [F.col("t")], "v", 5.0).orderBy("t")
    assert [(r["last_value"], r["cur_value"], r["alert"]) for r in out.collect()] == \
        [(0.0, 10.0, True), (0.0, 0.0, False), (0.0, 0.0, False)]


def test_fraction_of_a_second_is_refused():
    with pytest.raises(ValueError):
        windows.seconds(1.5)


def test_repeated_failure_refers_to_the_first(spark):
    rows = [(1, 0, 0), (1, 1, 1), (1, 5, 2), (None, 0, 3), (None, 2, 4), (2, 0, 5)]
    df = spark.createDataFrame([(u, _ts(t), s) for u, t, s in rows], "u bigint, ts timestamp, seq bigint")
    out = detectors.repeated_failure(df, ["u"], "ts", "seq", F.lit(True), 2)
    assert sorted((r["seq"], r["ref_seq"]) for r in out.collect()) == [(1, 0), (4, 3)]


def test_later_rows_frame_is_linear(spark):
    """80,000 rows of one key and hour: next value per row, in seconds."""
    import time
    df = spark.range(80_000).select(F.lit(1).alias("k"), (F.lit(_ts(0)).cast("timestamp") +
                                    F.expr("make_dt_interval(0, 0, 0, id / 30)")).alias("ts"), "id")
    start = time.time()
    out = scan.following(df, ["k"], [F.col("ts"), F.col("id")], {"nx": F.col("id")})
    assert out.where("nx = id + 1").count() == 79_999
    assert time.time() - start < 20


def test_order_job_shape(spark):
    """40 orders: pays within 15 minutes but one late and one missing, one
    receipt 3 s after its pay."""
    rows = [f"{i},create,,{1000 + i}" for i in range(40)]
    rows += [f"{i},pay,tx{i},{1010 + i + (1800 if i == 7 else 0)}" for i in range(39)]
    o = text.decode_lines(_lines(spark, rows), text.ORDER_EVENT, keep=["seq"]).withColumn(
        "ts", seconds_to_ts("event_time"))
    st = {r["order_id"]: r["status"] for r in detectors.order_status(o, limit_s=900).collect()}
    assert len(st) == 40 and {k: v for k, v in st.items() if v != "ok"} == {7: "paid_late", 39: "unpaid"}
    fb = patterns.followed_by(o, ["order_id"], "ts", "seq", F.col("event_type") == "create",
                              F.col("event_type") == "pay", 900)
    assert {r["order_id"] for r in fb.filter("NOT matched").collect()} == {7, 39}
    rc = text.decode_lines(_lines(spark, ["tx5,wechat,1018"]), text.TX_EVENT).select(
        "tx_id", seconds_to_ts("event_time").alias("rts"))
    pays = o.filter("event_type = 'pay'").select("order_id", "tx_id", F.col("ts").alias("ots"))
    j = joins.interval_join(pays, rc, ["tx_id"], "ots", "rts", -5, 5).collect()
    assert [(r["order_id"], int((r["rts"] - r["ots"]).total_seconds())) for r in j] == [(5, 3)]
