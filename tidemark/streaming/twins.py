"""Streaming forms of the windowed, join and keyed-state workloads.

Each function reads the driver's table as a file stream, runs the same
operator as its batch twin on Structured Streaming (watermark, state store,
checkpoint in the shared checkpoint folder), drains it and then the flush
row that ends the input, and returns the committed output as a DataFrame with
the batch twin's columns.  The batch twin's oracle SQL therefore checks the
stream too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import event_time, to_ntz
from tidemark.operators import detectors, joins, relational, windows
from tidemark.session import scratch_path
from tidemark.sources.tables import behaviour_from
from tidemark.streaming import stateful
from tidemark.streaming.run import EndOfInput, keep, run_stream, run_to_table, run_to_tables, stream_table
from tidemark.streaming.upsert import read_upserts, upsert_writer

HOUR, FIVE_MIN = 3600, 300


def _state_partitions(spark: SparkSession) -> int:
    """State partitions of a registered twin: `tidemark.stream.partitions`, by
    default one per core of the cluster.  They are fixed for the life of a
    checkpoint and AQE does not coalesce them, so a long-running stream should
    set them for the state it will hold."""
    return int(spark.conf.get("tidemark.stream.partitions", str(spark.sparkContext.defaultParallelism)))


def _buckets(spark: SparkSession) -> int:
    """Groups that the very many keys of the daily cap are dealt to:
    `tidemark.stream.buckets`, by default 1024; like the state partitions they
    are fixed for the life of a checkpoint."""
    return int(spark.conf.get("tidemark.stream.buckets", "1024"))


def _drain(df: DataFrame, name: str, end: EndOfInput | None = None) -> DataFrame:
    return run_to_table(df, name, partitions=_state_partitions(df.sparkSession), end=end)


def behaviour_stream(spark: SparkSession, sf_dir: str, end: EndOfInput, delay: str = "0 seconds",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    return end.attach(behaviour_from(stream_table(spark, sf_dir, "events", max_files_per_trigger)), "ts", delay)


def _views(spark, sf_dir, end):
    return behaviour_stream(spark, sf_dir, end).filter(keep(F.col("behavior") == "view"))


def _ntz_window(df):
    return df.select(to_ntz("window_start").alias("window_start"),
                     to_ntz("window_end").alias("window_end"),
                     *[c for c in df.columns if c not in ("window_start", "window_end")])


def stream_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 on a stream: hourly page views, emitted when the hour closes."""
    end = EndOfInput(spark)
    out = _drain(windows.tumbling_count(_views(spark, sf_dir, end), "ts", HOUR, name="pv"),
                 "stream_pv", end)
    return _ntz_window(out)


def stream_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 on a stream: `count(distinct)` is not allowed on streams, so the
    (window, user) pairs are de-duplicated first (state per pair, evicted by
    the watermark) and then counted per window."""
    end = EndOfInput(spark)
    v = _views(spark, sf_dir, end).select(F.window("ts", f"{HOUR} seconds").alias("window"),
                                     "user_id", "ts")
    pairs = v.dropDuplicates(["window", "user_id"])
    out = pairs.groupBy("window").agg(F.count(F.lit(1)).alias("uv"))
    res = _drain(out.select(F.col("window.start").alias("window_start"),
                                  F.col("window.end").alias("window_end"), "uv"),
                 "stream_uv", end)
    return _ntz_window(res)


def stream_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 on a stream: views per item on 1 h windows sliding by 5 min."""
    end = EndOfInput(spark)
    counts = windows.sliding_count(_views(spark, sf_dir, end), "ts", HOUR, FIVE_MIN, ["item_id"],
                                   name="click_count", expand="window")
    out = _drain(counts, "stream_hop", end)
    return out.select("item_id", "click_count", to_ntz("window_end").alias("window_end"))


def top_of_windows(counts: DataFrame, keys: list[str], score: str, n: int = 3, salts: int = 16) -> DataFrame:
    """T1-T3 on a stream of closed window counts (window, keys..., score):
    (window_end, rank, keys..., score) of the n best per window.

    `row_number` is not allowed on streams.  Per (window end, salt of the keys)
    a heap of n rows is kept in typed state and emitted by an event-time timer
    (`TopOfWindow`), so a busy window is spread over `salts` groups and no
    state holds its keys; the salts' salts * n candidates are then ranked by a
    window aggregate.  Order: score descending, then keys ascending."""
    types = {f.name: f.dataType.simpleString() for f in counts.schema.fields}
    rows = counts.select(F.col("window.end").alias("window_end"), F.window_time("window").alias("at"), *keys, F.col(score).alias("score"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int"))
    best = rows.groupBy("window_end", "salt").transformWithState(
        statefulProcessor=stateful.TopOfWindow(n, keys, [types[k] for k in keys]),
        outputStructType=f"window_end timestamp, score bigint, {', '.join(f'{k} {types[k]}' for k in keys)}",
        outputMode="Append", timeMode="EventTime", eventTimeColumnName="window_end")
    cand = F.struct((-F.col("score")).alias("neg"), *keys)
    ranked = best.groupBy("window_end").agg(F.slice(F.sort_array(F.collect_list(cand)), 1, n).alias("top"))
    top = ranked.select("window_end", F.posexplode("top").alias("pos", "e"))
    return top.select("window_end", (F.col("pos") + 1).alias("rank"), *[F.col(f"e.{k}").alias(k) for k in keys],
                      (-F.col("e.neg")).alias(score))


def stream_top(spark: SparkSession, sf_dir: str, n: int = 3, salts: int | None = None) -> DataFrame:
    """T1 on a stream: three most viewed items per window end (1 h / 5 min).
    `salts`: groups that a window is spread over, by default the setting
    `tidemark.stream.salts` or 2; more for windows of very many keys."""
    salts = salts or int(spark.conf.get("tidemark.stream.salts", "2"))
    end = EndOfInput(spark)
    w = F.window("ts", f"{HOUR} seconds", f"{FIVE_MIN} seconds")
    counts = _views(spark, sf_dir, end).groupBy(w.alias("window"), "item_id").agg(F.count(F.lit(1)).alias("click_count"))
    out = _drain(top_of_windows(counts, ["item_id"], "click_count", n, salts), "stream_top", end)
    return out.select(to_ntz("window_end").alias("window_end"), F.col("rank").cast("int"),
                      "item_id", "click_count")


def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 on streams: stream-stream inner join with watermarks on both sides
    and the time bounds in the condition, so join state is dropped once the
    watermark passes `ts + 1 h`.  The equi-key includes the time bucket, so
    a hot user's join state is spread over buckets."""
    clicks = (behaviour_from(stream_table(spark, sf_dir, "events"))
              .filter(F.col("behavior") == "click")
              .select("user_id", F.col("seq").alias("click_seq"), F.col("ts").alias("click_ts"))
              .withWatermark("click_ts", "1 hour"))
    buys = (behaviour_from(stream_table(spark, sf_dir, "events"))
            .filter(F.col("behavior") == "purchase")
            .select("user_id", F.col("seq").alias("purchase_seq"),
                    F.col("ts").alias("purchase_ts"))
            .withWatermark("purchase_ts", "1 hour"))
    # the batch operator, bucketed by time, runs unchanged on the two streams
    j = joins.interval_join(clicks, buys, ["user_id"], "click_ts", "purchase_ts", -HOUR, HOUR)
    out = _drain(j.select("user_id", "click_seq", "purchase_seq",
                          "click_ts", "purchase_ts"), "stream_interval_join")
    return out.select("user_id", "click_seq", "purchase_seq",
                      to_ntz("click_ts").alias("click_ts"),
                      to_ntz("purchase_ts").alias("purchase_ts"))


def stream_prev_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N1 on a stream: value state per user (`ChangeAlert`)."""
    end = EndOfInput(spark)
    s = behaviour_stream(spark, sf_dir, end)
    out = stateful.apply(s, ["user_id"], stateful.ChangeAlert(["user_id"], 10.0),
                         "seq bigint, ts_us bigint, last_value double, cur_value double")
    res = _drain(out, "stream_prev_change", end)
    return res.select("user_id", "seq", "last_value", "cur_value")


def _cap_stream(spark, sf_dir) -> dict[str, DataFrame]:
    """Both outputs of the daily cap, from one run."""
    end = EndOfInput(spark)
    s = behaviour_stream(spark, sf_dir, end)
    out = stateful.apply(s, ["user_id", "behavior"],
                         stateful.DailyCap(["user_id", "behavior"], cap=2),
                         "output string, seq bigint, ts_us bigint", fields=(), buckets=_buckets(spark))
    both = run_to_tables(out, "output", ["pass", "alarm"], "stream_cap", partitions=_state_partitions(spark), end=end)
    return {o: t.select("user_id", "behavior", "seq", to_ntz(F.timestamp_micros("ts_us")).alias("ts")) for o, t in both.items()}


def stream_cap_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 on a stream: rows passing the daily cap (main output)."""
    return _cap_stream(spark, sf_dir)["pass"]


def stream_cap_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7/U2 on a stream: the alarm side output."""
    return _cap_stream(spark, sf_dir)["alarm"]


def stream_cap_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main and side output of the daily cap, filled by one run."""
    both = _cap_stream(spark, sf_dir)
    return both["pass"].withColumn("output", F.lit("pass")).unionByName(both["alarm"].withColumn("output", F.lit("alarm")))


def order_status_stream(events: DataFrame, limit_s: int, retention_s: int) -> DataFrame:
    """K9 on a watermarked stream (order_id, event_type, ts): one verdict per
    order, once nothing has come for it for `limit_s` + `retention_s`; then its
    state is gone.  An order's events are a session with that gap, so a late
    pay within the retention still makes it `paid_late`.  All in the JVM; for
    verdicts at once, and corrections of them, see `stateful.OrderStatus`."""
    gap = F.session_window("ts", f"{limit_s + retention_s} seconds")
    first = lambda kind: F.min(F.when(F.col("event_type") == kind, F.col("ts")))
    s = events.groupBy(gap.alias("session"), "order_id").agg(first("create").alias("create_ts"), first("pay").alias("pay_ts"))
    return s.select("order_id", *detectors.verdict("create_ts", "pay_ts", limit_s), "create_ts", "pay_ts")


def stream_order_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 on a stream: creates from the `orders` stream, pays from the
    `lineitem` stream (each line is a pay event; the earliest counts)."""
    end = EndOfInput(spark)
    creates = stream_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), event_time("o_orderdate").alias("ts"), F.lit("create").alias("event_type"))
    pays = stream_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), event_time("l_shipdate").alias("ts"), F.lit("pay").alias("event_type"))
    s = end.attach(creates.unionByName(pays), "ts")
    year = 365 * 24 * HOUR      # in these tables creates and pays of an order lie years apart, in either order
    res = _drain(order_status_stream(s, year, 10 * year), "stream_order_status", end)
    return res.select("order_id", "status", to_ntz("create_ts").alias("create_ts"), to_ntz("pay_ts").alias("pay_ts"), "delay_s")


def stream_rise_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 on a stream, every alert (a run of rises can alert more than once):
    `RiseTimer` with an event-time timer per user, 12 h."""
    end = EndOfInput(spark)
    s = behaviour_stream(spark, sf_dir, end)
    out = stateful.apply(s, ["user_id"], stateful.RiseTimer(["user_id"], 12 * HOUR),
                         "start_us bigint, alert_us bigint")
    res = _drain(out, "stream_rise_alerts", end)
    return res.select("user_id", to_ntz(F.timestamp_micros("start_us")).alias("start_ts"),
                      to_ntz(F.timestamp_micros("alert_us")).alias("alert_ts"))


def _followed_by_stream(spark, sf_dir) -> dict[str, DataFrame]:
    """Matches and timeouts of the rule, from one run."""
    end = EndOfInput(spark)
    s = behaviour_stream(spark, sf_dir, end)
    s = s.select("user_id", "ts", "seq",
                 F.when(F.col("behavior") == "view", "a")
                  .when(F.col("behavior") == "purchase", "b").alias("kind"))
    out = stateful.apply(s, ["user_id"], stateful.FollowedBy(["user_id"], 24 * HOUR),
                         "output string, a_seq bigint, a_us bigint, b_seq bigint, b_us bigint")
    return run_to_tables(out, "output", ["match", "timeout"], "stream_followed_by", partitions=_state_partitions(spark), end=end)


def stream_followed_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 on a stream: view followed by purchase of the same user within a
    day (`FollowedBy` processor, pending views in state)."""
    res = _followed_by_stream(spark, sf_dir)["match"]
    return res.select("user_id", "a_seq", to_ntz(F.timestamp_micros("a_us")).alias("a_ts"),
                      "b_seq", to_ntz(F.timestamp_micros("b_us")).alias("b_ts"))


def stream_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 on a stream: the timeout side output, emitted at view + 1 day."""
    res = _followed_by_stream(spark, sf_dir)["timeout"]
    return res.select("user_id", "a_seq", to_ntz(F.timestamp_micros("a_us")).alias("a_ts"),
                      to_ntz(F.timestamp_micros("b_us")).alias("timeout_ts"))


def stream_pattern_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches and timeouts, filled by one run."""
    both = _followed_by_stream(spark, sf_dir)
    return both["match"].withColumn("output", F.lit("match")).unionByName(
        both["timeout"].withColumn("output", F.lit("timeout"))).select(
        "user_id", "output", "a_seq", "b_seq", to_ntz(F.timestamp_micros("b_us")).alias("ts"))


def stream_pattern_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 on a stream: error immediately followed by error of the same user
    within 6 h (`NextPattern`)."""
    end = EndOfInput(spark)
    err = F.coalesce(F.col("behavior") == "error", F.lit(False))
    s = behaviour_stream(spark, sf_dir, end, "1 hour").select("user_id", "ts", "seq", err.alias("is_first"), err.alias("is_second"))
    out = stateful.apply(s, ["user_id"], stateful.NextPattern(["user_id"], 6 * HOUR),
                         "a_seq bigint, a_us bigint, b_seq bigint, b_us bigint")
    res = _drain(out, "stream_pattern_next", end)
    return res.select("user_id", "a_seq", to_ntz(F.timestamp_micros("a_us")).alias("a_ts"),
                      "b_seq", to_ntz(F.timestamp_micros("b_us")).alias("b_ts"))


def stream_first_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 on a stream: errors within a day of the user's first error
    (`RepeatedFailure` processor)."""
    end = EndOfInput(spark)
    s = behaviour_stream(spark, sf_dir, end).filter(keep(F.col("behavior") == "error"))
    out = stateful.apply(s, ["user_id"], stateful.RepeatedFailure(["user_id"], 24 * HOUR),
                         "seq bigint, ts_us bigint, ref_seq bigint, ref_us bigint")
    res = _drain(out, "stream_first_fail", end)
    return res.select("user_id", "seq", to_ntz(F.timestamp_micros("ts_us")).alias("ts"),
                      "ref_seq", to_ntz(F.timestamp_micros("ref_us")).alias("ref_ts"))


def stream_wc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2/S3 on a stream: word totals over a file stream of documents (split
    on whitespace characters, empty tokens dropped).  Runs in update mode: each
    micro-batch writes only the words whose total changed (`upsert`)."""
    docs = stream_table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = relational.word_count(relational.words_ws(docs, "text"), name="cnt")
    path = scratch_path(spark, "out-stream_wc")
    q = run_stream(counts, "stream_wc", mode="update", partitions=_state_partitions(spark),
                   each_batch=upsert_writer(path, counts.schema, ["word"]))
    q.awaitTermination()
    return read_upserts(spark, path, counts.schema, ["word"])


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly views of a stream with the account of its late rows.  The
    watermark is ascending and the table is read in one go, so here every row
    is kept; planted late rows are in the tests."""
    end = EndOfInput(spark)
    out = stateful.count_with_late(_views(spark, sf_dir, end), HOUR)
    both = run_to_tables(out, "output", ["count", "late"], "stream_late", partitions=_state_partitions(spark), end=end)
    kept = both["count"].groupBy("start_us").agg(F.sum("n").alias("kept"))
    late = both["late"].groupBy("start_us").agg(F.count(F.lit(1)).alias("late"))
    res = kept.join(late, "start_us", "full")
    return res.select(to_ntz(F.timestamp_micros("start_us")).alias("window_start"), F.coalesce("kept", F.lit(0)).alias("kept"),
                      F.coalesce("late", F.lit(0)).alias("late"))


STREAM_QUERIES = {
    "stream_pv": stream_pv,
    "stream_uv": stream_uv,
    "stream_hop": stream_hop,
    "stream_top": stream_top,
    "stream_interval_join": stream_interval_join,
    "stream_prev_change": stream_prev_change,
    "stream_cap_pass": stream_cap_pass,
    "stream_cap_alarm": stream_cap_alarm,
    "stream_cap_outputs": stream_cap_outputs,
    "stream_pattern_outputs": stream_pattern_outputs,
    "stream_order_status": stream_order_status,
    "stream_rise_alerts": stream_rise_alerts,
    "stream_wc": stream_wc,
    "stream_late": stream_late,
    "stream_followed_by": stream_followed_by,
    "stream_timeout": stream_timeout,
    "stream_pattern_next": stream_pattern_next,
    "stream_first_fail": stream_first_fail,
}

# batch twin whose oracle SQL the stream result must equal
BATCH_TWIN = {
    "stream_pv": "pv_tumbling",
    "stream_uv": "uv_tumbling",
    "stream_hop": "hop_count",
    "stream_top": "top_items",
    "stream_interval_join": "interval_join",
    "stream_prev_change": "prev_change_alert",
    "stream_cap_pass": "cap_pass",
    "stream_cap_alarm": "cap_alarm",
    "stream_order_status": "order_status",
    "stream_wc": "wc_nonempty_ws",
    "stream_followed_by": "pattern_followed_by",
    "stream_timeout": "pattern_timeout",
    "stream_pattern_next": "pattern_next",
    "stream_first_fail": "first_fail",
}
