"""Registered queries: each reference workload expressed on the driver's
tables.  Every function takes (spark, sf_dir) and returns a DataFrame whose
column names match the oracle SQL in `tidemark.plans.oracle`.

Timestamps leave as TIMESTAMP_NTZ (UTC wall clock), like the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import epoch_seconds, seconds_to_ts, to_ntz
from tidemark.operators import aggregate, detectors, joins, patterns, relational, rolling, topn, windows
from tidemark.sources import text
from tidemark.sources.tables import behaviour_log, order_log, table

HOUR, FIVE_MIN = 3600, 300


def _views(spark, sf_dir) -> DataFrame:
    return behaviour_log(spark, sf_dir).filter(F.col("behavior") == "view")


def pv_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: page views per hour."""
    out = windows.tumbling_count(_views(spark, sf_dir), "ts", HOUR, name="pv")
    return out.select(to_ntz("window_start").alias("window_start"),
                      to_ntz("window_end").alias("window_end"), "pv")


def uv_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: exact unique visitors per hour."""
    out = windows.tumbling_distinct(_views(spark, sf_dir), "ts", HOUR, "user_id", name="uv")
    return out.select(to_ntz("window_start").alias("window_start"),
                      to_ntz("window_end").alias("window_end"), "uv")


def uv_sketch_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, approximate: daily unique visitors merged from hourly HLL sketches,
    held against the exact count: `within` says whether the estimate keeps to
    three standard errors of the sketch."""
    v = _views(spark, sf_dir)
    day = 24 * HOUR
    est = windows.merge_sketches(windows.sketch(v, "ts", HOUR, "user_id"), day, name="estimate")
    exact = windows.tumbling_distinct(v, "ts", day, "user_id", name="uv")
    both = exact.join(est, ["window_start", "window_end"], "left")
    off = F.abs(F.col("estimate") - F.col("uv")) <= F.ceil(F.col("uv") * windows.sketch_error())
    return both.select(to_ntz("window_start").alias("window_start"), to_ntz("window_end").alias("window_end"), "uv",
                       F.coalesce(off, F.lit(False)).alias("within"))


def value_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's aggregate class (`aggregate.ValueProfile`) per hour and
    event type, folded in every task before the shuffle."""
    out = aggregate.window_aggregate(behaviour_log(spark, sf_dir), "ts", HOUR, ["behavior"], aggregate.ValueProfile())
    return out.select("behavior", to_ntz("window_end").alias("window_end"), "n", "mean_item", "top_value", "top_seq")


def uv_whole_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6/A4: unique visitors per hour by a function over the whole window,
    fed in user order as a stream of batches."""
    out = aggregate.whole_window(_views(spark, sf_dir), "ts", HOUR, [], aggregate.distinct_in_order("user_id"), "uv bigint",
                                 ["user_id"], ["user_id"])
    return out.select(to_ntz("window_start").alias("window_start"), to_ntz("window_end").alias("window_end"), "uv")


def hop_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views per item on 1 h windows sliding by 5 min."""
    out = windows.sliding_count(_views(spark, sf_dir), "ts", HOUR, FIVE_MIN, ["item_id"],
                                name="click_count")
    return out.select("item_id", "click_count", to_ntz("window_end").alias("window_end"))


def top_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three most viewed items per window end (1 h / 5 min)."""
    top = topn.hot_keys(_views(spark, sf_dir), "ts", HOUR, FIVE_MIN, ["item_id"], n=3)
    return top.select(to_ntz("window_end").alias("window_end"), "rank", "item_id", "click_count")


def top_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three most requested pages (item) per 10 min window sliding by 5 s,
    over all requests."""
    top = topn.hot_keys(behaviour_log(spark, sf_dir), "ts", 600, 5, ["item_id"], n=3)
    return top.select(to_ntz("window_end").alias("window_end"), "rank",
                      F.col("item_id").alias("url_id"), "click_count")


def top_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hottest (province, ad) pairs per window end; province =
    event_type, ad = item (1 h / 5 min)."""
    df = behaviour_log(spark, sf_dir).select("ts", F.col("behavior").alias("province"),
                                              F.col("item_id").alias("ad_id"))
    top = topn.hot_keys(df, "ts", HOUR, FIVE_MIN, ["province", "ad_id"], n=3)
    return top.select(to_ntz("window_end").alias("window_end"), "rank", "province", "ad_id",
                      "click_count")


def top_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: the hot-item top 3 as one text block per window end."""
    top = topn.hot_keys(_views(spark, sf_dir), "ts", HOUR, FIVE_MIN, ["item_id"], n=3)
    rep = topn.report(top, ["item_id"], "click_count")
    return rep.select(to_ntz("window_end").alias("window_end"), "report")


# ---------------------------------------------------------------- words
def _docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


# Documents per chunk of the running word count: a hot word's running count
# is computed in ranges of such doc-id chunks, as many as hold about the rows
# that a task should (`scan.range_chunks`), then carried across the ranges, so
# no task holds a growing share of a hot word.
DOC_CHUNK = 4096


def wc_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch word count, each line split on single spaces (JVM
    split rule)."""
    words = relational.words_split(_docs(spark, sf_dir), "text", " ")
    return relational.word_count(words, name="cnt")


def wc_nonempty_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word count split on whitespace characters, empty tokens
    dropped (the streaming word count)."""
    words = relational.words_ws(_docs(spark, sf_dir), "text")
    return relational.word_count(words, name="cnt")


def wc_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: running total of each word after each occurrence, in (doc_id,
    position) order -- the streaming word count's per-row output."""
    words = relational.words_ws(_docs(spark, sf_dir), "text", keep=["doc_id"])
    out = relational.running_word_count(
        words, [F.col("doc_id"), F.col("pos")], name="cnt",
        chunk=F.floor(F.col("doc_id") / DOC_CHUNK))
    return out.select("doc_id", "pos", "word", "cnt")


# ---------------------------------------------------------------- decode
def line_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as delimited lines, decoded back to typed
    rows with `split` + `cast`."""
    ev = table(spark, sf_dir, "events")
    lines = ev.select(F.concat_ws(",", "event_id", "user_id", "event_type",
                                  F.col("value").cast("string"),
                                  epoch_seconds("ts").cast("string")).alias("value"))
    dec = text.decode_lines(lines, "seq bigint, user_id bigint, behavior string, value double, "
                                   "ts_s bigint")
    return dec.select("*", to_ntz(seconds_to_ts("ts_s")).alias("event_time"))


def log_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as web access-log lines, decoded back."""
    b = behaviour_log(spark, sf_dir)
    line = F.concat_ws(
        " ",
        F.concat(F.lit("10.0."), F.pmod("user_id", F.lit(256)).cast("string"), F.lit("."),
                 F.pmod("item_id", F.lit(256)).cast("string")),
        F.col("user_id").cast("string"), F.lit("-"),
        F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"),
        F.when(F.col("behavior") == "purchase", "POST").otherwise("GET"),
        F.concat(F.lit("/item/"), F.col("item_id").cast("string")))
    dec = text.decode_access_log(b.select("seq", line.alias("value")), keep=["seq"])
    return dec.select("seq", "ip", "user_id", to_ntz("event_time").alias("event_time"),
                      "method", "url")


# ---------------------------------------------------------------- relational
def select_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projection and filter by expression strings."""
    ev = table(spark, sf_dir, "events")
    out = relational.filter_expr(ev, "event_type = 'view' AND value > 25")
    return relational.select_expr(out, "event_id", "user_id", "ts", "value")


def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over a registered view."""
    ev = table(spark, sf_dir, "events")
    return relational.sql_on(spark, ev, "event_log",
                             "SELECT event_id, user_id, ts, value FROM event_log "
                             "WHERE event_type = 'click' AND value <= 25")


def split_high_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: tag readings above 30 `high`, the rest `low`; select both."""
    b = behaviour_log(spark, sf_dir).select("seq", "user_id", "value")
    tagged = relational.tag(b, [("high", F.col("value") > 30)], "low")
    return relational.select_tags(tagged, "high", "low")


def connect_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High readings -> (id, temp, warning); low readings -> (id,
    "normal"); one output."""
    b = behaviour_log(spark, sf_dir).select("seq", "user_id", "value")
    tagged = relational.tag(b, [("high", F.col("value") > 30)], "low")
    high = relational.select_tags(tagged, "high")
    low = relational.select_tags(tagged, "low")
    return relational.connect_map(
        high, low,
        lambda d: d.select("seq", F.col("user_id").alias("id"), F.col("value").alias("temp"),
                           F.lit("high temp warning").alias("msg")),
        lambda d: d.select("seq", F.col("user_id").alias("id"), F.lit("normal").alias("msg")))


def pattern_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-event rule (item 29), matches rendered as JSON."""
    b = behaviour_log(spark, sf_dir).withColumn("ts_s", epoch_seconds("ts"))
    out = relational.single_event_pattern(
        b, F.col("item_id") == 29,
        [F.col("seq"), F.col("user_id"), F.col("ts_s").alias("ts"), F.col("behavior")])
    return out.select("seq", "user_id", "match")


# ---------------------------------------------------------------- rolling
def _order():
    return [F.col("ts"), F.col("seq")]


def _log(spark, sf_dir):
    return behaviour_log(spark, sf_dir).select("seq", "ts", "user_id", "item_id", "behavior",
                                                "value")


def rolling_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, after each reading: latest time and lowest value so far."""
    out = rolling.rolling(_log(spark, sf_dir), ["user_id"], _order(),
                          {"max_ts": ("max", "ts"), "min_value": ("min", "value")})
    return out.select("user_id", "seq", to_ntz("max_ts").alias("max_ts"), "min_value")


def rolling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running sum of the readings per user (rounded to 6 places)."""
    out = rolling.rolling_sum(_log(spark, sf_dir), ["user_id"], _order(), "value")
    return out.select("user_id", "seq", F.round("running_sum", 6).alias("running_sum"))


def rolling_min_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running min; other fields from the user's first row."""
    out = rolling.rolling_min_keep_first(_log(spark, sf_dir), ["user_id"], _order(), "value",
                                         ["ts", "item_id"])
    return out.select("user_id", "seq", "min_value", to_ntz("first_ts").alias("first_ts"),
                      "first_item_id")


def rolling_min_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: the whole row holding the running min (earliest on ties)."""
    out = rolling.rolling_min_by(_log(spark, sf_dir), ["user_id"], _order(), "value",
                                 ["seq", "ts", "item_id"])
    return out.select("user_id", "seq", "min_value", "min_seq", to_ntz("min_ts").alias("min_ts"),
                      "min_item_id")


def prev_change_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """|reading - previous reading| > 10 per user (first vs 0.0)."""
    out = rolling.change_alert(_log(spark, sf_dir), ["user_id"], _order(), "value", 10.0)
    return out.select("user_id", "seq", "last_value", "cur_value")


def sustained_rise_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: first alert per run of readings that keep rising for 12 h."""
    out = patterns.sustained_rise_first(_log(spark, sf_dir), ["user_id"], "ts", "seq", "value",
                                        12 * HOUR)
    return out.select("user_id", "start_seq", to_ntz("start_ts").alias("start_ts"),
                      to_ntz("alert_ts").alias("alert_ts"))


# ---------------------------------------------------------------- joins
def _click_purchase_pairs(spark, sf_dir):
    b = behaviour_log(spark, sf_dir)
    clicks = b.filter(F.col("behavior") == "click").select(
        "user_id", F.col("seq").alias("click_seq"), F.col("ts").alias("click_ts"))
    buys = b.filter(F.col("behavior") == "purchase").select(
        "user_id", F.col("seq").alias("purchase_seq"), F.col("ts").alias("purchase_ts"))
    return joins.interval_join(clicks, buys, ["user_id"], "click_ts", "purchase_ts", -HOUR, HOUR)


def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click x purchase of the same user within +-1 h."""
    j = _click_purchase_pairs(spark, sf_dir)
    return j.select("user_id", "click_seq", "purchase_seq", to_ntz("click_ts").alias("click_ts"),
                    to_ntz("purchase_ts").alias("purchase_ts"))


def reconcile_msg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reconciliation line per J1 pair."""
    j = detectors.reconcile_message(_click_purchase_pairs(spark, sf_dir), "click_seq",
                                    "purchase_seq")
    return j.select("user_id", "click_seq", "purchase_seq", "msg")


# ---------------------------------------------------------------- patterns
def _next_errors(spark, sf_dir, keys):
    b = _log(spark, sf_dir)
    is_err = F.col("behavior") == "error"
    return patterns.next_pattern(b, keys, "ts", "seq", is_err, is_err, 6 * HOUR,
                                 fields=["user_id"])


def pattern_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: error immediately followed by error (same user) within 6 h."""
    m = _next_errors(spark, sf_dir, ["user_id"])
    return m.select(F.col("a_user_id").alias("user_id"), "a_seq", to_ntz("a_ts").alias("a_ts"),
                    "b_seq", to_ntz("b_ts").alias("b_ts"))


def pattern_next_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 unkeyed: error immediately followed by error in the whole log."""
    m = _next_errors(spark, sf_dir, [])
    return m.select("a_user_id", "a_seq", to_ntz("a_ts").alias("a_ts"),
                    "b_user_id", "b_seq", to_ntz("b_ts").alias("b_ts"))


def _view_then_purchase(spark, sf_dir):
    b = _log(spark, sf_dir)
    return patterns.followed_by(b, ["user_id"], "ts", "seq", F.col("behavior") == "view",
                                F.col("behavior") == "purchase", 24 * HOUR)


def pattern_followed_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: view followed (not necessarily next) by purchase within 1 day."""
    m = _view_then_purchase(spark, sf_dir).filter("matched")
    return m.select("user_id", "a_seq", to_ntz("a_ts").alias("a_ts"), "b_seq",
                    to_ntz("b_ts").alias("b_ts"))


def pattern_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: views with no purchase inside 1 day (the timeout side output)."""
    m = _view_then_purchase(spark, sf_dir).filter(~F.col("matched"))
    return m.select("user_id", "a_seq", to_ntz("a_ts").alias("a_ts"),
                    to_ntz("timeout_ts").alias("timeout_ts"))


# ---------------------------------------------------------------- detectors
def _fails(spark, sf_dir, mode):
    out = detectors.repeated_failure(_log(spark, sf_dir), ["user_id"], "ts", "seq",
                                     F.col("behavior") == "error", 24 * HOUR, mode=mode)
    return out.select("user_id", "seq", to_ntz("ts").alias("ts"), "ref_seq",
                      to_ntz("ref_ts").alias("ref_ts"))


def first_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: errors within 1 day of the user's first error."""
    return _fails(spark, sf_dir, "first")


def prev_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 variant: errors within 1 day of the user's previous error."""
    return _fails(spark, sf_dir, "previous")


def _cap(spark, sf_dir):
    b = _log(spark, sf_dir).select("user_id", "behavior", "seq", "ts")
    return detectors.daily_cap(b, ["user_id", "behavior"], "ts", "seq", cap=2)


def cap_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: rows passing the cap of 2 per (user, type) and UTC day."""
    passed, _ = _cap(spark, sf_dir)
    return passed.select("user_id", "behavior", "seq", to_ntz("ts").alias("ts"))


def cap_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alarm per (user, type): its first held-back row."""
    _, alarms = _cap(spark, sf_dir)
    return alarms.select("user_id", "behavior", "seq", to_ntz("ts").alias("ts"))


def cap_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: passed rows -> sliding 1 h / 5 min count per (user, type) -> top 3."""
    passed, _ = _cap(spark, sf_dir)
    rows = table(spark, sf_dir, "events").count()       # from the files' footers; no more rows than that pass
    top = detectors.capped_hot(passed, ["user_id", "behavior"], "ts", HOUR, FIVE_MIN, n=3, rows=rows)
    return top.select(to_ntz("window_end").alias("window_end"), "rank", "user_id", "behavior",
                      "click_count")


def order_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: order verdicts from orders (create) and lineitem (pay at the
    first ship date), 365-day limit."""
    out = detectors.order_status(order_log(spark, sf_dir), limit_s=365 * 24 * HOUR)
    return out.select("order_id", "status", to_ntz("create_ts").alias("create_ts"),
                      to_ntz("pay_ts").alias("pay_ts"), "delay_s")


QUERIES = {
    "pv_tumbling": pv_tumbling,
    "uv_tumbling": uv_tumbling,
    "uv_sketch_daily": uv_sketch_daily,
    "uv_whole_window": uv_whole_window,
    "value_profile": value_profile,
    "hop_count": hop_count,
    "top_items": top_items,
    "top_pages": top_pages,
    "top_ads": top_ads,
    "top_report": top_report,
    "wc_space": wc_space,
    "wc_nonempty_ws": wc_nonempty_ws,
    "wc_running": wc_running,
    "line_decode": line_decode,
    "log_decode": log_decode,
    "select_filter": select_filter,
    "sql_view": sql_view,
    "split_high_low": split_high_low,
    "connect_map": connect_map,
    "pattern_single": pattern_single,
    "rolling_reduce": rolling_reduce,
    "rolling_sum": rolling_sum,
    "rolling_min_first": rolling_min_first,
    "rolling_min_by": rolling_min_by,
    "prev_change_alert": prev_change_alert,
    "sustained_rise_first": sustained_rise_first,
    "interval_join": interval_join,
    "reconcile_msg": reconcile_msg,
    "pattern_next": pattern_next,
    "pattern_next_unkeyed": pattern_next_unkeyed,
    "pattern_followed_by": pattern_followed_by,
    "pattern_timeout": pattern_timeout,
    "first_fail": first_fail,
    "prev_fail": prev_fail,
    "cap_pass": cap_pass,
    "cap_alarm": cap_alarm,
    "cap_top": cap_top,
    "order_status": order_status,
}


def _register_streams() -> None:
    from tidemark.streaming.twins import STREAM_QUERIES
    QUERIES.update(STREAM_QUERIES)


_register_streams()
