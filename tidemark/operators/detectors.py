"""Detectors built on keyed state in the reference (K6-K10), as batch
DataFrame plans.  The streaming forms live in `tidemark.streaming.stateful`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import day_start
from tidemark.operators import scan, topn

_US = 1_000_000


def _gap_us(a: Column, b: Column) -> Column:
    return F.abs(F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp")))


def repeated_failure(df: DataFrame, keys: list[str], ts: str, seq: str, is_fail: Column,
                     max_gap_s: int, mode: str = "first", **kw) -> DataFrame:
    """K6: among a key's failures (in (ts, seq) order), alert on each later
    failure whose time differs by at most `max_gap_s` from
      mode="first"    the key's first failure (the reference: its state holds
                      the first failure and is never replaced), or
      mode="previous" the key's previous failure.
    Output: keys, seq, ts, ref_seq, ref_ts."""
    fails = df.filter(is_fail).select(*keys, ts, seq)
    ref = F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq"))
    order = [F.col(ts), F.col(seq)]
    if mode == "first":
        # one row per key with a map-side combined minimum, joined back; the
        # key's first failure is not its own predecessor
        low = fails.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
            F.min(F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq"))).alias("__r"))
        same = F.lit(True)
        for i, k in enumerate(keys):
            same &= F.col(k).eqNullSafe(F.col(f"__k{i}"))
        out = fails.join(low, same).where(F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq")) > F.col("__r"))
    elif mode == "previous":
        out = scan.previous(fails, keys, order, {"__r": ref}, **kw)
    else:
        raise ValueError(mode)
    hit = F.col("__r").isNotNull() & (_gap_us(F.col("__r.ts"), F.col(ts)) <= F.lit(max_gap_s * _US))
    return out.filter(hit).select(*keys, seq, ts, F.col("__r.seq").alias("ref_seq"),
                                  F.col("__r.ts").alias("ref_ts"))


def daily_cap(df: DataFrame, keys: list[str], ts: str, seq: str, cap: int,
              alarm_scope: str = "lifetime") -> tuple[DataFrame, DataFrame]:
    """K7: per key and UTC day, the first `cap` rows pass; later ones are
    held back.  One alarm per key at its first held-back row
    (alarm_scope="lifetime", the reference's never-cleared flag) or one per
    key and day (alarm_scope="day").  Returns (passed rows, alarms).

    Only the first `cap` + 1 rows of a key and day matter, so the row number
    is filtered by that bound: Spark then keeps at most `cap` + 1 rows per
    key, day and task before the one exchange (`WindowGroupLimit`), and a
    click-abuse key ships no more than that."""
    day = day_start(F.col(ts))
    base = df.withColumn("__day", day)
    w = Window.partitionBy(*keys, "__day").orderBy(F.col(ts), F.col(seq))
    numbered = base.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= cap + 1)
    passed = numbered.filter(F.col("__n") <= cap).drop("__n", "__day")
    over = numbered.filter(F.col("__n") == cap + 1)
    scope = keys + (["__day"] if alarm_scope == "day" else [])
    rec = F.struct(*[F.col(c).alias(c) for c in df.columns])
    alarms = (over.groupBy(*scope)
                  .agg(F.min_by(rec, F.struct(F.col(ts), F.col(seq))).alias("__a"))
                  .select(*[F.col(f"__a.{c}").alias(c) for c in df.columns]))
    return passed, alarms


def capped_hot(passed: DataFrame, keys: list[str], ts: str, size, slide, n: int = 3,
               rows: int | None = None) -> DataFrame:
    """K8: sliding count of the passed rows per key, then the top n per
    window end (the reference leaves this step empty).  `rows`: upper bound of
    the passed rows, which saves counting them."""
    return topn.hot_keys(passed, ts, size, slide, keys, n=n, rows=rows)


def order_status(events: DataFrame, order_id: str = "order_id", event_type: str = "event_type",
                 ts: str = "ts", limit_s: int = 15 * 60) -> DataFrame:
    """K9: one verdict per order from its create and pay events, whatever
    their arrival order:
      ok                  pay - create <= limit (a pay before the create
                          counts as ok, as in the reference)
      paid_late           pay - create > limit
      unpaid              create without pay
      pay_without_create  pay without create
      bad_type            neither a create nor a pay event
    Per order the earliest create and earliest pay count.  A single grouped
    aggregate: partial aggregation runs map-side, one exchange by order.
    Output: order_id, status, create_ts, pay_ts, delay_s."""
    t = F.col(ts).cast("timestamp")
    g = events.groupBy(order_id).agg(
        F.min(F.when(F.col(event_type) == "create", t)).alias("create_ts"),
        F.min(F.when(F.col(event_type) == "pay", t)).alias("pay_ts"))
    return g.select(order_id, *verdict("create_ts", "pay_ts", limit_s), "create_ts", "pay_ts").select(
        order_id, "status", "create_ts", "pay_ts", "delay_s")


def verdict(create: str, pay: str, limit_s: int) -> list[Column]:
    """K9: status and delay_s from an order's create and pay time."""
    delay = F.unix_seconds(pay) - F.unix_seconds(create)
    status = (F.when(F.col(create).isNotNull() & F.col(pay).isNotNull(),
                     F.when(delay > limit_s, "paid_late").otherwise("ok"))
               .when(F.col(create).isNotNull(), "unpaid")
               .when(F.col(pay).isNotNull(), "pay_without_create")
               .otherwise("bad_type"))
    return [status.alias("status"), delay.alias("delay_s")]


def bad_events(events: DataFrame, known=("create", "pay"), event_type: str = "event_type") -> DataFrame:
    """K9: every event of a type that is not `known` (a null type is not)."""
    return events.where(~F.coalesce(F.col(event_type).isin(*known), F.lit(False)))


def reconcile_message(joined: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """Text line for each interval-join pair."""
    return joined.withColumn("msg", F.concat(F.lit("order "), F.col(left_id).cast("string"),
                                             F.lit(" reconciled with "),
                                             F.col(right_id).cast("string")))

