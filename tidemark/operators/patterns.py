"""Event-sequence rules (K1-K5) as ordered window computations.

Rows of a key are ordered by (event time, arrival number).  Every rule is a
fixed shape of the reference's pattern API:

  next(a, b, within)          b is the very next event after a (strict
                              contiguity), and b.ts - a.ts < within
  followed_by(a, b, within)   b is the first b-event after a (relaxed
                              contiguity), and b.ts - a.ts < within; an a
                              without such b times out at a.ts + within
  sustained_rise(interval)    a rise starts a timer, a fall cancels it; the
                              timer fires `interval` after the rise

All per-key scans use `scan.running`, so a hot key (or no key at all) is
cut into chunks of rows instead of one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cols_of
from tidemark.operators import scan


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _within(a_ts: Column, b_ts: Column, within_s: int) -> Column:
    return (_micros(b_ts) - _micros(a_ts)) < F.lit(int(within_s) * 1_000_000)


def next_pattern(df: DataFrame, keys, ts: str, seq: str, first: Column, second: Column,
                 within_s: int, fields=(), **kw) -> DataFrame:
    """K2: `begin(first).next(second).within(within_s)`.

    keys=[] applies the rule to the whole stream (adjacency across all keys,
    as the reference's unkeyed login rule does); the scan then cuts the
    whole stream into chunks of rows.
    Output: one row per match with `a_*` (first event) and `b_*` (second)."""
    keys = cols_of(keys)
    fields = list(fields)
    rec = F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq"), first.alias("ok"),
                   *[F.col(f).alias(f) for f in fields])
    base = df.select("*", rec.alias("__rec"))
    prev = scan.previous(base, keys, [F.col(ts), F.col(seq)], {"__a": F.col("__rec")}, **kw)
    m = prev.filter(second & F.col("__a.ok") & _within(F.col("__a.ts"), F.col(ts), within_s))
    return m.select(*[F.col(f"__a.{f}").alias(f"a_{f}") for f in ["seq", "ts"] + fields],
                    *[F.col(f).alias(f"b_{f}") for f in [seq, ts] + fields])


def followed_by(df: DataFrame, keys: list[str], ts: str, seq: str, first: Column, second: Column,
                within_s: int, **kw) -> DataFrame:
    """K3/K4: `begin(first).followedBy(second).within(within_s)`.

    For every `first` event: the first later `second` event of the same key.
    Output per `first` event: key columns, a_seq, a_ts, b_seq, b_ts (null if
    none), matched (bool), timeout_ts (a_ts + within when not matched)."""
    keys = list(keys)
    key_names = [f"__key{i}" for i in range(len(keys))]
    base = df.select(*[F.col(k).alias(n) for k, n in zip(keys, key_names)], F.col(ts).alias("__ts"),
                     F.col(seq).alias("__seq"), first.alias("__is_a"), second.alias("__is_b"))
    nxt = scan.running(base, [F.col(n) for n in key_names], [F.col("__ts"), F.col("__seq")],
                       {"__b": ("first", F.when(F.col("__is_b"), F.struct(
                           F.col("__ts").alias("ts"), F.col("__seq").alias("seq"))))},
                       frame="after", **kw)
    a = nxt.filter(F.col("__is_a"))
    hit = F.col("__b").isNotNull() & _within(F.col("__ts"), F.col("__b.ts"), within_s)
    return a.select(*[F.col(n).alias(k) for n, k in zip(key_names, keys)],
                    F.col("__seq").alias("a_seq"), F.col("__ts").alias("a_ts"),
                    F.when(hit, F.col("__b.seq")).alias("b_seq"),
                    F.when(hit, F.col("__b.ts")).alias("b_ts"),
                    F.coalesce(hit, F.lit(False)).alias("matched"),
                    F.when(~F.coalesce(hit, F.lit(False)),
                           F.col("__ts") + F.expr(f"INTERVAL {int(within_s)} SECONDS"))
                     .alias("timeout_ts"))


def sustained_rise_first(df: DataFrame, keys: list[str], ts: str, seq: str, of: str, interval_s: int,
                         initial: float = 0.0, **kw) -> DataFrame:
    """K5, first alert of each run: readings are cut into runs by falls
    (a reading below the previous one).  In a run the first rise (a reading
    above the previous one; the first reading is compared with `initial`)
    starts a timer; it fires at start + interval unless the next fall comes
    at or before that time.  A null reading is neither a rise nor a fall, and
    nor is the reading after it.  Output: key columns, start_seq, start_ts,
    alert_ts.

    Repeated alerts inside one run need the timer state machine: see
    `tidemark.streaming.stateful.RiseTimer`."""
    names = list(keys)
    order = [F.col(ts), F.col(seq)]
    prev = scan.previous(df.select(*names, ts, seq, of), names, order,
                         {"__last": F.struct(F.col(of).alias("v"))}, **kw)
    last = F.when(F.col("__last").isNull(), F.lit(float(initial))).otherwise(F.col("__last.v"))
    marked = scan.materialize(
        prev.select(*names, ts, seq, (F.col(of) > last).alias("__rise"),
                    (F.col(of) < last).alias("__fall")), "rise-marks")
    runs = scan.running(marked, names, order,
                        {"__run": ("sum", F.col("__fall").cast("int"), "upto"),
                         "__next_fall": ("first", F.when(F.col("__fall"), F.col(ts)), "after")},
                        **kw)
    starts = (runs.filter("__rise")
                  .groupBy(*names, "__run")
                  .agg(F.min_by(F.struct(F.col(seq).alias("seq"), F.col(ts).alias("ts"),
                                         F.col("__next_fall").alias("nf")),
                                F.struct(*order)).alias("s")))
    alert_ts = F.col("s.ts") + F.expr(f"INTERVAL {int(interval_s)} SECONDS")
    fired = F.col("s.nf").isNull() | (F.col("s.nf") > alert_ts)
    return starts.filter(fired).select(*names, F.col("s.seq").alias("start_seq"),
                                       F.col("s.ts").alias("start_ts"), alert_ts.alias("alert_ts"))
