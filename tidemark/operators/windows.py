"""Event-time window aggregates.

Counts never group by a constant key (the reference's `("pv", 1)`): they
group by the window (and the real keys) and let partial aggregation combine
rows on the map side, so a hot window costs one row per map task in the
shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cols_of

_UNITS = {"s": 1, "sec": 1, "second": 1, "seconds": 1, "m": 60, "min": 60, "minute": 60,
          "minutes": 60, "h": 3600, "hour": 3600, "hours": 3600, "d": 86400, "day": 86400,
          "days": 86400}

# Rows that a task of a sliding count expands its slices to, on average at most.
EXPANDED_ROWS = 1_000_000


def seconds(d: int | str) -> int:
    """'1 hour' / '5 minutes' / 300 -> seconds; fractions of a second are refused."""
    if isinstance(d, (int, float)):
        if d != int(d) or d <= 0:
            raise ValueError(f"a duration is a positive whole number of seconds, not {d!r}")
        return int(d)
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", d)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"bad duration {d!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def tumbling(df: DataFrame, ts: str, size, keys=(), aggs=None) -> DataFrame:
    """Tumbling event-time window; `aggs` defaults to a row count `n`.
    Output: window_start, window_end, keys..., aggregates."""
    aggs = aggs or [F.count(F.lit(1)).alias("n")]
    return window_agg(df, ts, size, None, keys, aggs)


def tumbling_count(df: DataFrame, ts: str, size, keys=(), name: str = "n") -> DataFrame:
    """A3: rows per tumbling window (page views per hour)."""
    return tumbling(df, ts, size, keys, [F.count(F.lit(1)).alias(name)])


def tumbling_distinct(df: DataFrame, ts: str, size, of: str, keys=(), name: str = "uv",
                      approx: bool = False) -> DataFrame:
    """A4: exact (or approximate) distinct values per tumbling window.

    Exact: Spark plans `count(distinct)` as a grouping on (window, value)
    first, so the distinct set is spread by value, never held by one task."""
    agg = (F.approx_count_distinct(of) if approx else F.countDistinct(of)).alias(name)
    return tumbling(df, ts, size, keys, [agg])


def sliding_count(df: DataFrame, ts: str, size, slide, keys=(), name: str = "n",
                  expand: str = "slices", rows: int | None = None) -> DataFrame:
    """Rows per sliding window and key.

    expand="slices" (batch default): count per (slide-wide slice, key) first,
    then give each slice count to the size/slide windows that contain it and
    sum.  Each input row is touched once instead of size/slide times, and a
    slice is shuffled at most twice.  The tasks that expand slices are as many
    as the rows ask for, so none holds more windows as the log grows; `rows`
    is an upper bound of the rows of `df` (default: they are counted here).
    expand="window": Spark's own `window(ts, size, slide)` (used by streams).
    Output: window_start, window_end, keys..., name."""
    size_s, slide_s = seconds(size), seconds(slide)
    keys = cols_of(keys)
    if expand == "window" or size_s % slide_s:
        w = F.window(F.col(ts), f"{size_s} seconds", f"{slide_s} seconds")
        out = df.groupBy(w.alias("window"), *keys).agg(F.count(F.lit(1)).alias(name))
        key_names = [c for c in out.columns if c not in ("window", name)]
        return out.select(F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"), *key_names, name)
    # integer epoch micros: a bigint sequence and arithmetic are cheaper than
    # a timestamp sequence with interval steps
    slide_us = slide_s * 1_000_000
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    pre = (df.groupBy((us - F.pmod(us, F.lit(slide_us))).alias("__slice"), *keys)
             .agg(F.count(F.lit(1)).alias("__n")))
    key_names = [c for c in pre.columns if c not in ("__slice", "__n")]
    # The last slices of the windows that hold a slice span less than two
    # blocks of the window's size.  Slices are dealt out by (block, key), so
    # they are expanded to windows after the exchange, and the sum per window
    # needs no other.
    size_us = size_s * 1_000_000
    low, high = F.col("__slice"), F.col("__slice") + F.lit(size_us - slide_us).cast("bigint")

    def block(us):
        return F.floor((us - F.pmod(us, F.lit(size_us).cast("bigint"))) / F.lit(size_us)).cast("bigint")

    rows = df.count() if rows is None else rows
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows * (size_s // slide_s) // EXPANDED_ROWS))
    dealt = (pre.select(F.explode(F.array_distinct(F.array(block(low), block(high)))).alias("__block"),
                        "__slice", *key_names, "__n")
             .repartition(tasks, "__block", *key_names))
    start = F.col("__block") * F.lit(size_us).cast("bigint")
    last = F.sequence(F.greatest(low, start), F.least(high, start + F.lit(size_us - slide_us).cast("bigint")),
                      F.lit(slide_us).cast("bigint"))
    exp = dealt.select("__block", F.explode(last).alias("__last"), *key_names, "__n")
    out = (exp.groupBy("__block", "__last", *key_names).agg(F.sum("__n").alias(name))
           .withColumn("__end", F.col("__last") + F.lit(slide_us).cast("bigint")))
    return out.select(F.timestamp_micros(F.col("__end") - F.lit(size_us).cast("bigint"))
                      .alias("window_start"),
                      F.timestamp_micros("__end").alias("window_end"), *key_names, name)


def window_agg(df: DataFrame, ts: str, size, slide=None, keys=(), aggs=()) -> DataFrame:
    """Any built-in aggregate columns over tumbling or sliding windows."""
    s = f"{seconds(size)} seconds"
    w = F.window(F.col(ts), s, f"{seconds(slide)} seconds") if slide else F.window(F.col(ts), s)
    out = df.groupBy(w.alias("window"), *cols_of(keys)).agg(*aggs)
    rest = [c for c in out.columns if c != "window"]
    return out.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), *rest)


def sketch(df: DataFrame, ts: str, size, of: str, keys=(), log_k: int = 12) -> DataFrame:
    """A4, approximate: window_start, window_end, keys..., sketch: an HLL
    sketch of the distinct values of `of` per tumbling window, combined on the
    map side, of at most about 2^`log_k` bytes.  Null values are not counted."""
    return tumbling(df, ts, size, keys, [F.hll_sketch_agg(F.col(of), F.lit(log_k)).alias("sketch")])


def merge_sketches(sketches: DataFrame, size, keys=(), name: str = "uv") -> DataFrame:
    """Distinct values per longer window from the sketches of shorter ones,
    without their rows: window_start, window_end, keys..., `name`.  `size`
    must be a multiple of the sketches' window.  The estimate's relative
    standard error is 1.04 / sqrt(2^log_k) (`sketch_error`)."""
    return window_agg(sketches.withColumn("__at", F.col("window_start")).drop("window_start", "window_end"), "__at", size, None, keys,
                      [F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name)])


def sketch_error(log_k: int = 12, sigmas: float = 3.0) -> float:
    """Relative error that an estimate keeps to within `sigmas` standard errors."""
    return sigmas * 1.04 / 2 ** (log_k / 2)
