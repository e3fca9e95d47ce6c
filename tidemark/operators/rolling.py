"""Rolling (per-row running) aggregates and the previous-value alert
(A7-A10, N1, H2, H3).  Each row gets the value of the aggregate over all
rows of its key up to and including it, in (event time, arrival) order.

All go through `scan.running`, so a hot key is split into chunks of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import col_of, cols_of
from tidemark.operators import scan


def rolling(df: DataFrame, keys, order, aggs: dict[str, tuple[str, str | Column]],
            **kw) -> DataFrame:
    """Rolling reduce given as {out: (kind, column)}, kinds as in
    `scan.running` (sum, count, min, max, first, last)."""
    return scan.running(df, keys, order, {n: (k, col_of(c)) for n, (k, c) in aggs.items()},
                        frame="upto", **kw)


def rolling_sum(df: DataFrame, keys, order, of: str, name: str = "running_sum", **kw) -> DataFrame:
    """Running sum of one field."""
    return rolling(df, keys, order, {name: ("sum", of)}, **kw)


def rolling_min_keep_first(df: DataFrame, keys, order, of: str, others: list[str],
                           prefix: str = "first_", name: str = "min_value", **kw) -> DataFrame:
    """Running min of `of`; the other fields stay those of the key's
    first row (the reference's `min(field)`)."""
    aggs = {name: ("min", F.col(of))}
    aggs.update({prefix + o: ("first", F.struct(F.col(o).alias("v"))) for o in others})
    out = rolling(df, keys, order, aggs, **kw)
    return out.select(*df.columns, name, *[F.col(f"{prefix}{o}.v").alias(prefix + o) for o in others])


def rolling_min_by(df: DataFrame, keys, order, of: str, fields: list[str],
                   prefix: str = "min_", **kw) -> DataFrame:
    """A10: the whole row holding the running min of `of`; on ties the
    earliest row wins (struct order: value, then the order columns)."""
    order_cols = cols_of(order)
    rec = F.struct(F.col(of).alias("__v"), *[c.alias(f"__o{i}") for i, c in enumerate(order_cols)],
                   *[F.col(f).alias(f) for f in fields])
    out = rolling(df, keys, order, {"__minrec": ("min", rec)}, **kw)
    return out.select(*df.columns, F.col("__minrec.__v").alias(prefix + of),
                      *[F.col(f"__minrec.{f}").alias(prefix + f) for f in fields])


def change_alert(df: DataFrame, keys, order, of: str, threshold: float,
                 initial: float | None = 0.0, **kw) -> DataFrame:
    """Compare each reading with the key's previous one (the first with
    `initial`, default 0.0 as in the reference).  If |cur - last| >
    threshold emit (last, cur), else (0.0, 0.0).  One output per input.
    A null reading raises no alert and is the previous reading of the next
    row, which raises none either."""
    prev = scan.previous(df, keys, order, {"__last": F.struct(F.col(of).alias("v"))}, **kw)
    last = F.col("__last.v")
    if initial is not None:
        last = F.when(F.col("__last").isNull(), F.lit(float(initial))).otherwise(last)
    hit = F.abs(F.col(of) - last) > F.lit(float(threshold))
    return prev.select(*df.columns,
                       F.when(hit, last).otherwise(F.lit(0.0)).alias("last_value"),
                       F.when(hit, F.col(of)).otherwise(F.lit(0.0)).alias("cur_value"),
                       F.coalesce(hit, F.lit(False)).alias("alert"))
