"""Top-N per window and the window report.

`row_number() <= n` over `partitionBy(window_end)` is planned by Spark as a
`WindowGroupLimit`: each map task keeps only its own best n rows per window
before the exchange, so even a window holding a third of all counts ships n
rows per task.  Ties are broken by the key columns, ascending.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import cols_of, render_ts
from tidemark.operators.windows import sliding_count


def top_n(counts: DataFrame, n: int = 3, by: str = "window_end", score: str = "n",
          keys=(), rank: str = "rank") -> DataFrame:
    """Keep the n best rows per `by` value, ordered by `score` desc then keys."""
    keys = cols_of(keys)
    w = Window.partitionBy(by).orderBy(F.col(score).desc(), *[k.asc() for k in keys])
    return (counts.withColumn(rank, F.row_number().over(w))
                  .filter(F.col(rank) <= n))


def hot_keys(df: DataFrame, ts: str, size, slide, keys, n: int = 3,
             score: str = "click_count", expand: str = "slices", rows: int | None = None) -> DataFrame:
    """Sliding count per key, then the n hottest keys per window end.
    `rows`: see `sliding_count`."""
    counts = sliding_count(df, ts, size, slide, keys, name=score, expand=expand, rows=rows)
    return top_n(counts, n, "window_end", score, keys)


def report(top: DataFrame, keys, score: str = "click_count", by: str = "window_end",
           rank: str = "rank") -> DataFrame:
    """T4: one text block per window end: a header line, then one line per
    ranked key.  At most n rows per window are collected (bounded)."""
    keys = [k for k in keys]
    key_txt = F.concat_ws(" ", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])
    line = F.concat(F.lit("No"), F.col(rank).cast("string"), F.lit(": "), key_txt,
                    F.lit(f" {score}="), F.col(score).cast("string"))
    g = top.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(F.col(rank).alias("r"),
                                                                  line.alias("t")))).alias("__l"))
    text = F.concat_ws("\n", F.concat(F.lit("window end: "), render_ts(F.col(by))),
                       F.array_join(F.transform("__l", lambda x: x["t"]), "\n"))
    return g.select(by, text.alias("report"))
