"""Keyed event-time interval join.

    right.ts in [left.ts + lower, left.ts + upper]   (both ends inclusive)

Joining on the key alone makes every left row of a key meet every right row
of the key: a hot key gives a quadratic task.  We add a time bucket of width
`upper - lower` to the equi-join key: a left row is copied to the (at most
two) buckets its range touches, a right row sits in its own bucket, then the
exact bounds are checked.  Pairs per task are then bounded by the rows of
one key inside one bucket.  Spark picks the physical join (AQE may turn it
into a broadcast when one side is small at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import bucket_number


def interval_join(left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str,
                  lower_s: int, upper_s: int) -> DataFrame:
    """Inner join.  Columns of both sides are kept; give them distinct names
    first (except the `on` keys, which appear once)."""
    if lower_s > upper_s:
        raise ValueError("lower bound above upper bound")
    width = max(upper_s - lower_s, 1)
    lo = F.col(left_ts) + F.expr(f"INTERVAL {int(lower_s)} SECONDS")
    hi = F.col(left_ts) + F.expr(f"INTERVAL {int(upper_s)} SECONDS")
    lb = left.withColumn("__b", F.explode(F.sequence(bucket_number(lo, width),
                                                     bucket_number(hi, width))))
    rb = right.withColumn("__b", bucket_number(F.col(right_ts), width))
    l_lo = lb[left_ts] + F.expr(f"INTERVAL {int(lower_s)} SECONDS")
    l_hi = lb[left_ts] + F.expr(f"INTERVAL {int(upper_s)} SECONDS")
    cond = [lb[k] == rb[k] for k in on] + [lb["__b"] == rb["__b"],
                                           rb[right_ts] >= l_lo, rb[right_ts] <= l_hi]
    j = lb.join(rb, cond)
    keep = [lb[k].alias(k) for k in on] + \
        [lb[c] for c in left.columns if c not in on] + \
        [rb[c] for c in right.columns if c not in on]
    return j.select(*keep)
