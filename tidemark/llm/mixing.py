"""Mixing sources to target weights by Pfair scheduling.

The documents of each source are cut into blocks of `block` documents in a
hashed order.  Time is a row of slots, one block each.  A source of weight w
gets its i-th block released at slot floor(i / w) and due by slot
ceil((i + 1) / w); serving the released block with the earliest deadline
keeps every source within one block of w times the slots gone by.

Releases and deadlines come from the exact weights (floats as fractions,
integer arithmetic), so the bound holds against the target itself however
long the input is.  Only blocks that exist are scheduled: a source that has run
out leaves its later slots empty, so the others keep their relative weights,
and every row is placed exactly once.  Leaving blocks out of a schedule that
can be kept leaves one that can be kept, so no deadline is missed.  The driver
works out one row a block (not a document), and every row finds its slot by an
equi-join on (source, block).

With a `period`, weights are rounded to multiples of 1/period instead and the
schedule repeats every `period` slots; the bound then holds against the rounded
weights only.
"""

from __future__ import annotations

import heapq
import math
from array import array
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BINS = 1 << 16
BROADCAST = 500_000


def quotas(weights: dict[str, float], period: int) -> dict[str, int]:
    """Slots per period by source: largest remainders of the weights, and one
    slot at least, taken from the sources furthest above their weight.
    Sources of weight 0 or less are an error, as is a period with fewer slots
    than sources."""
    if not weights:
        return {}
    if min(weights.values()) <= 0:
        raise ValueError("target weights must be positive")
    if period < len(weights):
        raise ValueError("the period has fewer slots than there are sources")
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    over = [(out[s] - exact[s], s) for s in weights]
    heapq.heapify(over)
    for _ in range(period - sum(out.values())):
        x, s = over[0]
        out[s] += 1
        heapq.heapreplace(over, (x + 1, s))
    over = [(exact[s] - q, s) for s, q in out.items() if q > 1]
    heapq.heapify(over)
    while sum(out.values()) > period:
        x, s = heapq.heappop(over)
        out[s] -= 1
        if out[s] > 1:
            heapq.heappush(over, (x + 1, s))
    return out


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """Integers in exactly the proportions of the weights."""
    if weights and not (min(weights.values()) > 0 and math.isfinite(sum(weights.values()))):
        raise ValueError("target weights must be positive")
    parts = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in parts.values()))
    return {s: int(x * scale) for s, x in parts.items()}


def block_slots(weights: dict[str, float], blocks: dict[str, int]) -> tuple[list[str], array, array, array]:
    """(sources, source number, block, slot) of the blocks 0 .. blocks[s] - 1 of
    every source: the released block with the earliest deadline first, slots
    with no block released skipped."""
    names = sorted(s for s in blocks if blocks[s] > 0)
    part = whole_weights(weights)
    total = sum(part.values())
    own = [part[s] for s in names]
    todo = [blocks[s] for s in names]
    at = [0] * len(names)
    src, blk, slots = array("q"), array("q"), array("q")
    later, ready, slot = [(0, k) for k in range(len(names))], [], 0
    while later or ready:
        if not ready and later[0][0] > slot:
            slot = later[0][0]
        while later and later[0][0] <= slot:
            release, k = heapq.heappop(later)
            heapq.heappush(ready, (-(-(at[k] + 1) * total // own[k]), -release, k))
        due, _, k = heapq.heappop(ready)
        if due < slot + 1:
            raise AssertionError("deadline missed")
        src.append(k)
        blk.append(at[k])
        slots.append(slot)
        at[k] += 1
        if at[k] < todo[k]:
            heapq.heappush(later, (at[k] * total // own[k], k))
        slot += 1
    return names, src, blk, slots


def period_slots(quota: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, index of the block in the period, slot): earliest deadline
    first among released blocks; equal deadlines go by the later release
    (the tighter window), then by source.  Integer arithmetic throughout."""
    period = sum(quota.values())
    by_release: dict[int, list] = {}
    for s, q in quota.items():
        for i in range(q):
            due = -(-(i + 1) * period // q)
            by_release.setdefault(i * period // q, []).append((due, -(i * period // q), s, i))
    out, ready = [], []
    for slot in range(period):
        for job in by_release.get(slot, ()):
            heapq.heappush(ready, job)
        due, _, s, i = heapq.heappop(ready)
        if due < slot + 1:
            raise AssertionError("deadline missed")
        out.append((s, i, slot))
    return out


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block: int = 64, period: int | None = None,
        source: str = "source", power: float = 0.5, seed: int = 17) -> DataFrame:
    """`docs` with mix_block (block number within the source), mix_slot (the
    block's slot) and mix_order (slot * block + place in the block): reading
    the rows by mix_order gives the mixture.

    weights: target weight by source; without it, a source weighs its number
    of rows to the power `power`.  A source without a given weight is an
    error.  Null is a source of its own, named '' in `weights`.  All rows
    stay, once each; equal rows keep their places by an arbitrary tie.  Up to
    the end of a source its blocks keep within one block of its target weight
    times the slots gone by; with a `period` (raised to four slots a source if
    it is shorter), of its rounded weight.  An empty table stays empty.
    Columns of docs with the three new names are replaced.

    The place of a row in its source is found without sorting a source in
    one task: rows fall into hash bins, bin totals (a bounded number per
    source) give each bin its first place, and rows are ordered inside bins.
    """
    spark = docs.sparkSession
    new = ("mix_block", "mix_slot", "mix_order")
    keep = [c for c in docs.columns if c not in new]
    cols = [F.col(f"`{c}`") for c in keep]
    src = F.coalesce(F.col(f"`{source}`").cast("string"), F.lit(""))
    keyed = docs.select(F.struct(*cols).alias("row"), src.alias("src"),
                        F.xxhash64(*cols, F.lit(seed)).alias("h"))
    keyed = keyed.withColumn("bin", F.shiftright(F.col("h"), 48))   # BINS values, ordered as h
    bins = keyed.groupBy("src", "bin").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["src"]: r["n"] for r in keyed.groupBy("src").agg(F.count(F.lit(1)).alias("n")).collect()}
    if weights is None:
        weights = {s: n ** power for s, n in sizes.items()}
    elif missing := sorted(set(sizes) - set(weights)):
        raise ValueError(f"no weight for {missing[:5]}")
    weights = {s: float(weights[s]) for s in sizes}
    # running totals in two levels, 256 coarse bins of 256: no task sees more than 256 rows of a source at once
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    coarse = F.shiftright(F.col("bin"), 8)
    start = (bins.groupBy("src", coarse.alias("bin")).agg(F.sum("n").alias("n"))
             .select("src", F.col("bin").alias("c"), F.coalesce(F.sum("n").over(before.partitionBy("src")), F.lit(0)).alias("base")))
    first = (bins.withColumn("c", coarse)
             .withColumn("own", F.coalesce(F.sum("n").over(before.partitionBy("src", "c")), F.lit(0)))
             .join(start, ["src", "c"]).select("src", "bin", (F.col("base") + F.col("own")).alias("first")))
    placed = (keyed.withColumn("rn", F.row_number().over(Window.partitionBy("src", "bin").orderBy("h")))
              .join(first, ["src", "bin"])
              .withColumn("at", F.col("first") + F.col("rn") - 1)
              .withColumn("blk", F.expr(f"at div {int(block)}")))
    if period is None:
        names, part, blk, slot = block_slots(weights, {s: -(-n // block) for s, n in sizes.items()})
        number = F.broadcast(spark.createDataFrame(list(enumerate(names)), "part long, src string"))
        # one row a block; marked for broadcast only while it is small
        slots = spark.createDataFrame(pa.table({c: pa.array(x, pa.int64()) for c, x in
                                                (("part", part), ("blk", blk), ("slot", slot))}))
        out = placed.join(number, "src").join(F.broadcast(slots) if len(slot) <= BROADCAST else slots, ["part", "blk"])
    else:
        quota = quotas(weights, max(period, 4 * len(sizes)))
        total = sum(quota.values())
        slots = F.broadcast(spark.createDataFrame(period_slots(quota), "src string, i long, t long"))
        q = F.broadcast(spark.createDataFrame(sorted(quota.items()), "src string, q long"))
        out = placed.join(q, "src").withColumn("i", F.expr("blk % q")).join(slots, ["src", "i"]).withColumn(
            "slot", F.expr("blk div q") * total + F.col("t"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], F.col("blk").alias("mix_block"),
                      F.col("slot").alias("mix_slot"),
                      (F.col("slot") * block + F.expr(f"at % {int(block)}")).alias("mix_order"))
