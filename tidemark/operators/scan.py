"""Skew-safe running aggregates over an ordered, keyed log.

A plain `Window.partitionBy(key).orderBy(ts)` sends every row of a key to
one task; if one key holds a third of the log, one task holds a third of the
data.  `running` cuts the rows of such keys into ordered chunks of about equal
numbers of rows, so the big window is partitioned by `(key, chunk)`:

1. rows per key are counted; a key with more rows than a chunk may hold is
   hot, and split points are taken from its rows (`row_chunks`).  Without a
   hot key the plain window is all there is
2. window inside each `(key, chunk)`                  rows shuffled once, by (key, chunk)
3. one summary row per `(hot key, chunk)`             partial aggregation, tiny shuffle
4. prefix (or suffix) of the summaries per hot key    at most 2 * `MOST_CHUNKS` rows in all
5. broadcast join of 4 to 2 on `(key, chunk)`, then combine

Chunks are balanced by rows, not by time, so a burst is cut as finely as its
rows ask for, and a sparse key is one chunk however long its history.  A
caller may give the chunks instead (`chunk`); then there is a summary for each
`(key, chunk)` and the carry is joined by shuffle.  With `hot_only` the given
chunks only serve to cut the hot keys (`range_chunks`).  The result equals the
plain window for every supported aggregate.

Frames: "upto" (all earlier rows and this one), "before" (earlier rows only),
"from" (this row and all later ones), "after" (later rows only).

Aggregate kinds: sum, count, min, max, first (first non-null value in the
frame), last (last non-null value in the frame).  `lag`-like access is
`last` of a `struct`, which is never null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import cols_of

_CHUNK = "__chunk"
_W = Window

# A chunk holds `LEAST_ROWS` rows, or more where that would make over
# `MOST_CHUNKS` full chunks of the log: as many tasks as a cluster can use, and
# the bound of what is broadcast.  Split points come from `PER_CHUNK` sampled
# rows a chunk.
LEAST_ROWS, MOST_CHUNKS, PER_CHUNK = 10_000, 16_384, 64
_FAN = 128              # split points are searched in two steps of about this many


def _within(kind: str, c: Column, w) -> Column:
    if kind == "sum":
        return F.sum(c).over(w)
    if kind == "count":
        return F.count(c).over(w)
    if kind == "min":
        return F.min(c).over(w)
    if kind == "max":
        return F.max(c).over(w)
    if kind == "first":
        return F.first(c, ignorenulls=True).over(w)
    if kind == "last":
        return F.last(c, ignorenulls=True).over(w)
    raise ValueError(f"unknown aggregate kind {kind!r}")


def _summary(kind: str, c: Column, order_key: Column) -> Column:
    """Aggregate of a whole chunk (grouped; partial aggregation applies)."""
    if kind in ("sum", "count", "min", "max"):
        return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[kind](c)
    ok = F.when(c.isNotNull(), order_key)
    if kind == "first":
        return F.min_by(c, ok)
    return F.max_by(c, ok)


def _over(kind: str, c: Column, part: list, order: list[Column], frame: str) -> Column:
    """Aggregate over a frame.  Frames of later rows run over the reversed
    order, because Spark grows a frame that starts at the partition's end row
    by row but recomputes one that ends there for every row."""
    if frame in _REVERSED:
        kind, frame = _SWAPPED.get(kind, kind), _REVERSED[frame]
        order = [o.desc() for o in order]
    return _within(kind, c, _W.partitionBy(*part).orderBy(*order).rowsBetween(*_FRAMES[frame]))


def _combine(kind: str, inner: Column, carried: Column, forward: bool) -> Column:
    if kind == "count":
        return inner + F.coalesce(carried, F.lit(0))
    if kind == "sum":
        return (F.when(inner.isNull(), carried)
                 .when(carried.isNull(), inner)
                 .otherwise(inner + carried))
    if kind == "min":
        return F.least(inner, carried)
    if kind == "max":
        return F.greatest(inner, carried)
    # first / last: the nearer side wins
    near_is_inner = (kind == "last") != forward
    return F.coalesce(inner, carried) if near_is_inner else F.coalesce(carried, inner)


_FRAMES = {"upto": (_W.unboundedPreceding, _W.currentRow),
           "before": (_W.unboundedPreceding, -1)}
# Frames of later rows, as frames of the reversed order.
_REVERSED = {"from": "upto", "after": "before"}
_SWAPPED = {"first": "last", "last": "first"}

# How summaries of earlier (later) chunks combine, as a running aggregate.
_CARRY_KIND = {"sum": "sum", "count": "sum", "min": "min", "max": "max",
               "first": "first", "last": "last"}


def row_chunks(base: DataFrame, key: str, order: list[Column], rows: int | None = None,
               name: str = _CHUNK) -> tuple[DataFrame, DataFrame | None]:
    """(`base` with the chunk of every row, hot keys): the rows of a key with
    more than `rows` rows are cut in `order` at split points sampled from
    them (a hash of the order columns decides, so the sample is the same each
    time); chunk 0 is the whole of any other key.  Counts and split points are
    worked out here, by aggregations of the input; hot keys is None if there
    are none, else a table (key, points) of at most `MOST_CHUNKS` rows."""
    sizes = base.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total, most = sizes.agg(F.sum("__n"), F.max("__n")).first()
    rows = rows or max(LEAST_ROWS, -(-(total or 0) // MOST_CHUNKS))
    if (most or 0) <= rows:
        return base.withColumn(name, F.lit(0).cast("bigint")), None
    at = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    rate = max(1, rows // PER_CHUNK)
    hot = F.broadcast(sizes.where(F.col("__n") > rows).select(key))                 # at most total / rows keys
    sampled = (base.select(key, at.alias("__at")).join(hot, key)
               .where(F.pmod(F.xxhash64("__at"), F.lit(rate)) == 0)
               .groupBy(key).agg(F.sort_array(F.collect_set("__at")).alias("__s")))   # about PER_CHUNK a chunk
    step = max(1, rows // rate)
    points = sampled.select(key, F.expr(f"""transform(sequence(0, cast((size(__s) - 1) div {step} as int)),
        i -> __s[cast(i * {step} as int)])""").alias("__p"))
    # two levels, so that a row is compared with two short lists
    points = materialize(points.select(key, F.expr(f"""transform(sequence(0, cast((size(__p) - 1) div {_FAN} as int)),
        i -> slice(__p, i * {_FAN} + 1, {_FAN}))""").alias("__points")), "split-points")
    out = base.withColumn("__at", at).join(F.broadcast(points), key, "left")
    head = F.expr("size(filter(__points, b -> b[0] <= __at))")
    out = out.withColumn("__head", F.when(F.col("__points").isNotNull(), head).otherwise(0))
    chunk = F.expr(f"""case when __head = 0 then 0L else
        (__head - 1L) * {_FAN} + size(filter(__points[__head - 1], p -> p <= __at)) end""")
    return out.withColumn(name, chunk.cast("bigint")).drop("__at", "__head", "__points"), points


def range_chunks(base: DataFrame, key: str, given: str, summaries: dict[str, tuple[Column, Column]],
                 rows: int | None = None, name: str = _CHUNK) -> tuple[DataFrame, DataFrame | None]:
    """(`base` with the chunk of every row, summaries of the hot keys' chunks):
    like `row_chunks`, by the whole numbers `given` that do not decrease along
    the order.  A key with more than `rows` rows is cut into ranges of them, as
    wide as holds about `rows` of its rows on average (a null comes first);
    chunk 0 is the whole of any other key.  `summaries` gives for each name the
    aggregate of rows, and how aggregates merge along `given`.  One pass over the
    input counts rows and summarises them by (key, given); what belongs to hot
    keys is written, and makes at most `MOST_CHUNKS` ranges and two more a hot key."""
    each = base.groupBy(key, given).agg(F.count(F.lit(1)).alias("__r"), *[a.alias(n) for n, (a, _) in summaries.items()])
    of_key = _W.partitionBy(key)
    each = each.select("*", F.sum("__r").over(of_key).alias("__n"))
    many = materialize(each.where(F.col("__n") > (rows or LEAST_ROWS)), "hot-keys")
    held = many.agg(F.sum("__r")).first()[0] or 0
    rows = rows or max(LEAST_ROWS, -(-held // MOST_CHUNKS))
    hot = many.where(F.col("__n") > rows)
    if hot.isEmpty():
        return base.withColumn(name, F.lit(0).cast("bigint")), None
    wide = hot.groupBy(key).agg(F.sum("__r").alias("__n"), F.min(given).alias("__lo"), F.max(given).alias("__hi")).select(
        key, F.expr("coalesce(__lo, 0)").alias("__lo"),
        F.expr(f"coalesce(greatest(1, cast(ceil((__hi - __lo + 1) * {rows}D / __n) as bigint)), 1)").alias("__wide"))
    chunk = F.expr(f"case when __wide is null then 0 else coalesce(({given} - __lo) div __wide, -1) end").cast("bigint")

    def cut(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(wide), key, "left").withColumn(name, chunk).drop("__lo", "__wide")
    return cut(base), cut(hot).groupBy(key, name).agg(*[m.alias(n) for n, (_, m) in summaries.items()])


def running(df: DataFrame, keys, order, aggs: dict[str, tuple],
            frame: str = "upto", chunk: Column | None = None,
            chunk_rows: int | None = None, carry_fanout: int | None = None, hot_only: bool = False) -> DataFrame:
    """Add one column per entry of `aggs` ({name: (kind, column)} or
    {name: (kind, column, frame)}), computed over the rows of the same key in
    `order` with the entry's frame (default `frame`).  Several aggregates and
    frames share one pass.

    By default a key with more than `chunk_rows` rows (default: see
    `LEAST_ROWS`) is cut into chunks of about as many.  `chunk` gives the
    chunks instead; it must not decrease along `order` within a key.
    `carry_fanout`: when a key can have very many chunks (chunks that do not
    grow with time, such as id ranges), carry across chunks with a second
    level of this scan over groups of `carry_fanout` chunks.
    `hot_only`: the given chunks (whole numbers) cut only keys with more rows
    than `chunk_rows`, into ranges of chunks; all others need no carry.
    """
    keys = cols_of(keys)
    order = cols_of(order)
    specs = {n: (a[0], a[1], a[2] if len(a) > 2 else frame) for n, a in aggs.items()}

    # One non-null key column: a struct of the keys (struct equality treats
    # null fields as equal, so null keys group and join like `<=>`).  Plain
    # equality on the very columns the window is partitioned by lets a
    # sort-merge carry join reuse that partitioning: only the small carry
    # table is shuffled for the join.
    # A single key that is never null needs no struct.
    kcol = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]) if keys else F.lit(0)
    back = dict.fromkeys(df.columns)
    if len(keys) == 1 and not (own := df.select(keys[0]).schema[0]).nullable:
        kcol = keys[0]
        if own.name in back:
            back[own.name] = F.col("__key").alias(own.name)     # the column is shuffled once
    columns = [b if b is not None else c for c, b in back.items()]
    part = [F.col("__key"), F.col(_CHUNK)]
    hot = None
    if chunk is None:
        base, hot = row_chunks(df.select("*", kcol.alias("__key")), "__key", order, chunk_rows)
    elif hot_only:
        order_key, along = F.struct(*order), F.col("__given")
        base, hot = range_chunks(
            df.select("*", kcol.alias("__key"), chunk.alias("__given")), "__key", "__given",
            {f"__s_{n}": (_summary(k, c, order_key), _summary(_CARRY_KIND[k], F.col(f"__s_{n}"), F.struct(along)))
             for n, (k, c, _) in specs.items()}, chunk_rows)
        base = base.drop("__given")
    else:
        base = df.select("*", kcol.alias("__key"), chunk.alias(_CHUNK))
    inner = base.select("*", *[_over(k, c, part, order, f).alias(f"__in_{n}")
                               for n, (k, c, f) in specs.items()])

    if (chunk is None or hot_only) and hot is None:
        return inner.select(*columns, *[F.col(f"__in_{n}").alias(n) for n in specs])

    order_key = F.struct(*order)
    # Summaries are aggregated from the input, not from the windowed branch:
    # map-side partial aggregation then ships one row per (key, chunk) and
    # task.  (Catalyst prunes the two branches to different columns, so they
    # could not share one exchange anyway.)  The price is a second, pruned
    # read of the input; chained scans should `materialize` in between.
    if hot_only:
        summ = hot
    else:
        cut = base if hot is None else base.join(F.broadcast(hot.select("__key")), "__key", "left_semi")
        summ = (cut.groupBy(*part)
                    .agg(*[_summary(k, c, order_key).alias(f"__s_{n}")
                           for n, (k, c, _) in specs.items()]))
    if carry_fanout:
        # The carry over a key's chunks is itself a running aggregate, ordered
        # by chunk: compute it with this scan one level up, in groups of
        # `carry_fanout` chunks, so a key with very many chunks is spread too.
        lower = summ.withColumnRenamed("__key", "__lkey").withColumnRenamed(_CHUNK, "__lchunk")
        up = running(lower, [F.col("__lkey")], [F.col("__lchunk")],
                     {f"__p_{n}": (_CARRY_KIND[k], F.col(f"__s_{n}"),
                                   "after" if f in ("from", "after") else "before")
                      for n, (k, _, f) in specs.items()},
                     chunk=F.floor(F.col("__lchunk") / carry_fanout), carry_fanout=None)
        carried = up.select(F.col("__lkey").alias("__ckey"), F.col("__lchunk").alias("__cchunk"),
                            *[f"__p_{n}" for n in specs])
    else:
        carried = summ.select(
            F.col("__key").alias("__ckey"), F.col(_CHUNK).alias("__cchunk"),
            *[_over(_CARRY_KIND[k], F.col(f"__s_{n}"), ["__key"], [F.col(_CHUNK)],
                    "after" if f in ("from", "after") else "before")
              .alias(f"__p_{n}") for n, (k, _, f) in specs.items()])

    if hot is not None:
        carried = F.broadcast(carried)              # at most 2 * MOST_CHUNKS rows: full chunks and a rest a key
    joined = inner.join(carried, (F.col("__key") == F.col("__ckey")) &
                        (F.col(_CHUNK) == F.col("__cchunk")), "left")
    out = joined.select(
        *columns,
        *[_combine(k, F.col(f"__in_{n}"), F.col(f"__p_{n}"), f in ("from", "after")).alias(n)
          for n, (k, _, f) in specs.items()])
    return out


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write an intermediate result to the shared checkpoint folder
    (`spark.checkpoint.dir`) and read it back: later stages that read it
    more than once (as `running` does) do not recompute its lineage, and a
    lost executor does not send the job back past this point."""
    from tidemark.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def previous(df: DataFrame, keys, order, cols: dict[str, Column], **kw) -> DataFrame:
    """`lag(c, 1)` per key for each {name: column} (null for the first row);
    skew-safe through `running`."""
    aggs = {f"__prev_{n}": ("last", F.struct(c.alias("v"))) for n, c in cols.items()}
    out = running(df, keys, order, aggs, frame="before", **kw)
    return out.select(*df.columns, *[F.col(f"__prev_{n}.v").alias(n) for n in cols])


def following(df: DataFrame, keys, order, cols: dict[str, Column], **kw) -> DataFrame:
    """`lead(c, 1)` per key for each {name: column}; skew-safe."""
    aggs = {f"__next_{n}": ("first", F.struct(c.alias("v"))) for n, c in cols.items()}
    out = running(df, keys, order, aggs, frame="after", **kw)
    return out.select(*df.columns, *[F.col(f"__next_{n}.v").alias(n) for n in cols])


def row_number(df: DataFrame, keys, order, name: str = "n", **kw) -> DataFrame:
    """1-based position of each row within its key; skew-safe."""
    return running(df, keys, order, {name: ("count", F.lit(1))}, frame="upto", **kw)
