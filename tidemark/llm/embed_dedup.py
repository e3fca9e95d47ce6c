"""Near-duplicate embeddings: exact metric range join.

Vectors are scaled to length one in the tasks, where cosine >= c is the same as a chord of
at most eps = sqrt(2 - 2 c).  Within each label, pivots (a bounded number of
vectors, in hash order) partition the vectors: a vector's home is the cell of
its nearest pivot.  If x lies in cell p and has a neighbour y in cell q, then
by the triangle inequality

* x is within eps of the plane half way between p and q, so
  (x.p - x.q) / |p - q| <= eps, and
* |x - q| <= eps + the radius of cell q,

so x is copied to the cells q for which both hold, and every cell is joined
on its own: home vectors against home vectors and copies.  All neighbours of
a vector are present in its home cell, so links are counted there, once.

Equal vectors are one class with a count beforehand.  A cell is worked in
blocks of bounded size; a block gives link counts and the edges of a spanning
forest, never the pairs themselves.  Pairs within 1e-9 of the limit are decided
on the vectors as they are, so the result does not depend on the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import components, saved, small_batches

CELL, BLOCK, PIVOTS = 2000, 2048, 4096
_SLACK = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; by their largest component first, so that
    the norm neither overflows nor vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _exact(a: np.ndarray, b: np.ndarray, scaled: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows as dot / (|a| |b|), each sum taken in the
    order of the components; `scaled` where that is not finite."""
    dot, aa, bb = (np.zeros(len(a)) for _ in range(3))
    with np.errstate(all="ignore"):
        for k in range(a.shape[1]):
            dot += a[:, k] * b[:, k]
            aa += a[:, k] * a[:, k]
            bb += b[:, k] * b[:, k]
        out = dot / (np.sqrt(aa) * np.sqrt(bb))
    return np.where(np.isfinite(out) & np.isfinite(dot) & (aa > 1e-280) & (bb > 1e-280), out, scaled)


def _linked(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Table of the pairs of rows whose cosine is at least `cosine`.  The
    product of scaled rows depends on its rounding, and on the shape of the
    block, near the limit only; pairs there are worked out one by one."""
    near = _unit(a) @ _unit(b).T
    mask = near >= cosine
    i, j = np.nonzero(np.abs(near - cosine) <= _SLACK)
    for lo in range(0, len(i), 1 << 16):
        p, q = i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)]
        mask[p, q] = _exact(a[p], b[q], near[p, q]) >= cosine
    return mask


def _assign(pivots: dict[str, np.ndarray], radius: dict | None, eps: float):
    """Home cell and distance of each class (radius None), or its rows for
    all cells it belongs to."""
    def cells(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        groups = np.array(b.column(b.schema.get_field_index("g")).to_pylist(), dtype=object)
        for g in dict.fromkeys(groups):
            rows = b.take(pa.array(np.flatnonzero(groups == g)))
            x = _unit(_matrix(rows.column(rows.schema.get_field_index("vec"))))
            p = pivots.get(g)
            if p is None:                                    # a label of one cell
                dots = np.zeros((len(x), 1))
            else:
                dots = x @ p.T
            home = dots.argmax(axis=1)
            near = dots[np.arange(len(x)), home]
            if radius is None:
                dist = np.sqrt(np.maximum(0, 2 - 2 * near))
                yield pa.RecordBatch.from_arrays([rows.column(i) for i in range(4)] + [
                    pa.array(home.astype(np.int32)), pa.array(dist)],
                    names=["cid", "g", "n", "vec", "home", "dist"])
                continue
            at, to = np.arange(len(x)), home
            if p is not None:
                between = np.sqrt(np.maximum(0, 2 - 2 * (p @ p.T)))[home]
                r = np.array([radius.get((g, q), -1.0) for q in range(len(p))])
                far = (near[:, None] - dots <= eps * between + _SLACK) & (r >= 0) & (
                    np.sqrt(np.maximum(0, 2 - 2 * dots)) <= r + eps + _SLACK)
                far[at, home] = False
                i, q = np.nonzero(far)
                at, to = np.concatenate([at, i]), np.concatenate([to, q])
            out = rows.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([out.column(i) for i in range(4)] + [
                pa.array(to.astype(np.int32)), pa.array(np.arange(len(at)) < len(x))],
                names=["cid", "g", "n", "vec", "cell", "own"])

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 500):             # copies multiply the rows: keep parts small
                yield from cells(b.slice(lo, 500))
    return run


def _forest(mask: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, rows, columns) of each connected part of a bipartite link
    table."""
    out, open_rows = [], mask.any(axis=1)
    while open_rows.any():
        first = int(np.argmax(open_rows))
        rows = np.zeros(len(mask), bool)
        cols = mask[first].copy()
        rows[first] = True
        new = rows.copy()
        while True:
            new = mask[:, cols].any(axis=1) & ~rows
            if not new.any():
                break
            rows |= new
            cols |= mask[new].any(axis=0)
        open_rows &= ~rows
        out.append((first, np.flatnonzero(rows), np.flatnonzero(cols)))
    return out


def _block(cosine: float):
    def run(t: pa.Table) -> pa.Table:
        own = t.column("role").to_numpy() == 0
        vec, cid, n = _matrix(t.column("vec")), t.column("cid").to_numpy(), t.column("n").to_numpy()
        a, b, count = [], [], []
        if own.any() and not own.all():
            hid, mid = cid[own], cid[~own]
            mask = _linked(vec[own], vec[~own], cosine)
            mask &= hid[:, None] != mid[None, :]
            links = mask @ n[~own].astype(np.int64)
            some = np.flatnonzero(links)
            a, b, count = [hid[some]], [hid[some]], [links[some]]
            for first, rows, cols in _forest(mask):
                ends = np.concatenate([hid[rows], mid[cols]])
                ends = ends[ends != hid[first]]
                a.append(np.full(len(ends), hid[first]))
                b.append(ends)
                count.append(np.zeros(len(ends), np.int64))
        cat = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
        return pa.table({"a": cat(a), "b": cat(b), "links": cat(count)})
    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, key: str = "vec_id", vector: str = "embedding",
                    label: str = "label", cell: int = CELL, pivots: int = PIVOTS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `vectors`.

    Two rows are linked when their labels are equal and not null, their
    vectors have the same length and their cosine in double precision is at
    least `cosine`.  Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing.  component_id is the smallest
    key reachable by links, the row's own included.  Rows that repeat link
    with each other; a row with a null key takes part and carries the
    smallest key of its component, or null.  An empty table gives an empty
    result.

    cell: wanted vectors per cell; pivots: most pivots over all labels (they
    are held by every task).
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{label}`").cast("string").alias("l"),
                          F.col(f"`{vector}`").cast("array<double>").alias("v"))
    whole = F.expr("""l is not null and size(v) > 0 and exists(v, x -> x <> 0)
        and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))""")
    rows = rows.withColumn("g", F.when(whole, F.expr("concat(l, ':', size(v))"))).select(
        "vec_id", "g", F.expr("case when g is not null then v end").alias("vec"))
    rows = saved(rows.withColumn("cid", F.expr("case when g is not null then xxhash64(g, vec) end")), "emb-rows")
    classes = saved(rows.where("cid is not null").groupBy("cid").agg(
        F.first("g").alias("g"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec"))
        .select("cid", "g", "n", "vec"), "emb-classes")

    total = classes.count()
    share = min(1.0, pivots * cell / max(1, total))
    sizes = classes.groupBy("g").agg(F.count(F.lit(1)).alias("size")).select(
        "g", F.expr(f"cast(size * {share} / {cell} as int) + 1").alias("want")).where("want > 1")
    picked = (classes.select("g", "cid").join(sizes, "g")
              .withColumn("rk", F.row_number().over(Window.partitionBy("g").orderBy("cid")))
              .where(F.col("rk") <= pivots).where("rk <= want"))
    chosen = picked.select("cid").join(classes, "cid").select("g", "cid", "vec").collect()   # at most 2 * `pivots` rows
    by: dict[str, list] = {}
    for r in sorted(chosen, key=lambda r: (r.g, r.cid)):
        by.setdefault(r.g, []).append(r.vec)
    centre = {g: _unit(np.array(v)) for g, v in by.items()}
    eps = float(np.sqrt(2 - 2 * cosine))

    base = "cid long, g string, n long, vec array<double>"
    homes = saved(classes.mapInArrow(_assign(centre, None, eps), base + ", home int, dist double"), "emb-homes")
    cells = homes.groupBy("g", "home").agg(F.max("dist").alias("r"), F.count(F.lit(1)).alias("home_n"))
    radius = {(r.g, r.home): r.r for r in cells.where(F.col("g").isin(list(centre))).collect()} if centre else {}
    copies = saved(homes.select("cid", "g", "n", "vec").mapInArrow(
        _assign(centre, radius, eps), base + ", cell int, own boolean"), "emb-cells")
    size = copies.groupBy("g", "cell").agg(
        F.expr(f"cast(ceil(sum(cast(own as int)) / {BLOCK}) as int)").alias("nh"),
        F.expr(f"cast(ceil(count(1) / {BLOCK}) as int)").alias("nm"), F.count(F.lit(1)).alias("all_n"))
    placed = copies.join(size.where("all_n > 1"), ["g", "cell"])
    side = "array_repeat(named_struct('role', 0, 'bi', 0, 'bj', 0), 0)"
    placed = placed.withColumn("at", F.explode(F.expr(f"""concat(
        case when own then transform(sequence(0, nm - 1), j -> named_struct('role', 0, 'bi', cast(pmod(xxhash64(cid, 1), nh) as int), 'bj', j)) else {side} end,
        transform(sequence(0, nh - 1), i -> named_struct('role', 1, 'bi', i, 'bj', cast(pmod(xxhash64(cid, 2), nm) as int))))""")))
    parts = placed.select("g", "cell", "at.*", "cid", "n", "vec").groupBy("g", "cell", "bi", "bj").applyInArrow(
        _block(cosine), "a long, b long, links long")
    parts = saved(parts, "emb-links")
    count = parts.where("a = b").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    roots = components(parts.where("a <> b").select("a", "b")).withColumnRenamed("node", "cid")
    low = rows.where("cid is not null").groupBy("cid").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"))
    named = (low.join(count, "cid", "left").join(roots, "cid", "left")
             .select("cid", "low", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("root", "cid").alias("root")))
    comp = named.groupBy("root").agg(F.min("low").alias("component"))
    named = named.join(comp, "root").select("cid", "n_links", "component")
    out = rows.select("vec_id", "cid").join(named, "cid", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                     F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
