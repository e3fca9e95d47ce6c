"""Near-duplicate documents by a signature-coordinate inverted join.

Every text is a set of word shingles and a MinHash signature of `COORDS`
coordinates.  A document is posted under each (coordinate, value) pair it
shares with others; two sets of similarity 0.8 agree on about four fifths of
the coordinates, so a pair is followed up only if it agrees on at least
`MATCHES` of them.  (For sets of similarity exactly 0.8 the chance of fewer
agreements is about 1e-6; it falls steeply for closer sets.)

* Equal sets are one class before anything else, so exact copies cost nothing.
* Prefix: coordinates are ordered by how many classes share the value, rarest
  first.  A class that shares s values must meet every partner among its
  s - MATCHES + 1 rarest ones, so only those are posted, and one that shares
  fewer than MATCHES is out.  Passages that thousands of texts have in common
  sit in the frequent end and are never joined on.
* Skip: inside a posting list, classes already known to be connected are not
  compared again.  First each list's hub (the class whose values are the most
  shared) meets the others, which connects a group of close copies in time
  linear in its size; what is still apart is then compared in full, by
  self-join for short lists and in blocks of bounded size for long ones.
* Counted candidates are confirmed on the full shingle sets, in long lists
  inside the block, which passes on no more links than connect its members.

The result is exact on components given the candidates: a link is left out
only if its two ends are connected anyway.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm import lists as ls
from tidemark.llm import textarrays as ta
from tidemark.llm.common import bounded_broadcast, components, saved, small_batches

COORDS, MATCHES = 64, 35
SHORT, BLOCK, BLOCK_ITEMS = 32, 4000, 2_000_000
_COEF = np.random.Generator(np.random.PCG64(77)).integers(1, 2**64, COORDS, dtype=np.uint64) | np.uint64(1)


def _batch(cols: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([cols[f.name] for f in schema], schema=schema)


def _class_id(u: np.ndarray) -> np.uint64:
    """Name of a set of shingle hashes."""
    with np.errstate(over="ignore"):
        one, two = ta.mix(u).sum(dtype=np.uint64), ta.mix(u ^ ta.MIX[50]).sum(dtype=np.uint64)
        return ta.mix(np.array([one ^ (two * ta.MIX[51]) + np.uint64(len(u))]))[0]


def _signature_rows(width: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", id_type), ("n_shingles", pa.int64()), ("cid", pa.int64()),
                            ("sig", pa.list_(pa.int64()))])
        for b in batches:
            ids = b.column(0)
            for lo, hi, data, offs in ta.pieces(b.column(1)):
                words, first = ta.word_hashes(data, offs)
                sh, bounds = ta.shingles(words, first, width)
                n = np.zeros(hi - lo, np.int64)
                cid = np.zeros(hi - lo, np.uint64)
                full = np.flatnonzero(np.diff(bounds) > 0)
                sig = np.zeros((hi - lo, COORDS), np.uint64)
                with np.errstate(over="ignore"):
                    if len(full):
                        at = bounds[full]
                        for c in range(COORDS):
                            sig[full, c] = np.minimum.reduceat(sh * _COEF[c], at)
                    for i in full:
                        u = np.unique(sh[bounds[i]:bounds[i + 1]])
                        n[i] = len(u)
                        cid[i] = _class_id(u)
                flat = pa.array(sig.view(np.int64).ravel())
                ends = pa.array(np.arange(0, (hi - lo + 1) * COORDS, COORDS, dtype=np.int32))
                yield _batch({"doc_id": ids.slice(lo, hi - lo), "n_shingles": pa.array(n),
                              "cid": pa.array(cid.view(np.int64)),
                              "sig": pa.ListArray.from_arrays(ends, flat)}, schema)
    return run


def _set_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("cid", pa.int64()), ("own", pa.int64()), ("items", pa.list_(pa.int64()))])
        for b in batches:
            cids = b.column(0)
            for lo, hi, data, offs in ta.pieces(b.column(1)):
                words, first = ta.word_hashes(data, offs)
                sh, bounds = ta.shingles(words, first, width)
                sets = [np.unique(sh[bounds[i]:bounds[i + 1]]) for i in range(hi - lo)]
                own = np.array([_class_id(u) for u in sets], np.uint64)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64)
                yield _batch({"cid": cids.slice(lo, hi - lo), "own": pa.array(own.view(np.int64)),
                              "items": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))}, schema)
    return run


def _dense(column: pa.Array, field: str, rows: np.ndarray, fill: int) -> np.ndarray:
    """Profiles (lists of c, k, o) as a table with one column a coordinate."""
    flat = column.flatten()
    out = np.full((len(column), COORDS), fill, np.int32)
    out[rows, flat.field("c").to_numpy()] = flat.field(field).to_numpy()
    return out


def _block_links(percent: int):
    """One block pair of a long list: links between different components, as
    a spanning forest.  A pair is looked at in the list of its rarest shared
    value only; that list holds every pair with enough agreements."""
    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        cid, comp, side = (t.column(c).to_numpy() for c in ("id", "comp", "side"))
        prof = t.column("prof").combine_chunks()
        rows = np.repeat(np.arange(len(prof)), np.diff(np.asarray(prof.offsets)))
        val, order = _dense(prof, "k", rows, 0), _dense(prof, "o", rows, 2**31 - 1)
        here = t.column("o").to_numpy()
        items = t.column("items").combine_chunks()
        bounds = np.asarray(items.offsets).astype(np.int64)
        bounds = bounds - bounds[0]
        n = np.diff(bounds)
        uniq, dense = np.unique(items.flatten().to_numpy(), return_inverse=True)
        flag = np.zeros(len(uniq), np.int32)
        root = np.unique(comp, return_inverse=True)[1]
        right = side != 1
        a, b = [], []
        for i in np.flatnonzero(side != 2):
            ok = right & (root != root[i])
            if side[i] == 0:
                ok[:i + 1] &= side[:i + 1] == 2
            ok &= np.minimum(n, n[i]) * 100 >= np.maximum(n, n[i]) * percent
            other = np.flatnonzero(ok)
            if not len(other):
                continue
            same = (val[other] == val[i]) & (order[i] < 2**31 - 1)
            first = np.where(same, order[i], 2**31 - 1).min(axis=1)
            other = other[(same.sum(axis=1) >= MATCHES) & (first == here[i])]
            if not len(other):
                continue
            flag[dense[bounds[i]:bounds[i + 1]]] = 1
            at = np.concatenate([np.arange(bounds[j], bounds[j + 1]) for j in other])
            begin = np.concatenate([[0], np.cumsum(n[other])[:-1]])
            common = np.add.reduceat(flag[dense[at]], begin).astype(np.int64)
            flag[dense[bounds[i]:bounds[i + 1]]] = 0
            for j in other[common * 100 >= (n[i] + n[other] - common) * percent]:
                if root[j] != root[i]:
                    root[root == root[j]] = root[i]
                    a.append(min(cid[i], cid[j]))
                    b.append(max(cid[i], cid[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _rows_schema(doc_type: str) -> str:
    return f"doc_id {doc_type}, n_shingles long, cid long, sig array<long>"


def signatures(docs: DataFrame, width: int, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, cid, sig) of every row; cid is equal for equal
    shingle sets."""
    src = docs.select(F.col(f"`{doc}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    id_type = StructType([src.schema["doc_id"]])
    arrow = pa.int64() if src.schema["doc_id"].dataType.simpleString() == "bigint" else None
    if arrow is None:
        from pyspark.sql.pandas.types import to_arrow_type
        arrow = to_arrow_type(id_type[0].dataType)
    return src.mapInArrow(_signature_rows(width, arrow), _rows_schema(id_type[0].dataType.simpleString()))


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that agree on enough coordinates and pass on full sets."""
    c = classes.select("cid", "n", "sig")
    counted = (pairs.join(c.toDF("a", "na", "sa"), "a").join(c.toDF("b", "nb", "sb"), "b")
               .where(f"least(na, nb) * 100 >= greatest(na, nb) * {percent}")
               .where(f"size(filter(zip_with(sa, sb, (x, y) -> x = y), z -> z)) >= {MATCHES}")
               .select("a", "b", "na", "nb"))
    both = (counted.join(sets.toDF("a", "ia"), "a").join(sets.toDF("b", "ib"), "b")
            .withColumn("common", F.size(F.array_intersect("ia", "ib")).cast("long")))
    return both.where(f"common * 100 >= (na + nb - common) * {percent}").select("a", "b")


def links(docs: DataFrame, sigs: DataFrame, width: int, percent: int, doc: str = "doc_id",
          text: str = "text", hub_rounds: int = 1) -> DataFrame:
    """Links (a, b) between classes that connect whatever is connected."""
    classes = (sigs.where("n_shingles > 0").groupBy("cid")
               .agg(F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.min("doc_id").alias("rep")))
    classes = saved(classes, "mh-classes")
    posted = classes.select("cid", F.posexplode("sig").alias("c", "v")).select(
        "cid", "c", F.xxhash64("c", "v").alias("key"))
    freq = posted.groupBy("key").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    shared = posted.join(freq, "key").withColumn("o", F.expr("cast(least(f, 32767) * 65536 + (key & 65535) as int)"))
    # what a class shares, at most COORDS entries, rarest first; the order is the same for all classes
    prof = shared.groupBy("cid").agg(
        F.sort_array(F.collect_list(F.struct("o", "key", "c", "f"))).alias("all"), F.sum("f").alias("score"))
    prof = saved(prof.where(f"size(all) >= {MATCHES}").select(
        F.col("cid").alias("id"), "score", F.expr(f"transform(slice(all, 1, size(all) - {MATCHES} + 1), x -> struct(x.key, x.o))").alias("prefix"),
        F.expr("transform(all, x -> named_struct('c', x.c, 'k', cast(shiftright(x.key, 32) as int), 'o', x.o))").alias("prof")), "mh-shared")
    lists = prof.select("id", "score", F.explode("prefix").alias("p")).select("p.key", "p.o", "id", "score")
    lists = lists.join(classes.select(F.col("cid").alias("id"), "n"), "id")
    size = lists.groupBy("key").agg(F.count(F.lit(1)).alias("len"), F.sum("n").alias("items")).where("len > 1")
    lists = saved(lists.join(size, "key"), "mh-lists")
    active = saved(lists.select(F.col("id").alias("cid")).distinct().join(classes, "cid"), "mh-active")
    texts = docs.select(F.col(f"`{doc}`").alias("rep"), F.col(f"`{text}`").alias("text"))
    want = bounded_broadcast(active.select("cid", "rep"))
    raw = texts.join(want, texts["rep"].eqNullSafe(want["rep"])).select("cid", "text")
    sets = raw.mapInArrow(_set_rows(width), "cid long, own long, items array<long>")
    # ids may repeat with other texts: the set must be the class's own
    sets = saved(sets.where("cid = own").select("cid", "items").dropDuplicates(["cid"]), "mh-sets")

    def far(rows: DataFrame) -> DataFrame:
        long = rows.drop("len").join(lists.select("key", "id", "o", "len", "items"), ["key", "id"])
        long = ls.block_pairs(long, f"greatest(ceil(len / {BLOCK}), ceil(items / {BLOCK_ITEMS}))").drop("items")
        full = long.join(prof.select("id", "prof"), "id").join(sets.withColumnRenamed("cid", "id"), "id")
        return full.groupBy("key", "bi", "bj").applyInArrow(_block_links(percent), "a long, b long")

    return ls.connect(lists.select("key", "id", "score", "len"), lambda pairs: _confirmed(pairs, active, sets, percent),
                      far, hub_rounds, SHORT, "mh")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, doc: str = "doc_id",
                    text: str = "text", hub_rounds: int = 1) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`.

    Texts are linked when their sets of `width`-word shingles (A-Z
    lower-cased, words between ASCII white space) have at least `percent`
    per cent in common; component_id is the smallest doc_id reachable by
    links.  A text of fewer words is one shingle; null, empty and blank texts
    have n_shingles 0 and are their own component.  Rows with a null id take
    part; they carry the smallest id of their component, or null.  Rows that
    repeat get the same result each; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    sigs = saved(signatures(docs, width, doc, text), "mh-signatures")
    found = links(docs, sigs, width, percent, doc, text, hub_rounds)
    least = sigs.where("n_shingles > 0").groupBy("cid").agg(F.min("doc_id").alias("low"))
    roots = components(found)
    named = least.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select(
        "cid", "low", F.coalesce("root", "cid").alias("root"))
    label = named.groupBy("root").agg(F.min("low").alias("component"))
    named = named.join(label, "root").select(F.col("cid").alias("k"), "component")
    out = sigs.select("doc_id", "n_shingles", "cid").join(
        named, (F.col("cid") == F.col("k")) & (F.col("n_shingles") > 0), "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component"))
                     .otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"),
                                             F.col("component_id").isNull()))


def keep_one(docs: DataFrame, doc: str = "doc_id", **options) -> DataFrame:
    """`docs` with one document of each group of near duplicates, the one
    with the smallest id; columns as they were.  Rows without an id stay."""
    gone = saved(near_duplicates(docs, doc=doc, **options).where("not kept and doc_id is not null")
                 .select(F.col("doc_id").alias("__gone")).distinct(), "mh-gone")
    return docs.join(bounded_broadcast(gone), F.col(f"`{doc}`") == F.col("__gone"), "left_anti")
