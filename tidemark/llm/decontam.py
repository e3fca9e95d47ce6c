"""Benchmark decontamination: which documents hold (most of) a test item.

Containment search with MinHash: every shingle is hashed once, and an item is
represented by its smallest hash values.  Items are partitioned by size (the
power of two of their number of shingles); all items of a partition share one
sketch size, chosen so that an item of any size in it that is contained to
the threshold must leave at least one sketch value in the document: with n
shingles and threshold t, at most n - ceil(t n) are missing, so one more than
that are enough.  The search is therefore without loss, at a sketch of about
a fifth of each item.  Documents are long and are not sketched: their hashes
probe the posted sketches, and the share of sketch values found estimates the
containment.  Candidates are verified on the shingles themselves.

Only built-in column functions and equi-joins are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_broadcast, saved


def words(text: Column) -> Column:
    """Lower-case (A-Z) words between ASCII white space; null and blank
    texts have none."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_strings(w: str, width: str) -> Column:
    """Distinct shingles of `width` words as strings (SQL names of the word
    array and the width)."""
    return F.expr(f"""case when size({w}) >= {width} then array_distinct(transform(
        sequence(0, size({w}) - {width}), i -> array_join(slice({w}, i + 1, {width}), ' '))) end""")


def items_of(benchmark: DataFrame, item: str = "item_id", text: str = "text", width: int = 5) -> DataFrame:
    """(item_id, width, n, shingles): items without words are left out; an
    item of fewer than `width` words is searched as one shingle of all its
    words.  Rows with equal id and text count once."""
    w = benchmark.select(F.col(item).alias("item_id"), words(F.col(text)).alias("w")).distinct()
    w = w.where("size(w) > 0").withColumn("width", F.least(F.size("w"), F.lit(width)))
    return (w.select("item_id", "width", shingle_strings("w", "width").alias("shingles"))
            .withColumn("n", F.size("shingles").cast("long")))


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """(width, h, item_id, n, k): the k smallest hashes of each item, k set
    by the item's size partition."""
    top = F.pow(F.lit(2.0), F.floor(F.log2(F.col("n"))) + 1) - 1       # largest size of the partition
    k = F.least(F.col("n"), top - F.ceil(top * threshold - 1e-9) + 1).cast("int")
    s = items.withColumn("k", k).withColumn(
        "sketch", F.expr("slice(array_sort(array_distinct(transform(shingles, s -> xxhash64(s)))), 1, k)"))
    return s.select("item_id", "width", "n", "k", F.explode("sketch").alias("h"))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, width: int = 5,
                 doc: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment) for each document
    that contains at least `threshold` of the item's distinct shingles of
    `width` words.  Null, empty and too short texts contain nothing; rows
    with the same id count as one document when any of them qualifies (the
    largest n_found is given); a null id is an id like others.  Empty tables
    give an empty result."""
    items = items_of(benchmark, item, item_text, width)
    posted = sketches(items, threshold)
    widths = [r[0] for r in items.select("width").distinct().collect()]      # at most `width` values
    base = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    found = None
    for wd in sorted(widths):
        hashed = base.select("doc_id", words(F.col("text")).alias("w")).select(
            "doc_id", F.expr(f"""case when size(w) >= {wd} then transform(sequence(0, size(w) - {wd}),
                i -> xxhash64(array_join(slice(w, i + 1, {wd}), ' '))) end""").alias("hs"))
        # outer: a plain explode would make Spark infer a filter that hashes every text a second time
        probe = hashed.select("doc_id", F.explode_outer("hs").alias("h"))
        part = bounded_broadcast(posted.where(F.col("width") == wd).select("h", "item_id"))
        hit = probe.join(part, "h").select("doc_id", "item_id").distinct()
        found = hit if found is None else found.unionByName(hit)
    schema = "doc_id {}, item_id {}, n_shingles long, n_found long, containment double".format(
        base.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString())
    if found is None:
        return docs.sparkSession.createDataFrame([], schema)
    found = saved(found.distinct(), "decontam-candidates")
    texts = base.join(bounded_broadcast(found.select(F.col("doc_id").alias("__d"), "item_id")),
                      F.col("doc_id").eqNullSafe(F.col("__d"))).drop("__d")
    pairs = texts.join(bounded_broadcast(items.select(F.col("item_id").alias("__i"), "width", "n", "shingles")),
                       F.col("item_id").eqNullSafe(F.col("__i"))).withColumn("w", words(F.col("text")))
    exact = pairs.withColumn("n_found", F.size(F.array_intersect("shingles", shingle_strings("w", "width"))).cast("long"))
    # the threshold stands above the aggregate: pushed below, it would split the text once a shingle
    return (exact.groupBy("doc_id", "item_id").agg(F.max("n").alias("n_shingles"), F.max("n_found").alias("n_found"))
            .where(F.col("n_found") >= F.ceil(F.col("n_shingles") * threshold - 1e-9))
            .withColumn("containment", F.col("n_found") / F.col("n_shingles")))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that hold no item; columns as they were.  Rows
    whose id is null stay unless a row without id holds an item."""
    key = options.get("doc", "doc_id")
    bad = saved(contaminated(docs, benchmark, **options).select(F.col("doc_id").alias("__bad")).distinct(), "decontam-bad")
    return docs.join(bounded_broadcast(bad, 1_000_000), F.col(f"`{key}`").eqNullSafe(F.col("__bad")), "left_anti")
