"""Helpers shared by the operators: table reading, tables written to the
shared folder to cut lineage, and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark alone (the path may be in any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_written: dict[str, list[str]] = {}


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write `df` below `spark.checkpoint.dir` and read it back: a lost
    executor then costs a re-read, not a recomputation of the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, but: DataFrame | None = None) -> None:
    """Delete the tables that `saved` has written in this application and
    that `but` does not read.  For a job whose results are written: tables not
    yet read to the end must not be discarded."""
    needed = but.inputFiles() if but is not None else []
    conf, rest = spark._jsc.hadoopConfiguration(), []
    for path in _written.pop(spark.sparkContext.applicationId, []):
        if any(f"/{path.rsplit('/', 1)[1]}/" in f for f in needed):
            rest.append(path)
            continue
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    _written[spark.sparkContext.applicationId] = rest


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so Python workers stay small even
    when texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def bounded_broadcast(df: DataFrame, rows: int = 100_000, items: str | None = None, most: int = 1_000_000) -> DataFrame:
    """`df` marked for broadcast if it is counted to have at most `rows`
    (narrow) rows, and at most `most` elements in the lists of column `items`;
    a larger table stays unmarked and joins by shuffle."""
    n, k = df.limit(rows + 1).agg(F.count(F.lit(1)), F.sum(F.size(items)) if items else F.lit(0)).first()
    return F.broadcast(df) if n <= rows and (k or 0) <= most else df


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge table (a, b), as (node,
    root) with root the smallest node id of the component; only nodes that
    have an edge appear, and null or equal ends are ignored.

    Alternating large-star and small-star steps: every step is a map-side
    combined `min` per node and a join with that one-row-per-node table, so
    a hub with a third of all edges is a skewed join that AQE splits, never a
    collected neighbour list.  Each round is written to the shared folder.
    """
    e = saved(edges.where("a is not null and b is not null and a <> b")
              .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .distinct(), "cc-edges")
    mark = _mark(e)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low.select("u", F.least("u", "m").alias("m")), "u")
                 .where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low2.select("u", F.col("m").alias("v"))).distinct())
        e = saved(small, "cc-edges")
        last, mark = mark, _mark(e)
        if mark == last:
            break
    else:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(e.select(F.col("v"), F.col("v")).distinct()))


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
              F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(r)
