"""Change-only upsert sink (A2 on a stream): update-mode rows merged by key
and epoch.

Each micro-batch writes only the rows that changed in it, into a folder of its
epoch that a replay replaces:

    <path>/changes/epoch=<n>   the rows that changed in micro-batch n
    <path>/base/epoch=<n>      every key's row as of micro-batch n

An epoch counts once its folder holds the success marker, which the writing
job sets last, so a write cut off by a lost driver is not seen, and readers
have the state after the last whole epoch.  `compact` folds the changes into a
new base.  With `every=True` the writer does so once the changes since the last
base outweigh it, so each row is rewritten a bounded number of times on
average and the read stays in proportion to the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.streaming.run import _path


def _committed(spark: SparkSession, path: str, kind: str) -> list[int]:
    fs, p = _path(spark, f"{path.rstrip('/')}/{kind}")
    found = fs.globStatus(_path(spark, f"{path.rstrip('/')}/{kind}/epoch=*/_SUCCESS")[1]) if fs.exists(p) else []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def _bytes(spark: SparkSession, path: str, kind: str, epochs: list[int]) -> int:
    total = 0
    for e in epochs:
        fs, p = _path(spark, f"{path.rstrip('/')}/{kind}/epoch={e}")
        total += fs.getContentSummary(p).getLength()
    return total


def _rows(spark: SparkSession, path: str, kind: str, epochs: list[int], schema: T.StructType) -> DataFrame | None:
    if not epochs:
        return None
    root = f"{path.rstrip('/')}/{kind}"
    full = T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])
    return spark.read.schema(full).option("basePath", root).parquet(*[f"{root}/epoch={e}" for e in epochs])


def _live(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """(the newest base, the epochs of changes after it)."""
    base = _committed(spark, path, "base")[-1:]
    return base, [e for e in _committed(spark, path, "changes") if not base or e > base[0]]


def read_upserts(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The newest row of every key.  Without a whole epoch: empty."""
    base, after = _live(spark, path)
    parts = [r for r in (_rows(spark, path, "base", base, schema), _rows(spark, path, "changes", after, schema)) if r is not None]
    if not parts:
        return spark.createDataFrame([], schema)
    if base and not after:
        return parts[0].select(*schema.names)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rest = [c for c in schema.names if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("epoch")).alias("row"))
    return newest.select(*[F.col(c) if c in keys else F.col("row").getField(c).alias(c) for c in schema.names])


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> None:
    """Write the state after the last whole epoch as a new base.  The base
    before it and the changes since then stay for readers that have already
    listed them; older ones are deleted."""
    base, after = _live(spark, path)
    if not after:
        return
    read_upserts(spark, path, schema, keys).write.mode("overwrite").parquet(f"{path.rstrip('/')}/base/epoch={after[-1]}")
    if base:
        for kind in ("base", "changes"):
            for e in _committed(spark, path, kind):
                if e < base[0] or (kind == "changes" and e == base[0]):
                    fs, p = _path(spark, f"{path.rstrip('/')}/{kind}/epoch={e}")
                    fs.delete(p, True)


def upsert_writer(path: str, schema: T.StructType, keys: list[str], every: bool = True):
    """`foreachBatch` function of an update-mode query whose rows are unique by
    `keys` within a micro-batch, as those of an aggregation are."""
    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/changes/epoch={epoch}")
        if every:
            base, after = _live(spark, path)
            if base and _bytes(spark, path, "changes", after) > _bytes(spark, path, "base", base) or not base and len(after) > 1:
                compact(spark, path, schema, keys)
    return write
