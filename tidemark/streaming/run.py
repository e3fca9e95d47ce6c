"""Running Structured Streaming queries.

* `stream_table`  a file stream over one of the driver's Parquet tables.
* `EndOfInput`    the end-of-input flush: a one-row file with an event time
                  far in the future.  The reference's bounded file source ends
                  with a final watermark that closes every window; Spark's
                  `availableNow` run stops with the last window still open.
                  `run_to_table(..., end=...)` drains the data in as many
                  micro-batches as it takes, then writes the flush row and
                  lets the same query go on.  The flush row moves the
                  watermark past every real window; its own window never
                  closes, so it is never emitted.  Keyed stateful operators
                  skip it (`is_flush`).  The checkpoint is marked as
                  ended before that, and a later start on it raises an error instead of
                  dropping new rows as late.
* `keep`          a filter that always lets the flush row through.  Spark
                  pushes filters that do not mention the event-time column
                  below the watermark, which would hide the flush row from it.
* `run_stream`    named query, checkpoint in the shared checkpoint folder,
                  trigger `availableNow` (or a processing-time interval).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import scratch_path

# Fixed value: event time of the flush row (far beyond any real data).
FLUSH_TS = dt.datetime(2999, 1, 1)


def stream_table(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: file stream over `<sf_dir>/<name>.parquet`.  The file source needs a
    folder or a glob; a one-name glob lists exactly that table."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(f"{sf_dir.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet")


def _path(spark: SparkSession, path: str):
    """(file system, path) of a path in any store that Spark can reach."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class EndOfInput:
    """End of a bounded stream: a source of its own, empty while the data is
    drained, that receives the flush row once all of it has been read
    (`run_to_table(..., end=...)`).  The flush row never sits in a folder of
    the user's."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.schema, self.ts = spark, scratch_path(spark, "flush"), None, None
        fs, p = _path(spark, self.folder)
        fs.mkdirs(p)

    def attach(self, stream: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
        """The stream with this end, and the watermark (`delay` =
        allowed out-of-orderness; "0 seconds" = ascending time)."""
        self.ts = ts
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in stream.schema.fields])
        flush = self.spark.readStream.schema(self.schema).parquet(self.folder)
        return stream.unionByName(flush).withWatermark(ts, delay)

    def close(self) -> None:
        """Write the flush row (all columns null but the event time)."""
        row = {f.name: None for f in self.schema.fields}
        row[self.ts] = FLUSH_TS
        self.spark.createDataFrame([row], self.schema).coalesce(1).write.mode("append").parquet(self.folder)


def is_flush(ts: str = "ts") -> Column:
    return F.col(ts) >= F.lit(FLUSH_TS).cast("timestamp")


def keep(cond: Column, ts: str = "ts") -> Column:
    """Filter condition that never drops the flush row (see module doc)."""
    return cond | is_flush(ts)


def _ended(spark: SparkSession, checkpoint: str):
    return _path(spark, f"{checkpoint.rstrip('/')}/_end_of_input")


def run_stream(df: DataFrame, name: str, path: str | None = None, mode: str = "append",
               fmt: str = "parquet", checkpoint: str | None = None,
               trigger: str | None = None, partitions: int | None = None, each_batch=None) -> StreamingQuery:
    """Start a named, checkpointed query.  Re-running with the same
    checkpoint resumes where the last run stopped (exactly-once file sink).
    trigger=None -> availableNow (drain what is there, then stop);
    trigger="5 seconds" -> processing-time micro-batches.
    `each_batch` (batch, epoch) takes the rows in place of a sink.
    `partitions` sets the shuffle / state partitions of a new checkpoint
    (fixed for its life, so give it the size of the live state; default: the
    session's `spark.sql.shuffle.partitions`); the session setting is restored
    once the query has started."""
    spark = df.sparkSession
    checkpoint = checkpoint or scratch_path(spark, f"ckpt-{name}")
    fs, marker = _ended(spark, checkpoint)
    if fs.exists(marker):
        raise ValueError(f"{checkpoint} has passed its end of input: its watermark would drop every new row; "
                         "start with a new checkpoint")
    w = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    w = w.foreachBatch(each_batch) if each_batch else w.format(fmt)
    if path:
        w = w.option("path", path)
    w = w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)
    if not partitions:
        return w.start()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(int(partitions)))
    try:
        return w.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def run_to_table(df: DataFrame, name: str, mode: str = "append",
                 path: str | None = None, checkpoint: str | None = None,
                 drain: str = "availableNow", partitions: int | None = None,
                 end: EndOfInput | None = None) -> DataFrame:
    """Drain a stream into a Parquet folder and read the result back as a
    batch DataFrame (used by the registered stream twins and the tests).
    With `end` (attached to the stream) one query drains the data, then its
    flush row.  The checkpoint is marked as ended before the flush row is
    written, so that a driver lost in between cannot resume behind it.

    drain="availableNow"  one `availableNow` run (file sources)
    drain="all"           micro-batches until the source reports nothing new
                          (sources whose reader hands out one batch per call)"""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"out-{name}")
    checkpoint = checkpoint or scratch_path(spark, f"ckpt-{name}")
    trigger = "0 seconds" if drain == "all" or end is not None else None
    _finish(run_stream(df, name, path, mode, "parquet", checkpoint, trigger=trigger, partitions=partitions), checkpoint, end,
            trigger is None)
    return spark.read.schema(df.schema).parquet(path)


def _finish(q: StreamingQuery, checkpoint: str, end: EndOfInput | None, stops: bool = False) -> None:
    """Wait until the query has drained its input, and then its end."""
    if stops:
        q.awaitTermination()
        return
    try:
        q.processAllAvailable()
        if end is not None:
            fs, marker = _ended(end.spark, checkpoint)
            fs.create(marker).close()
            end.close()
            q.processAllAvailable()
    finally:
        q.stop()


def run_to_tables(df: DataFrame, tag: str, outputs: list[str], name: str, path: str | None = None,
                  checkpoint: str | None = None, partitions: int | None = None,
                  end: EndOfInput | None = None) -> dict[str, DataFrame]:
    """Drain a stream once into several outputs, {value of `tag`: table}.
    One job writes all outputs of a micro-batch, into a folder of its epoch
    that it replaces: an epoch that is run again after a failure adds nothing,
    and no output is ahead of another.  Values not listed get no table."""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"out-{name}")
    checkpoint = checkpoint or scratch_path(spark, f"ckpt-{name}")
    write = epoch_writer(path, tag)
    q = run_stream(df, name, checkpoint=checkpoint, trigger="0 seconds" if end is not None else None, partitions=partitions,
                   each_batch=write)
    _finish(q, checkpoint, end, end is None)
    return read_outputs(spark, path, df.schema, tag, outputs)


def epoch_writer(path: str, tag: str):
    """`foreachBatch` function of `run_to_tables`."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.partitionBy(tag).mode("overwrite").parquet(f"{path}/epoch={epoch}")
    return write


def read_outputs(spark: SparkSession, path: str, schema: T.StructType, tag: str, outputs: list[str]) -> dict[str, DataFrame]:
    """The tables that `epoch_writer` wrote; an output without rows is empty."""
    columns = T.StructType([f for f in schema.fields if f.name != tag])
    both = T.StructType([*columns.fields, T.StructField("epoch", T.LongType()), T.StructField(tag, T.StringType())])
    fs, p = _path(spark, path)
    fs.mkdirs(p)
    rows = spark.read.schema(both).parquet(path)
    return {o: rows.where(F.col(tag) == o).select(*columns.names) for o in outputs}


def dropped_rows(q: StreamingQuery) -> int:
    """Rows that the query's built-in stateful operators dropped as late,
    over its recent micro-batches (`spark.sql.streaming.numRecentProgressUpdates`
    of them).  Aggregations count them after their map-side combination; for
    an exact account by row see `stateful.count_with_late`."""
    return sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])


def console(df: DataFrame, label: str, mode: str = "append") -> StreamingQuery:
    """Labelled print sink."""
    return (df.withColumn("label", F.lit(label)).writeStream.outputMode(mode)
              .format("console").option("truncate", "false").start())


def multi_output(df: DataFrame, tag: str, paths: dict[str, str], name: str,
                 checkpoint: str | None = None) -> StreamingQuery:
    """One pass, several sinks: rows are routed by their `tag` column,
    each micro-batch is persisted once and written to every output path.
    Each epoch overwrites its own folder, so a replayed epoch after a
    failure does not duplicate rows."""
    spark = df.sparkSession
    checkpoint = checkpoint or scratch_path(spark, f"ckpt-{name}")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for t, p in paths.items():
                (batch.filter(F.col(tag) == t).drop(tag)
                      .write.mode("overwrite").parquet(f"{p}/epoch={epoch}"))
        finally:
            batch.unpersist()

    return (df.writeStream.queryName(name).option("checkpointLocation", checkpoint)
              .foreachBatch(write).trigger(availableNow=True).start())

