"""SparkSession setup shared by the library, tests and the bench.

Everything time-related runs in UTC so event-time windows, day boundaries
and the naive timestamps of the test tables mean the same thing on every
executor and in the DuckDB oracle.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library relies on.  Shuffle partition
# count is left to the caller (cluster default or `shuffle_partitions`).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of BASE_CONF to an existing session
    (the keyed-state stream operators need the RocksDB state store)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.streaming.stateStore.providerClass"):
        spark.conf.set(k, BASE_CONF[k])
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: the keyed
    stream processors are unpickled there, and the driver's working folder or
    PYTHONPATH need not exist on them."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        here = os.path.dirname(os.path.abspath(__file__))
        name = os.path.basename(here)
        sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix=f"{name}-pkg-"), name), "zip",
                                         os.path.dirname(here), name))
        _shipped.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by `spark.checkpoint.dir`.

    On a cluster this setting names a shared file system folder and is
    only read here.  When it is unset, a local session gets a fresh scratch
    folder; any other raises an error, because executors would write to disks
    of their own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def local_master() -> str:
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"
