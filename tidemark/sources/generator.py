"""Synthetic sensor source.

Ten sensors `sensor_1` .. `sensor_10`; each starts at 60 + 20·N(0,1) and adds
N(0,1) per tick; one row per sensor per tick.  The reference stamps rows with
the wall clock; here tick t is stamped `start_ms + t * tick_ms`, so a replay
gives the same rows.

* `sensor_walk`     batch form, Spark-native: normals from hashes of
                    (seed, tick, sensor) -- independent of partitioning --
                    and the walk as a chunked running sum (`scan.running`),
                    so no sensor's whole history sits in one task.
* `SensorSource`    stream form, a Python data source (`format("sensor_walk")`):
                    the offset carries the tick and the ten current values, so
                    a restarted query continues exactly where it stopped.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from tidemark.operators import scan

SENSORS = 10
SCHEMA = "id string, timestamp bigint, temperature double"


def _uniform(seed: int, salt: int) -> F.Column:
    h = F.xxhash64(F.lit(seed), F.col("id"), F.lit(salt))
    return (F.pmod(h, F.lit(1 << 53)).cast("double") + 0.5) / float(1 << 53)


def _normal(seed: int) -> F.Column:
    u1, u2 = _uniform(seed, 1), _uniform(seed, 2)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * math.pi * u2)


def sensor_walk(spark: SparkSession, ticks: int, seed: int = 7, start_ms: int = 0,
                tick_ms: int = 1000, chunk_ticks: int = 4096) -> DataFrame:
    """Batch form: `ticks` x 10 rows (id, timestamp ms, temperature)."""
    rows = spark.range(0, int(ticks) * SENSORS)
    step = _normal(seed)
    base = rows.select(
        (F.col("id") / SENSORS).cast("bigint").alias("tick"),
        (F.col("id") % SENSORS + 1).alias("sensor"),
        F.when(F.col("id") < SENSORS, 60.0 + 20.0 * step).otherwise(step).alias("step"))
    walk = scan.running(base, ["sensor"], [F.col("tick")],
                        {"temperature": ("sum", F.col("step"))},
                        chunk=(F.col("tick") / chunk_ticks).cast("bigint"))
    return walk.select(F.concat(F.lit("sensor_"), F.col("sensor").cast("string")).alias("id"),
                       (F.lit(start_ms) + F.col("tick") * tick_ms).alias("timestamp"),
                       "temperature")


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.seed = int(options.get("seed", 7))
        self.ticks_per_batch = int(options.get("ticksPerBatch", 10))
        self.max_ticks = int(options.get("maxTicks", 100))
        self.start_ms = int(options.get("startMs", 0))
        self.tick_ms = int(options.get("tickMs", 1000))

    def initialOffset(self) -> dict:
        return {"tick": 0, "values": []}

    def _gen(self, start: dict):
        import numpy as np
        tick, values = int(start["tick"]), list(start["values"])
        stop = min(tick + self.ticks_per_batch, self.max_ticks)
        rows = []
        for t in range(tick, stop):
            rng = np.random.default_rng([self.seed, t])
            z = rng.standard_normal(SENSORS)
            values = [60.0 + 20.0 * float(z[i]) for i in range(SENSORS)] if not values else \
                [values[i] + float(z[i]) for i in range(SENSORS)]
            ts = self.start_ms + t * self.tick_ms
            rows.extend((f"sensor_{i + 1}", ts, values[i]) for i in range(SENSORS))
        return rows, {"tick": stop, "values": values}

    def read(self, start: dict):
        rows, end = self._gen(start)
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict):
        rows, _ = self._gen(start)
        return iter(rows[: (int(end["tick"]) - int(start["tick"])) * SENSORS])


class SensorSource(DataSource):
    """Stream form: `spark.readStream.format("sensor_walk")` with options
    seed, ticksPerBatch, maxTicks, startMs, tickMs."""

    @classmethod
    def name(cls) -> str:
        return "sensor_walk"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema):
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SensorSource)
