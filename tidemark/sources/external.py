"""Live sources of the reference.

Both are thin `readStream` calls; the transforms downstream are the same
functions the file-stream tests run.  Neither is exercised in the test suite:
the Kafka connector JAR is not on this machine's class path, and no network
port may be opened here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines from a TCP socket (column `value`).  A demo source:
    not replayable, so no exactly-once guarantee after a restart."""
    return (spark.readStream.format("socket").option("host", host)
                 .option("port", str(int(port))).load())


def read_kafka(spark: SparkSession, servers: str, topic: str = "sensor",
               group_id: str = "consumer-group", starting: str = "latest") -> DataFrame:
    """String values of a Kafka topic (the reference reads topic
    `sensor` as group `consumer-group` from the latest offset).  Offsets are
    tracked in the query checkpoint, so a restart resumes without loss."""
    return (spark.readStream.format("kafka")
                 .option("kafka.bootstrap.servers", servers)
                 .option("subscribe", topic)
                 .option("kafka.group.id", group_id)
                 .option("startingOffsets", starting)
                 .load()
                 .select(F.col("value").cast("string").alias("value"),
                         F.col("timestamp").alias("kafka_ts")))
