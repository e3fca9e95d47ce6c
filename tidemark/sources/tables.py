"""Readers for the driver's Parquet tables and the record shapes the
operators take.

Each reader selects only the columns it needs, so Spark prunes the Parquet
scan (`ReadSchema`) and pushes any later filter on plain columns into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import event_time, json_item

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def behaviour_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as the user-behaviour / click / login / sensor log.

    seq      arrival number (event_id), the tie-break after the event time
    ts       event time, TIMESTAMP (UTC)
    user_id  key
    item_id  the `k` field of `props`
    behavior event_type (click, error, purchase, signup, view)
    value    reading
    """
    return behaviour_from(table(spark, sf_dir, "events"))


def behaviour_from(ev: DataFrame) -> DataFrame:
    """Map rows shaped like `events` (batch or stream) to the behaviour log."""
    return ev.select(
        F.col("event_id").alias("seq"),
        event_time("ts").alias("ts"),
        "user_id",
        json_item("props").alias("item_id"),
        F.col("event_type").alias("behavior"),
        "value",
    )


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order log with every line item as a pay event (the earliest counts):
    creates from `orders`, pays from `lineitem`, unshuffled.  Consumers that
    group by order (K9) then shuffle once, with map-side partial aggregation
    cutting the line items to at most one row per order and task."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.lit("create").alias("event_type"),
        event_time("o_orderdate").alias("ts"))
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.lit("pay").alias("event_type"),
        event_time("l_shipdate").alias("ts"))
    return o.unionByName(li)
