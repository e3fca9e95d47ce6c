"""Connecting the members of posting lists without all pairs of a list."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, saved


def _with_roots(links: DataFrame | None, lists: DataFrame) -> DataFrame:
    """`lists` with the component of each member so far; lists whose members
    are all in one component are done and left out."""
    if links is None:
        now = lists.withColumn("comp", F.col("id"))
    else:
        now = (lists.join(components(links).withColumnRenamed("node", "id"), "id", "left")
               .withColumn("comp", F.coalesce("root", "id")).drop("root"))
    mixed = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return now.join(mixed.select("key"), "key", "left_semi")


def connect(lists: DataFrame, confirm: Callable[[DataFrame], DataFrame], far: Callable[[DataFrame], DataFrame],
            hub_rounds: int = 1, short: int = 32, name: str = "lists") -> DataFrame:
    """Links (a, b) that connect whatever is connected by confirmed pairs
    that share a list.

    lists: (key, id, score, len).  confirm: the pairs (a, b) that hold.  far:
    the links between different components in lists longer than `short`, from
    rows (key, id, comp, len), worked in blocks.

    In each hub round the member of highest score of a list meets the members
    of other components; its pairs are as many as the list is long.  After
    the rounds the members still apart are compared in full, so no link
    between different components is lost.
    """
    found, used = None, None
    for r in range(hub_rounds):
        now = _with_roots(found, lists)
        pick = now if used is None else now.join(used, ["key", "id"], "left_anti")     # a hub serves a list once
        hub = pick.groupBy("key").agg(F.max(F.struct("score", "id", "comp")).alias("h")).select(
            "key", F.col("h.id").alias("hub"), F.col("h.comp").alias("hub_comp"))
        pairs = (now.select("key", "id", "comp").join(hub, "key").where("comp <> hub_comp")
                 .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct())
        good = saved(confirm(pairs), f"{name}-hub-{r}")
        used = hub.select("key", F.col("hub").alias("id"))
        found = good if found is None else found.union(good)
    now = saved(_with_roots(found, lists).select("key", "id", "comp", "len"), f"{name}-open")
    few = now.where(f"len <= {short}").select("key", "id", "comp")
    near = (few.join(few.toDF("key", "id2", "comp2"), "key").where("id < id2 and comp <> comp2")
            .select(F.col("id").alias("a"), F.col("id2").alias("b")))
    rest = saved(confirm(near.distinct()).union(far(now.where(f"len > {short}"))), f"{name}-rest")
    return rest if found is None else found.union(rest)


def block_pairs(rows: DataFrame, blocks: str) -> DataFrame:
    """Rows (key, id, len, ...) dealt to the block pairs (key, bi, bj) of
    their list, with side 0 (both), 1 (left) or 2 (right); `blocks` is the SQL
    for the number of blocks of a list."""
    return (rows.withColumn("nb", F.expr(f"cast(greatest(1, {blocks}) as int)"))
            .withColumn("blk", F.expr("pmod(xxhash64(id), nb)"))
            .withColumn("other", F.explode(F.expr("sequence(0, nb - 1)")))
            .withColumn("bi", F.least("blk", "other")).withColumn("bj", F.greatest("blk", "other"))
            .withColumn("side", F.expr("case when blk = other then 0 when blk < other then 1 else 2 end"))
            .drop("nb", "blk", "other", "len"))
