"""Prefix trie of conversations, by collapsing whole sequences.

A conversation is the sequence of its turns (role, text).  The trie has one
node per distinct prefix; it is never built node by node:

1. every turn gets its place in its conversation and a digest, and every
   prefix the digest of its turns (a sum of digests salted by place, so that
   it is a running sum);
2. identical whole conversations collapse into one weighted sequence with the
   list of the conversations that end there;
3. sequences that are proper prefixes of others are dropped by an anti-join,
   which leaves the leaves;
4. the prefixes of the weighted sequences are aggregated into nodes.  What a
   subtree saves is counted once a node: a node's own share sits on the
   sequence of its smallest member, whose suffix sums reach all its ancestors.

Scale: places come from a range partition by (conversation, turn), and running
sums from chunks of `CHUNK` turns with carried totals, so a conversation with
a third of all turns is spread over tasks; groups are combined before they are
shuffled; a sequence's list of ends is kept in pieces of at most `PIECE`
ids.  The joins of a node with its parent are many to one on keys that may be
hot (a common first turn); AQE splits them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved

CHUNK = 4096            # turns of one conversation that one window holds
PIECE = 4096            # ids in one piece of a list of ends
_SUMS = ["k1", "k2", "k3", "k4"]
_KEY = ["depth", *_SUMS]


class Trie(NamedTuple):
    """nodes: one row per distinct prefix; sequences: one row per distinct
    whole conversation; ends: their lists of conversations, in pieces."""
    nodes: DataFrame
    sequences: DataFrame
    ends: DataFrame


def placed(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(conv, pos, d1, d2, chars): each turn with its place (from 0) and two
    64-bit digests of (role, text).

    Ordered by turn, null first; ties by role, then text.  A null role or text
    is empty; rows without a conversation are left out.
    """
    c = lambda name: F.col(f"`{name}`")
    rows = conversations.where(c(conv).isNotNull()).select(
        c(conv).cast("long").alias("conv"), c(turn).cast("long").alias("turn"),
        F.coalesce(c(role), F.lit("")).alias("role"), F.coalesce(c(text), F.lit("")).alias("text"))
    # numbered within the partition it was sorted in, then written: the numbers are read, never computed again
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    rows = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)).alias("idx"),
        F.xxhash64(F.lit(1), "role", "text").alias("d1"), F.xxhash64(F.lit(2), "text", "role").alias("d2"),
        F.length("text").cast("long").alias("chars")), "trie-turns")
    parts = rows.groupBy("conv", "part").agg(F.min("idx").alias("lo"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv", "part", "lo", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    return saved(rows.join(parts, ["conv", "part"]).select(
        "conv", (F.col("idx") - F.col("lo") + F.col("off")).alias("pos"), "d1", "d2", "chars"), "trie-placed")


def shared_openings(turns: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) of the rebuilt conversations: c keeps its turns
    from the h-th on, behind the first h turns of conversation c - c % block;
    h = crc32 of the decimal c, modulo `most`."""
    h = F.expr(f"crc32(cast(cast(conv as string) as binary)) % {most}")
    base = F.col("conv") - F.col("conv") % block
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).select("conv", "n", base.alias("base"), h.alias("h"))
    first = turns.where(f"pos < {most} and conv % {block} = 0").select(F.col("conv").alias("base"), "pos", "d1", "d2", "chars")
    lead = convs.where("conv <> base").join(first, "base").where("pos < h").select("conv", "pos", "d1", "d2", "chars")
    # own turns follow the opening that is there: the base may hold fewer than h turns, or be missing
    sizes = convs.where(f"conv % {block} = 0").select(F.col("conv").alias("base"), F.least("n", F.lit(most)).alias("m"))
    own = turns.withColumn("h", h).withColumn("base", base).where("conv = base or pos >= h")
    own = own.join(sizes, "base", "left").withColumn("pos", F.expr(
        "case when conv = base then pos else pos - h + least(h, coalesce(m, 0)) end"))
    return own.select("conv", "pos", "d1", "d2", "chars").unionByName(lead), convs.select("conv")


def _salted() -> list[Column]:
    """Four 32-bit digests of a turn at its depth; their sums over up to 2^31
    turns fit a long."""
    out = []
    for i, (a, b) in enumerate((("d1", "d2"), ("d2", "d1"))):
        out.append(F.xxhash64(F.lit(i), a, "depth", b).alias(f"x{i}"))
    return out


def _halves(rows: DataFrame) -> DataFrame:
    rows = rows.select("*", *_salted())
    return rows.select("conv", "depth", "chars", *[F.expr(e).alias(k) for e, k in zip(
        ("x0 & 4294967295", "shiftrightunsigned(x0, 32)", "x1 & 4294967295", "shiftrightunsigned(x1, 32)"), _SUMS)])


def _running(rows: DataFrame, sums: list[str], later: bool = False) -> DataFrame:
    """`rows` (conv, depth, ...) with each of `sums` replaced by its running
    sum over the conversation, from its first turn on (later: from its last
    back), in chunks of `CHUNK` turns."""
    rows = rows.withColumn("chunk", F.floor(F.col("depth") / CHUNK))
    order = F.col("depth").desc() if later else F.col("depth")
    w = Window.partitionBy("conv", "chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy("conv", "chunk").agg(*[F.sum(s).alias(f"{s}_t") for s in sums])
    over = F.col("chunk").desc() if later else F.col("chunk")
    wt = Window.partitionBy("conv").orderBy(over).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("conv", "chunk", *[F.sum(f"{s}_t").over(wt).alias(f"{s}_c") for s in sums])
    carry = carry.where(F.col(f"{sums[0]}_c").isNotNull())          # only conversations of several chunks
    inner = rows.select(*[c for c in rows.columns if c not in sums], *[F.sum(s).over(w).alias(s) for s in sums])
    return inner.join(carry, ["conv", "chunk"], "left").select(
        *[c for c in rows.columns if c not in (*sums, "chunk")],
        *[(F.col(s) + F.coalesce(f"{s}_c", F.lit(0))).alias(s) for s in sums])


def build(turns: DataFrame, convs: DataFrame) -> Trie:
    """The trie of the conversations `convs` (conv) with `turns` (conv, pos,
    d1, d2, chars), pos counting from 0 without gaps.

    nodes: conv_id (smallest member), depth, key columns, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, n_ends.  A conversation
    without turns ends at the root.  Without conversations there are no rows.
    """
    steps = _halves(turns.withColumn("depth", F.col("pos") + 1))
    root = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"),
                        *[F.lit(0).cast("long").alias(k) for k in _SUMS])
    steps = saved(steps.unionByName(root), "trie-steps")

    # whole conversations, collapsed
    whole = saved(steps.groupBy("conv").agg(F.max("depth").alias("depth"), *[F.sum(k).alias(k) for k in _SUMS]), "trie-whole")
    seqs = saved(whole.groupBy(*_KEY).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("weight")), "trie-sequences")
    pieces = (whole.join(seqs.withColumnRenamed("conv", "seq"), _KEY)
              .groupBy("seq", F.expr(f"floor(conv / {PIECE})").alias("piece"))
              .agg(F.sort_array(F.collect_list("conv")).alias("ids")))              # at most PIECE ids a group

    # prefixes of the weighted sequences
    prefixes = steps.join(seqs.select("conv", F.col("depth").alias("size"), "weight"), "conv")
    before = [f"p{i}" for i in range(4)]
    prefixes = prefixes.select("*", *[F.col(k).alias(f"o{i}") for i, k in enumerate(_SUMS)])
    prefixes = _running(prefixes, _SUMS).select(
        "conv", "depth", "chars", "size", "weight", *_SUMS,
        *[(F.col(k) - F.col(f"o{i}")).alias(before[i]) for i, k in enumerate(_SUMS)])
    prefixes = saved(prefixes, "trie-prefixes")

    proper = prefixes.where("depth < size").select(*_KEY).distinct()
    leaves = seqs.join(proper, _KEY, "left_anti").select("conv", F.lit(1).alias("leaf"))

    counted = prefixes.groupBy(*_KEY).agg(F.min("conv").alias("conv"), F.sum("weight").alias("n"), F.first("chars").alias("chars"))
    share = counted.select("conv", "depth", ((F.col("n") - 1) * F.col("chars")).alias("share"))
    weighted = (prefixes.join(share, ["conv", "depth"], "left").join(leaves, "conv", "left")
                .withColumn("share", F.coalesce("share", F.lit(0))))
    nodes = _running(weighted, ["share"], later=True).groupBy(*_KEY).agg(
        F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
        F.sum("share").alias("saved_tokens"), F.sum(F.expr("case when depth = size then weight else 0 end")).alias("n_ends"),
        *[F.first(p).alias(p) for p in before])
    nodes = saved(nodes, "trie-nodes")
    up = [(F.col("depth") - 1).alias("depth"), *[F.col(p).alias(k) for p, k in zip(before, _SUMS)]]
    children = nodes.where("depth > 0").select(*up).groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select("conv_id", *[F.col(k).alias(f"u_{k}") for k in _KEY]).withColumnRenamed("conv_id", "parent_conv_id")
    on = (F.col("depth") == F.col("u_depth") + 1)
    for p, k in zip(before, _SUMS):
        on = on & (F.col(p) == F.col(f"u_{k}"))
    nodes = (nodes.join(parents, on, "left").join(children, _KEY, "left")
             .select("conv_id", *_KEY, "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                     "n_leaves", "saved_tokens", "n_ends"))
    sequences = seqs.join(leaves, "conv", "left").select(
        F.col("conv").alias("conv_id"), *_KEY, "weight", F.col("leaf").isNotNull().alias("is_leaf"))
    return Trie(nodes, sequences, pieces.withColumnRenamed("seq", "conv_id"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each sequence's pieces, which arrive in order."""
    now, h = None, None
    done: list[tuple[int, str]] = []
    for b in batches:
        for seq, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if seq != now:
                if now is not None:
                    done.append((now, h.hexdigest()))
                now, h = seq, hashlib.sha256()
            else:
                h.update(b",")
            h.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_pylist([{"seq": s, "ends_sha256": x} for s, x in done],
                                             pa.schema([("seq", pa.int64()), ("ends_sha256", pa.string())]))
            done = []
    if now is not None:
        yield pa.RecordBatch.from_pylist([{"seq": now, "ends_sha256": h.hexdigest()}],
                                         pa.schema([("seq", pa.int64()), ("ends_sha256", pa.string())]))


def with_ends_digest(trie: Trie) -> DataFrame:
    """The nodes with ends_sha256: the SHA-256 of the ids that end there,
    ascending and comma-joined.  Pieces are joined in parallel; the digest
    itself, which no one can compute in parts, reads them as a stream."""
    joined = trie.ends.select(F.col("conv_id").alias("seq"), "piece", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    digests = (joined.repartition("seq").sortWithinPartitions("seq", "piece").select("seq", "ids")
               .mapInArrow(_digests, "seq long, ends_sha256 string"))
    digests = trie.sequences.select(F.col("conv_id").alias("seq"), *_KEY).join(digests, "seq").drop("seq")
    return trie.nodes.join(digests, _KEY, "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
