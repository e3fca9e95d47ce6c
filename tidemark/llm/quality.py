"""Text quality: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates.

Features are the words and word pairs of a text and the shapes of both (runs
of lower-case letters, upper-case letters and digits shrunk to one sign,
punctuation kept), hashed into 2^BITS weights; a pair of equal words is one
feature of its own.  A feature's value is its count over the number of words,
so texts of any length are scored by one sparse dot product over all words.

Training is spread over shards: each runs FTRL over its rows from the current
weights, Spark averages the weights by feature, and the average starts the
next round.  The training rows are a bounded sample (`max_rows`, half of it
for each label, lowest hashes first), the model is bounded by its 2^BITS
weights; scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textarrays as ta
from tidemark.llm.common import saved, small_batches

BITS = 18
SHARDS, ROUNDS, EPOCHS = 4, 2, 3
ALPHA, BETA, L1, L2 = 8.0, 1.0, 0.01, 0.0

_shape = np.arange(256, dtype=np.uint8)
_shape[[*range(97, 123), *range(128, 256)]] = ord("a")
_shape[65:91] = ord("A")
_shape[48:58] = ord("0")
_REPEAT = np.uint64(0x5EED)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature indices, four a word (word, shape, word pair, shape pair; the
    last word of a text pairs with nothing), and the word ranges of texts."""
    s, e = ta.runs(~ta.SPACE[data], offs)
    first = np.searchsorted(s, offs)
    word = ta.hashes(data, s, e, ta.BYTE_LOWER)
    cls = _shape[data]
    keep = np.ones(len(data), bool)
    keep[1:] = cls[1:] != cls[:-1]
    keep[s] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    shape = ta.hashes(cls[keep], at[s], at[e])
    out = np.zeros((len(s), 4), np.uint64)
    with np.errstate(over="ignore"):
        out[:, 0], out[:, 1] = word, shape + ta.MIX[10]
        for j, h in ((2, word), (3, shape)):
            nxt = np.append(h[1:], np.uint64(0))
            nxt[first[1:][first[1:] > 0] - 1] = ta.MIX[11]
            out[:, j] = ta.mix(h * ta.MIX[12 + j] + nxt * ta.MIX[16])
        out[:-1, 2][word[1:] == word[:-1]] = _REPEAT
    return (out & np.uint64((1 << BITS) - 1)).astype(np.int64), first


def _train(weights: np.ndarray | None, epochs: int):
    """FTRL over one shard's rows, from `weights`; rows (index, weight)."""
    def run(t: pa.Table) -> pa.Table:
        w0 = np.zeros((1 << BITS) + 1) if weights is None else weights.astype(float)
        n = np.zeros(len(w0))
        z = -w0 * (BETA / ALPHA + L2) - np.sign(w0) * L1
        rows = []
        t = t.sort_by([("text", "ascending"), ("y", "ascending")])       # rows arrive in any order
        y = t.column("y").to_numpy()
        for lo, hi, data, offs in ta.pieces(t.column("text")):
            idx, first = features(data, offs)
            for i in range(hi - lo):
                part = idx[first[i]:first[i + 1]]
                u, c = np.unique(part, return_counts=True)
                rows.append((np.append(u, 1 << BITS), np.append(c / max(1, len(part)), 1.0), y[lo + i]))
        order = np.random.Generator(np.random.PCG64(5))
        for _ in range(epochs):
            for r in order.permutation(len(rows)):
                f, x, label = rows[r]
                zi, ni = z[f], n[f]
                w = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
                g = (_sigmoid(w @ x) - label) * x
                n[f] = ni + g * g
                z[f] = zi + g - (np.sqrt(n[f]) - np.sqrt(ni)) / ALPHA * w
        w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
        some = np.flatnonzero(w)
        return pa.table({"i": pa.array(some, pa.int32()), "w": pa.array(w[some], pa.float64())})
    return run


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, doc: str = "doc_id", text: str = "text",
                  label: str = "quality", folds: int = 5, held: int = 0) -> DataFrame:
    """(text, y, shard): at most `max_rows` labelled texts that are not held
    out.  Rows of `docs` with equal ids all take the id's label; null ids,
    labels and texts are not used."""
    known = labels.select(F.col(f"`{doc}`").alias("d"), F.col(f"`{label}`").cast("int").alias("y")).where(
        f"d is not null and y in (0, 1) and pmod(crc32(cast(d as string)), {folds}) <> {held}").distinct()
    half = [known.where(F.col("y") == y).orderBy(F.xxhash64("d", F.lit(3)), "d").limit(max_rows // 2) for y in (0, 1)]
    ids = F.broadcast(half[0].union(half[1]))                          # at most max_rows rows
    rows = docs.select(F.col(f"`{doc}`").alias("d"), F.col(f"`{text}`").alias("text")).where("text is not null")
    return rows.join(ids, "d").select("text", "y", F.expr(f"pmod(xxhash64(d, text), {SHARDS})").alias("shard"))


def fit(rows: DataFrame) -> np.ndarray:
    """2^BITS weights and a bias from rows (text, y, shard).  Without rows all
    weights are zero, and every score is a half."""
    rows = saved(rows, "quality-rows")
    weights = None
    for _ in range(ROUNDS):
        got = (rows.groupBy("shard").applyInArrow(_train(weights, EPOCHS), "i int, w double")
               .groupBy("i").agg(F.sum(F.col("w").cast("decimal(30,15)")).cast("double").alias("w"))  # same sum in any order
               .toPandas())                                              # at most 2^BITS + 1 rows
        weights = np.zeros((1 << BITS) + 1, np.float32)
        weights[got["i"].to_numpy(np.int64)] = got["w"].to_numpy() / SHARDS
    return weights


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", to: str = "score") -> DataFrame:
    """`docs` with the score (0 to 1) of every whole text in the column `to`,
    which replaces one of that name.  Null, empty and blank texts have only
    the bias."""
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != to]
    src = docs.select(F.col(f"`{text}`").alias("t"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.zeros(b.num_rows)
            for lo, hi, data, offs in ta.pieces(b.column(0)):
                idx, first = features(data, offs)
                total = np.concatenate([[0.0], np.cumsum(weights[idx].sum(axis=1, dtype=np.float64))])
                n = np.diff(first)
                out[lo:hi] = (total[first[1:]] - total[first[:-1]]) / np.maximum(1, n)
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array(_sigmoid(out + weights[-1]))], names=["row", "score"])

    schema = src.select("row").schema.add("score", "double")
    return src.mapInArrow(run, schema).select(*[F.col("row").getField(c).alias(c) for c in keep],
                                              F.col("score").alias(to))


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = 6000, threshold: float = 0.3,
             doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`; the
    model is fitted on labelled rows that are not held out.  A null id is not
    held out and never trained on.  Empty tables are scored with whatever the
    labels give (zero weights if nothing)."""
    weights = fit(training_rows(docs, labels, max_rows, doc, text))
    scored = score(docs.select(F.col(f"`{doc}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), weights)
    return scored.select("doc_id", F.expr("coalesce(pmod(crc32(cast(doc_id as string)), 5) = 0, false)").alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = 6000, threshold: float = 0.3,
              doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that the classifier accepts; columns as they were."""
    weights = fit(training_rows(docs, labels, max_rows, doc, text))
    mark = "__quality_score"
    return score(docs, weights, text, mark).where(F.col(mark) >= threshold).drop(mark)
