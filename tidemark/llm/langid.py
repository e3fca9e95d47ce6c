"""Language of a text: a bidirectional gated recurrent network over bytes.

The network reads pieces (runs of bytes between white space, cut after
`PIECE` bytes) from both ends, from a zero state, and labels every byte
position with language probabilities; a document's probabilities are the mean
over all its positions.  As a piece is read on its own, its probabilities
depend on its bytes alone: each task runs the network once per distinct piece
and adds up the results by occurrence, which gives the same sums as running
it over every occurrence.

Training is backpropagation through time in numpy, on a bounded sample of
documents per language.  Shards of the sample are trained side by side in
Spark and their parameters averaged after each round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import textarrays as ta
from tidemark.llm.common import saved, small_batches

PIECE, HIDDEN = 8, 16
SHARDS, ROUNDS, STEPS, BATCH, RATE = 4, 2, 150, 256, 0.01
CACHE = 200_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def initial(n_langs: int, seed: int = 1) -> dict[str, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(seed))
    p = {}
    for d in "fb":
        p[f"x{d}"] = r.normal(0, 0.3, (256, 3 * HIDDEN))
        p[f"h{d}"] = r.normal(0, HIDDEN ** -0.5, (HIDDEN, 3 * HIDDEN))
        p[f"o{d}"] = r.normal(0, HIDDEN ** -0.5, (HIDDEN, n_langs))
    p["bias"] = np.zeros(n_langs)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _sig(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _read(p: dict, d: str, x: np.ndarray, keep: list | None = None) -> list[np.ndarray]:
    """States after each byte of the pieces x (rows), in reading order."""
    H = HIDDEN
    h = np.zeros((len(x), H), np.float32)
    out = []
    for t in range(x.shape[1]):
        a = p[f"x{d}"][x[:, t]]
        u = h @ p[f"h{d}"]
        zr = _sig(a[:, :2 * H] + u[:, :2 * H])
        z, r = zr[:, :H], zr[:, H:]
        c = np.tanh(a[:, 2 * H:] + r * u[:, 2 * H:])
        if keep is not None:
            keep.append((h, z, r, c, u[:, 2 * H:]))
        h = c + z * (h - c)
        out.append(h)
    return out


def label(p: dict, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Language probabilities of every byte of equally long pieces:
    (pieces, positions, languages)."""
    f = _read(p, "f", x, None if keep is None else keep.setdefault("f", []))
    b = _read(p, "b", x[:, ::-1], None if keep is None else keep.setdefault("b", []))[::-1]
    z = np.stack(f, 1) @ p["of"] + np.stack(b, 1) @ p["ob"] + p["bias"]
    if keep is not None:
        keep["hf"], keep["hb"] = f, b
    z = np.exp(z - z.max(axis=2, keepdims=True))
    return z / z.sum(axis=2, keepdims=True)


def gradient(p: dict, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Backpropagation through time of the mean cross entropy over all
    positions of equally long pieces x with languages y."""
    keep: dict = {}
    d_out = label(p, x, keep)
    d_out[np.arange(len(x)), :, y] -= 1
    d_out /= x.size
    g = {"bias": d_out.sum(axis=(0, 1))}
    for d, states in (("f", keep["hf"]), ("b", keep["hb"])):
        g[f"o{d}"] = np.tensordot(np.stack(states, 1), d_out, ((0, 1), (0, 1)))
        order = x if d == "f" else x[:, ::-1]
        dz = d_out if d == "f" else d_out[:, ::-1]
        gx, gh = np.zeros_like(p[f"x{d}"]), np.zeros_like(p[f"h{d}"])
        dh = np.zeros((len(x), HIDDEN), np.float32)
        for t in range(x.shape[1] - 1, -1, -1):
            h0, z, r, c, uc = keep[d][t]
            dh = dh + dz[:, t] @ p[f"o{d}"].T
            da = dh * (1 - z) * (1 - c * c)
            du = np.concatenate([dh * (h0 - c) * z * (1 - z), da * uc * r * (1 - r), da * r], axis=1)
            gh += h0.T @ du
            into = du.copy()
            into[:, 2 * HIDDEN:] = da
            np.add.at(gx, order[:, t], into)
            dh = dh * z + du @ p[f"h{d}"].T
        g[f"x{d}"], g[f"h{d}"] = gx, gh
    return g


def _cut(data: np.ndarray, offs: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces, and their ranges by text.  Runs without
    any letter are left out."""
    s, e = ta.runs(~ta.SPACE[data], offs)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    some = letters[e] > letters[s]
    s, e = s[some], e[some]
    parts = np.maximum(1, -(-(e - s) // size))
    run = np.repeat(np.arange(len(s)), parts)
    at = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
    ps = s[run] + at * size
    return ps, np.minimum(ps + size, e[run]), np.searchsorted(ps, offs)


def _train(params: dict, steps: int, seed: int):
    """Adam on one shard's rows (text, y); one row of parameters."""
    def run(t: pa.Table) -> pa.Table:
        p = {k: v.copy() for k, v in params.items()}
        m = {k: np.zeros_like(v) for k, v in p.items()}
        v2 = {k: np.zeros_like(v) for k, v in p.items()}
        y = t.column("y").to_numpy()
        by: dict[int, list] = {}
        for lo, hi, data, offs in ta.pieces(t.column("text")):
            s, e, first = _cut(data, offs)
            owner = np.repeat(y[lo:hi], np.diff(first))
            for n in np.unique(e - s):
                pick = np.flatnonzero(e - s == n)
                by.setdefault(int(n), []).append((data[s[pick][:, None] + np.arange(n)], owner[pick]))
        pool = {n: (np.concatenate([a for a, _ in v]), np.concatenate([b for _, b in v])) for n, v in by.items()}
        lengths = sorted(pool)
        if lengths:
            r = np.random.Generator(np.random.PCG64(seed + int(t.column("shard")[0].as_py())))
            odds = np.array([len(pool[n][0]) * n for n in lengths], float)
            for step in range(1, steps + 1):
                x, lang = pool[lengths[r.choice(len(lengths), p=odds / odds.sum())]]
                pick = r.integers(len(x), size=BATCH)
                g = gradient(p, x[pick], lang[pick])
                for k in p:
                    m[k] += 0.1 * (g[k] - m[k])
                    v2[k] += 0.01 * (g[k] * g[k] - v2[k])
                    p[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.99 ** step)) + 1e-6)
        flat = np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float64)
        return pa.table({"p": pa.array([flat.tolist()], pa.list_(pa.float64()))})
    return run


def training_rows(docs: DataFrame, per_lang: int, doc: str = "doc_id", text: str = "text", lang: str = "lang",
                  folds: int = 4, held: int = 2) -> DataFrame:
    """(text, lang, shard): at most `per_lang` documents of each language
    that are not held out, lowest hashes first.  Null ids, texts and
    languages are not used."""
    ok = docs.select(F.col(f"`{doc}`").alias("d"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    ok = ok.where(f"d is not null and text is not null and lang is not null and pmod(crc32(cast(d as string)), {folds}) <> {held}")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("d", F.lit(5)), "d")
    ids = ok.select("d", "lang").withColumn("rk", F.row_number().over(order)).where(F.col("rk") <= per_lang)
    ids = saved(ids.select("d", "lang").distinct(), "langid-sample")
    return ok.join(F.broadcast(ids), ["d", "lang"]).select(                    # at most per_lang rows a language
        "text", "lang", F.expr(f"pmod(xxhash64(d, text), {SHARDS})").alias("shard"))


def fit(rows: DataFrame) -> tuple[dict[str, np.ndarray], list[str]]:
    """Parameters and the language of each output, from rows (text, lang,
    shard)."""
    rows = saved(rows, "langid-rows")
    langs = sorted(r[0] for r in rows.select("lang").distinct().collect())
    params = initial(max(1, len(langs)))
    if not langs:
        return params, langs
    spark = rows.sparkSession
    code = F.broadcast(spark.createDataFrame([(s, i) for i, s in enumerate(langs)], "lang string, y int"))
    coded = rows.join(code, "lang").select("text", "y", "shard")
    for r in range(ROUNDS):
        got = coded.groupBy("shard").applyInArrow(_train(params, STEPS, 100 * r), "p array<double>").collect()  # SHARDS rows
        mean = np.mean([np.array(x.p) for x in got], axis=0)
        at = 0
        for k in sorted(params):
            n = params[k].size
            params[k] = mean[at:at + n].reshape(params[k].shape).astype(np.float32)
            at += n
    return params, langs


class _Known:
    """Sums of position probabilities of the pieces met so far in a task, at
    most `CACHE` of them (beyond that it starts anew)."""

    def __init__(self, params: dict, n_langs: int):
        self.params = params
        self.h = np.zeros(0, np.uint64)
        self.p = np.zeros((0, n_langs), np.float32)

    def sums(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of each piece, table of sums)."""
        u, first, back = np.unique(ta.hashes(data, s, e), return_index=True, return_inverse=True)
        at = np.searchsorted(self.h, u)
        hit = np.zeros(len(u), bool)
        inside = at < len(self.h)
        hit[inside] = self.h[at[inside]] == u[inside]
        out = np.zeros((len(u), self.p.shape[1]), np.float32)
        out[hit] = self.p[at[hit]]
        new = np.flatnonzero(~hit)
        n = (e - s)[first]
        for size in np.unique(n[new]):
            rows = new[n[new] == size]
            for part in np.array_split(rows, -(-len(rows) // 4096)):
                out[part] = label(self.params, data[s[first[part]][:, None] + np.arange(size)]).sum(axis=1)
        if len(new):
            if len(self.h) + len(new) > CACHE:
                self.h, self.p = u, out
            else:
                h, p = np.concatenate([self.h, u[new]]), np.concatenate([self.p, out[new]])
                order = np.argsort(h)
                self.h, self.p = h[order], p[order]
        return back, out


def predict(docs: DataFrame, params: dict[str, np.ndarray], langs: list[str], doc: str = "doc_id",
            text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row: the language with the largest
    mean probability over all positions (equal ones: the first in order) and
    that probability; `und` with score 0 for texts that are null or hold no
    letter, or if no language was learned."""
    small_batches(docs.sparkSession)
    src = docs.select(F.struct(F.col(f"`{doc}`").alias("doc_id"), F.coalesce(
        F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False)).alias("ok")).alias("row"), F.col(f"`{text}`").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(params, len(langs) or 1)
        for b in batches:
            ok = b.column(0).field("ok").to_numpy(zero_copy_only=False).astype(bool) & bool(langs)
            pred = np.full(b.num_rows, "und", object)
            best = np.zeros(b.num_rows)
            for lo, hi, data, offs in ta.pieces(b.column(1)):
                s, e, first = _cut(data, offs)
                if not langs or not len(s):
                    continue
                back, table = known.sums(data, s, e)
                total = np.zeros((hi - lo, table.shape[1]))
                some = np.flatnonzero(np.diff(first))
                total[some] = np.add.reduceat(table[back].astype(np.float64), first[some], axis=0)
                size = np.add.reduceat(e - s, first[some])
                mean = np.zeros_like(total)
                mean[some] = total[some] / size[:, None]
                at = mean.argmax(axis=1)
                use = ok[lo:hi]
                pred[lo:hi][use] = np.array(langs, object)[at[use]]
                best[lo:hi][use] = mean[use, at[use]]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(np.clip(best, 0, 1))],
                                             names=["row", "lang_pred", "score"])

    schema = src.select("row").schema.add("lang_pred", "string").add("score", "double")
    return src.mapInArrow(run, schema).select("row.doc_id", "lang_pred", "score")


def identify(docs: DataFrame, per_lang: int = 400, doc: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of `docs`, learned
    from its rows that are not held out and have a language.  A null id is
    neither held out nor trained on; rows may repeat; an empty table gives an
    empty result."""
    params, langs = fit(training_rows(docs, per_lang, doc, text, lang))
    out = predict(docs, params, langs, doc, text)
    return out.select("doc_id", F.expr("coalesce(pmod(crc32(cast(doc_id as string)), 4) = 2, false)").alias("held_out"),
                      "lang_pred", "score")
