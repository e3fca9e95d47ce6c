"""Repeated passages: enhanced suffix arrays and their common-prefix interval
trees, over whole texts as UTF-8 bytes.

A suffix array of all texts together cannot be built in one place, so the
suffixes are first parted such that those that begin with the same MIN_LEN
bytes are together, and those that cannot repeat are left out:

* Every window of MIN_LEN bytes has an anchor: the leftmost of its GRAM-byte
  strings with the smallest hash.  Equal windows have equal anchors at equal
  places.  The windows of a text with the same anchor occurrence are adjacent
  and form a segment of fewer than 2 MIN_LEN bytes.  Segments are keyed by the
  hash of the anchor; a key met once in all texts holds no repeat.
* Equal segments under a key are one, represented by their earliest
  occurrence; in all others every window has an earlier copy.  Most repeated
  text (copies, the inside of shared passages) ends here.
* What is left, the different segments of a key, is dealt out by key.  A task
  sorts the suffixes that start at the windows of its segments, takes common
  prefixes of neighbours, and scans them with a stack: the intervals of the
  common-prefix tree with at least MIN_LEN bytes are the repeat groups, with
  every suffix of the interval as an occurrence.  An interval whose
  occurrences have different bytes before them (or a text start) is not part
  of a longer repeat to the left; those are reported as groups.  When an
  interval closes, every child's earliest occurrence but the earliest of all
  is a repeat of the interval's length.
* A key with more than `CAP` different segments (the rim of a passage that a
  large part of all texts share) is not put into one task: its windows are
  counted by content, combined before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import textarrays as ta
from tidemark.llm.common import bounded_broadcast, saved, small_batches

MIN_LEN, GRAM = 100, 32
BUCKET, CAP = 4000, 10_000
NO_ID = 2**63 - 1
U = np.uint64


def _hash_all(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Running polynomial sums of the bytes, and inverse powers."""
    fwd, inv = ta._Pow.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, U)
    with np.errstate(over="ignore"):
        np.cumsum(ta.BYTE[data] * fwd[:-1], out=total[1:])
    return total, inv, fwd


def segments(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray] | None:
    """Segments of whole texts: anchor key, hash of the segment, text index,
    start in the text, number of windows."""
    n_grams, span = len(data) - GRAM + 1, MIN_LEN - GRAM + 1
    n_win = len(data) - MIN_LEN + 1
    if n_win <= 0:
        return None
    total, inv, _ = _hash_all(data)
    with np.errstate(over="ignore"):
        h = ta.mix((total[GRAM:] - total[:-GRAM]) * inv[:n_grams])
    x = (h & U(0xFFFFFFFF00000000)) | np.arange(n_grams, dtype=U)
    size = 1
    while size * 2 <= span:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    if size < span:
        x = np.minimum(x[:len(x) - (span - size)], x[span - size:])
    anchor = (x & U(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:n_win]
    ok = np.arange(n_win) + MIN_LEN <= offs[1:][text]
    at = np.flatnonzero(ok)
    if not len(at):
        return None
    new = np.ones(len(at), bool)
    new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (text[at[1:]] != text[at[:-1]])
    lo = at[new]
    n = np.diff(np.append(np.flatnonzero(new), len(at)))
    end = lo + n - 1 + MIN_LEN
    with np.errstate(over="ignore"):
        seg = ta.mix((total[end] - total[lo]) * inv[lo] + n.astype(U) * ta.MIX[20])
    return {"key": h[anchor[lo]], "seg": seg, "text": text[lo], "lo": lo - offs[text[lo]], "n": n}


def _again(name: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which rows have an earlier row (doc, at) of the same name; rows that
    are wholly equal are one document's and count as one."""
    order = np.lexsort((at, doc, name))
    n, d, a = name[order], doc[order], at[order]
    head = np.append(True, n[1:] != n[:-1])
    first = np.maximum.accumulate(np.where(head, np.arange(len(n)), 0))
    out = np.empty(len(n), bool)
    out[order] = (d != d[first]) | (a != a[first])
    return out


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of a batch.  One that has an earlier copy in its batch is a
    repeat whatever else there is: it is marked and dealt out by a hash of its
    place, so a passage that a third of all texts share sends its key's task
    one row a batch, not one an occurrence."""
    for b in batches:
        doc, tie = b.column(0).to_numpy(), b.column(1).to_numpy()
        found = []
        for lo, _, data, offs in ta.pieces(b.column(2)):
            s = segments(data, offs)
            if s is not None:
                row = lo + s["text"]
                found.append((s["key"], s["seg"], doc[row], tie[row] << 39 | s["lo"] << 7 | (s["n"] - 1)))
        if not found:
            continue
        key, seg, d, at = (np.concatenate(x) for x in zip(*found))
        again = _again(ta.mix(key ^ ta.mix(seg ^ ta.MIX[21])), d, at)
        spread = ta.mix(d.view(U) ^ ta.mix(at.view(U) ^ ta.MIX[22]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(again, spread, key).view(np.int64)), pa.array(seg.view(np.int64)), pa.array(d), pa.array(at),
             pa.array(again)], names=["key", "seg", "doc", "at", "again"])


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of wanted segments, with the byte before (-1 at a text start)."""
    for b in batches:
        doc, text = b.column(0).to_numpy(), b.column(1)
        data, offs = ta.texts(text)
        want = b.column(2)
        ends = np.asarray(want.offsets)
        flat = want.flatten()
        key, at = flat.field("key").to_numpy(), flat.field("at").to_numpy()
        ends = ends - ends[0]
        row = np.repeat(np.arange(b.num_rows), np.diff(ends))
        lo = offs[row] + (at >> 7 & 0xFFFFFFFF)
        end = lo + (at & 127) + MIN_LEN
        before = np.where(at >> 7 & 0xFFFFFFFF, data[np.maximum(lo - 1, 0)].astype(np.int16), -1).astype(np.int16)
        for part in np.array_split(np.arange(len(lo)), -(-len(lo) // 20000) or 1):
            if len(part):
                raw = [data[i:j].tobytes() for i, j in zip(lo[part], end[part])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[part]), pa.array(doc[row[part]]), pa.array(at[part]), pa.array(raw, pa.binary()),
                     pa.array(before[part])], names=["key", "doc", "at", "raw", "before"])


class SuffixArray:
    """Sorted suffixes that start at `starts` of the bytes `data`, with the
    common prefix of each with the one before, neither reaching past `stops`.
    Built by doubling ranks from 8 to 128 bytes; prefixes are compared up to
    twice that."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray):
        pad = np.concatenate([data, np.zeros(300, np.uint8)])
        n = len(data) + 136
        word = np.zeros(n + 128, U)
        for j in range(8):
            part = pad[j:j + n]
            word[:len(part)] |= part.astype(U) << U(56 - 8 * j)
        self.ranks = []
        rank, size = np.unique(word, return_inverse=True)[1], 8
        while size <= 64:
            self.ranks.append((size, rank))
            pair = rank.astype(U) << U(32)
            pair[:-size] |= rank[size:].astype(U)
            rank, size = np.unique(pair, return_inverse=True)[1], 2 * size
        self.ranks.append((size, rank))
        self.order = np.lexsort((rank[np.minimum(starts + size, len(rank) - 1)], rank[starts]))
        self.start = starts[self.order]
        self.stop = stops[self.order]
        a, b = self.start[:-1], self.start[1:]
        room = np.minimum(self.stop[:-1] - a, self.stop[1:] - b)
        lcp = np.zeros(len(a), np.int64)
        for size, rank in reversed([*self.ranks, self.ranks[-1]]):
            i, j = np.minimum(a + lcp, len(rank) - 1), np.minimum(b + lcp, len(rank) - 1)
            lcp += size * ((rank[i] == rank[j]) & (lcp + 0 < room))
        for _ in range(7):
            i, j = np.minimum(a + lcp, len(pad) - 1), np.minimum(b + lcp, len(pad) - 1)
            lcp += (pad[i] == pad[j]) & (lcp < room)
        self.lcp = np.concatenate([[0], np.minimum(lcp, room)])


def interval_tree(lcp: np.ndarray, first: np.ndarray, before: np.ndarray, least: int
                  ) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
    """Stack scan of one run of a suffix array (lcp[0] ignored, all others at
    least `least`).  first: rank of each suffix by place in the input; before:
    the byte before it.  Returns the repeats (suffix, length) that are not the
    earliest occurrence, one a suffix, and the left-diverse intervals (length,
    first suffix, end suffix)."""
    repeats, groups = [], []
    stack: list[list] = []                                   # [lcp, left, earliest, byte before or None if diverse]

    def leaf(i: int):
        return i, (None if before[i] < 0 else before[i])

    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else least - 1
        left, (low, byte) = i - 1, leaf(i - 1)
        while stack and stack[-1][0] > now:
            size, left, top, b = stack.pop()
            repeats.append((low if first[low] > first[top] else top, size))
            low = low if first[low] < first[top] else top
            byte = byte if byte == b else None
            if byte is None:
                groups.append((size, left, i))
        if i == len(lcp):
            break
        if stack and stack[-1][0] == now:
            size, left, top, b = stack[-1]
            repeats.append((low if first[low] > first[top] else top, size))
            stack[-1] = [size, left, low if first[low] < first[top] else top, byte if byte == b else None]
        else:
            stack.append([now, left, low, byte])
    return repeats, groups


def _scan(report: bool):
    schema = pa.schema([("grp", pa.int64()), ("size", pa.int32()), ("doc", pa.int64()), ("at", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc", "ascending"), ("at", "ascending")])
        at, doc = t.column("at").to_numpy(), t.column("doc").to_numpy()
        new = np.append(True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]))    # rows that repeat count once
        t = t.filter(pa.array(new))
        data, offs = ta.texts(t.column("raw"))
        at, doc = t.column("at").to_numpy(), t.column("doc").to_numpy()
        n = (at & 127) + 1
        seg = np.repeat(np.arange(len(n)), n)
        shift = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
        starts = offs[seg] + shift
        sa = SuffixArray(data, starts, offs[1:][seg])
        seg, shift = seg[sa.order], shift[sa.order]
        place = (at >> 7 & 0xFFFFFFFF)[seg] + shift
        first = np.empty(len(seg), np.int64)
        first[np.lexsort((place, at[seg] >> 39, doc[seg]))] = np.arange(len(seg))
        before = np.where(shift > 0, data[np.maximum(sa.start - 1, 0)].astype(np.int64), t.column("before").to_numpy()[seg])
        long = sa.lcp >= MIN_LEN
        run_lo = np.flatnonzero(~long)                       # a run begins where the common prefix is short
        run_hi = np.append(run_lo[1:], len(long))
        some = run_hi - run_lo > 1
        rep_i, rep_n, groups = [], [], []
        for lo, hi in zip(run_lo[some], run_hi[some]):
            reps, grps = interval_tree(sa.lcp[lo:hi].tolist(), first[lo:hi].tolist(), before[lo:hi].tolist(), MIN_LEN)
            for i, size in reps:
                rep_i.append(lo + i)
                rep_n.append(size)
            if report:
                groups += [(size, lo + a, lo + b) for size, a, b in grps]
        if not report:
            i = np.array(rep_i, np.int64)
            out = (np.full(len(i), -1), np.array(rep_n, np.int32), doc[seg[i]], (at[seg[i]] >> 39 << 32) | place[i])
        else:
            i = np.concatenate([np.arange(a, b) for _, a, b in groups]) if groups else np.zeros(0, np.int64)
            c = np.array([b - a for _, a, b in groups], np.int64)
            # the group's name: content and length
            names = np.array([int.from_bytes(hashlib.blake2b(data[sa.start[a]:sa.start[a] + size].tobytes(), digest_size=8)
                                             .digest(), "little", signed=True) for size, a, _ in groups], np.int64)
            out = (np.repeat(names, c), np.repeat(np.array([g[0] for g in groups], np.int32), c), doc[seg[i]],
                   (at[seg[i]] >> 39 << 32) | place[i])
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema)], schema=schema)
    return run


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a window: content digest (two hashes) and place."""
    for b in batches:
        data, offs = ta.texts(b.column(0))
        doc, at = b.column(1).to_numpy(), b.column(2).to_numpy()
        n = (at & 127) + 1
        for part in np.array_split(np.arange(len(n)), -(-len(n) // 2000) or 1):
            if not len(part):
                continue
            seg = np.repeat(part, n[part])
            shift = np.arange(len(seg)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
            base = offs[part[0]]
            piece = data[base:offs[part[-1] + 1]]
            s = offs[seg] + shift - base
            one = ta.hashes(piece, s, s + MIN_LEN)
            two = ta.hashes(piece, s, s + MIN_LEN, ta.BYTE[::-1])
            place = (at[seg] >> 39 << 32) | ((at[seg] >> 7 & 0xFFFFFFFF) + shift)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(doc[seg]), pa.array(place)],
                names=["one", "two", "doc", "place"])


def _source(docs: DataFrame, doc: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{doc}`").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.expr(f"pmod(xxhash64(`{text}`), {1 << 24})").alias("tie"), F.col(f"`{text}`").alias("text"))


def _repeating(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """Segments whose key occurs more than once: (key, seg, doc, at, early,
    mixed); early: the first occurrence of its segment.  Those with an earlier
    copy in their batch have a key of their own."""
    src = _source(docs, doc, text)
    rows = src.where("length(text) > 0").mapInArrow(_segment_rows, "key long, seg long, doc long, at long, again boolean")
    same, key = Window.partitionBy("key", "seg", "again"), Window.partitionBy("key", "again")
    # one shuffle and one sort of narrow rows for both windows
    rows = rows.repartition("key", "again").withColumn("first", F.min(F.struct("doc", "at")).over(same))
    rows = (rows.withColumn("n", F.count(F.lit(1)).over(key)).withColumn("lo", F.min("seg").over(key))
            .withColumn("hi", F.max("seg").over(key)).where("n > 1 or again"))
    return rows.select("key", "seg", "doc", "at", F.expr("not again and first.doc = doc and first.at = at").alias("early"),
                       F.expr("not again and lo <> hi").alias("mixed"))


def _different(docs: DataFrame, repeating: DataFrame, doc: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Bytes of the first occurrences of segments that share their key with
    others: (those to be sorted, those of keys with too many)."""
    open_ = repeating.where("early and mixed").select("key", "doc", "at").distinct()
    want = open_.groupBy("doc", F.expr("shiftright(at, 39)").alias("tie")).agg(
        F.sort_array(F.collect_list(F.struct("key", "at"))).alias("want"))      # bounded by the text
    rows = _source(docs, doc, text).join(want, ["doc", "tie"]).select("doc", "text", "want").mapInArrow(
        _cut_rows, "key long, doc long, at long, raw binary, before short")
    rows = saved(rows, "rep-different")
    size = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n_seg"))
    many = bounded_broadcast(saved(size.where(F.col("n_seg") > CAP).select("key"), "rep-many"))
    return rows.join(many, "key", "left_anti"), rows.join(many, "key", "left_semi")


def _bucketed(rows: DataFrame) -> DataFrame:
    n = rows.count()
    return rows.withColumn("bucket", F.expr(f"pmod(xxhash64(key), {max(1, -(-n // BUCKET))})"))


_GROUPS = "grp long, size int, doc long, at long"


def repeat_groups(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(group, size, doc_id, start): all occurrences of the repeat groups among
    different segments: strings of `size` >= MIN_LEN bytes that occur at least
    twice and whose occurrences differ in the byte before.  Repeats longer
    than a segment appear as the group of their first bytes.  Occurrences in
    segments that are wholly equal to an earlier one are not listed again, nor
    are keys above CAP; `spans` covers both."""
    small_batches(docs.sparkSession)
    rep = saved(_repeating(docs, doc, text), "rep-segments")
    few, _ = _different(docs, rep, doc, text)
    out = _bucketed(few).groupBy("bucket").applyInArrow(_scan(True), _GROUPS)
    return out.select(F.col("grp").alias("group"), "size", F.expr(f"nullif(doc, {NO_ID})").alias("doc_id"),
                      F.expr("at & 4294967295").alias("start"))


def spans(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, tie, s, e): byte ranges that are repeats of earlier text; they may
    overlap.  (doc, tie) names the rows of `_source`."""
    small_batches(docs.sparkSession)
    rep = saved(_repeating(docs, doc, text), "rep-segments")
    whole = rep.where("not early").select("doc", F.expr("shiftright(at, 39)").alias("tie"),
                                          F.expr("shiftright(at, 7) & 4294967295").alias("s"),
                                          F.expr(f"(shiftright(at, 7) & 4294967295) + (at & 127) + {MIN_LEN}").alias("e"))
    few, many = _different(docs, rep, doc, text)
    scanned = _bucketed(few).groupBy("bucket").applyInArrow(_scan(False), _GROUPS).select(
        "doc", F.expr("shiftright(at, 32)").alias("tie"), F.expr("at & 4294967295").alias("s"),
        F.expr("(at & 4294967295) + size").alias("e"))
    windows = saved(many.select("raw", "doc", "at").mapInArrow(
        _window_rows, "one long, two long, doc long, place long"), "rep-windows")
    firsts = windows.groupBy("one", "two").agg(F.min(F.struct("doc", "place")).alias("first"),
                                               F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    counted = windows.join(firsts, ["one", "two"]).where("first.doc <> doc or first.place <> place").select(
        "doc", F.expr("shiftright(place, 32)").alias("tie"), F.expr("place & 4294967295").alias("s"),
        F.expr(f"(place & 4294967295) + {MIN_LEN}").alias("e"))
    return whole.unionByName(scanned).unionByName(counted)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offs = ta.texts(b.column(1))
        found = b.column(2)
        n_bytes, n_removed, n_spans, digest, kept = [], [], [], [], []
        for i in range(b.num_rows):
            part = data[offs[i]:offs[i + 1]]
            if found[i].is_valid:
                r = found.slice(i, 1).flatten()
                edge = np.zeros(len(part) + 1, np.int64)
                np.add.at(edge, r.field("s").to_numpy(), 1)
                np.add.at(edge, r.field("e").to_numpy(), -1)
                gone = np.cumsum(edge[:-1]) > 0
                s, _ = ta.runs(gone, np.array([0, len(part)]))
                left = part[~gone].tobytes()
                n_removed.append(int(gone.sum()))
                n_spans.append(len(s))
            else:
                left = part.tobytes()
                n_removed.append(0)
                n_spans.append(0)
            n_bytes.append(len(part))
            digest.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
             pa.array(digest, pa.string()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row
    of `docs`: the text without every byte that lies in a MIN_LEN-byte string
    which also starts earlier (smaller doc_id, or earlier in the same text).

    Null and empty texts have no bytes; texts shorter than MIN_LEN stay
    whole.  Ids are integers; a null id sorts last.  Texts that share an id
    are ordered by a hash; rows with equal id and text count as one document
    and get the same result each.  An empty table gives an empty result.
    """
    found = spans(docs, doc, text).groupBy("doc", "tie").agg(F.collect_list(F.struct("s", "e")).alias("found"))
    src = _source(docs, doc, text).join(found, ["doc", "tie"], "left")
    return (src.select("doc", "text", "found")
            .mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
            .withColumn("doc_id", F.expr(f"nullif(doc_id, {NO_ID})")))
