"""Fuzzy line deduplication.

Lines are normalised to their words (runs of letters, digits and non-ASCII
signs; A-Z lower-cased, digits alike).  Lines of equal words are one.  The
distinct words of a line are dealt by hash to 2, 4, 8, ... classes of 4 to 8 words
on average, more classes for longer lines; the 64-bit SimHash of a class is a
block, and lines that agree on a block meet.  Each word that only one of two
lines holds spoils one block, so by the pigeonhole principle lines meet that
differ in fewer words than there are blocks (of at least `LEAST` = 4 words; every
line has one).  Lines near a change of the number of classes have the blocks
of both.  Lines of at most `FEW` = 8 different words meet where all words but one
agree.  Meetings are tested on the 128-bit SimHash of the line (at most
`BITS_OFF` = 36 bits apart) and confirmed by edit similarity of the normalised
lines.  Of every connected group of lines one occurrence is kept: the earliest
by document and place.

Of the pairs that brute force on edit similarity alone finds among 7,601
different lines (293 of 0.8 or more, 241 of 0.9, 160 of 0.95) this met 0.95, 0.97 and
0.98 (a trial in which lines of two words met on one, too), with 8 keys a line; about 3,000 pairs of 76,606 lines met by chance (1 in
a million), nearly all beyond 36 bits.

Whole lines and whole texts are used; a block value that many lines share is
worked through a hub and in blocks of bounded size, never as all pairs.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import lists as ls
from tidemark.llm import textarrays as ta
from tidemark.llm.common import bounded_broadcast, components, saved, small_batches

BITS_OFF, TINY, SHORT, BLOCK, BLOCK_CHARS = 36, 4, 32, 500, 4_000_000
CLASS, LEAST, FEW = 4, 4, 8
NO_ID = 2**63 - 1
LINE = "id long, id2 long, s1 long, s2 long, doc long, at long, keys array<long>"

_norm = np.arange(256, dtype=np.uint8)
_norm[65:91] += 32
_norm[48:58] = 48
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BYTE = ta.BYTE[_norm]
# each bit of a byte in a byte lane of its own, so that up to 255 words add up in one 64-bit sum
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def lines_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines (parted by \\n; an empty text has none),
    and their ranges by text."""
    cut = np.flatnonzero(data == 10)
    filled = np.diff(offs) > 0
    starts = np.sort(np.concatenate([offs[:-1][filled], cut + 1]))
    # a line that starts at the end of its text is empty; it must come before the next text's first
    ends = np.sort(np.concatenate([cut, offs[1:][filled]]))
    n = np.searchsorted(cut, offs)
    count = np.diff(n) + filled
    return starts, ends, np.concatenate([[0], np.cumsum(count)])


def simhash(words: np.ndarray, at: np.ndarray, n: np.ndarray, halves: int = 2) -> np.ndarray:
    """SimHash (`halves` uint64) of each run of word hashes (starts, lengths; no
    empty run): a bit is set if it is in more than half of the words."""
    owner = np.repeat(np.arange(len(n)), -(-n // 255))
    part = np.arange(len(owner)) - np.repeat(np.cumsum(-(-n // 255)) - -(-n // 255), -(-n // 255))
    sub = at[owner] + 255 * part
    first = np.flatnonzero(part == 0)
    out = np.zeros((len(n), halves), np.uint64)
    for half in range(halves):
        h = words if half == 0 else ta.mix(words ^ ta.MIX[30])
        bits = np.zeros((len(n), 64), bool)
        raw = h.view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            lanes = np.add.reduceat(_LANES[raw[:, byte]], sub)
            count = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
            bits[:, 8 * byte:8 * byte + 8] = 2 * count > n[:, None]
        out[:, half] = np.packbits(bits, axis=1).view(np.uint64).ravel()
    return out


def distinct_words(words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of each line (`n` words each, one line after the
    other), sorted, and their numbers."""
    line = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((words, line))
    words, line = words[order], line[order]
    new = np.concatenate([[True], (words[1:] != words[:-1]) | (line[1:] != line[:-1])])
    return words[new], np.bincount(line[new], minlength=len(n))


def block_keys(words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys under which each line (`n` distinct words each, one line after
    the other) meets others, and their numbers."""
    line = np.repeat(np.arange(len(n)), n)
    owner, key = [], []
    level = [np.floor(np.log2(np.maximum(n * more, CLASS) / CLASS)).astype(np.int64) for more in (1, 1.25)]
    place = ta.mix(words ^ ta.MIX[41])
    for k, some in ((level[0], n > FEW), (level[1], (n > FEW) & (level[1] > level[0]))):
        w = np.flatnonzero(some[line])
        if not len(w):
            continue
        deep = k[line[w]].astype(np.uint64)
        part = (place[w] & ((np.uint64(1) << deep) - np.uint64(1))) | deep << np.uint64(32)
        order = np.lexsort((part, line[w]))
        w, part = w[order], part[order]
        at = np.flatnonzero(np.concatenate([[True], (line[w][1:] != line[w][:-1]) | (part[1:] != part[:-1])]))
        count = np.diff(np.append(at, len(w)))
        sim = simhash(words[w], at, count, 1)[:, 0]
        full = count >= LEAST
        owner.append(line[w][at][full])
        key.append(ta.mix(sim ^ ta.mix(part[at]))[full])
    digest = ta.mix(words ^ ta.MIX[42])
    total = np.add.reduceat(digest, np.cumsum(n) - n) if len(n) else digest
    few = np.flatnonzero(n <= FEW)
    owner.append(few)
    key.append(ta.mix(total[few]))
    but_one = np.flatnonzero(((n > 2) & (n <= FEW + 1))[line])
    owner.append(line[but_one])
    key.append(ta.mix(total[line[but_one]] - digest[but_one]))
    owner, key = np.concatenate(owner), np.concatenate(key)
    return key[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(n))


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        doc, tie = b.column(0).to_numpy(), b.column(1).to_numpy()
        for lo, _, data, offs in ta.pieces(b.column(2)):
            if not len(data):
                continue
            starts, ends, first = lines_of(data, offs)
            s, e = ta.runs(WORD[data], offs)
            words = ta.hashes(data, s, e, _BYTE)
            a, z = np.searchsorted(s, starts), np.searchsorted(s, ends)
            row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
            place = np.arange(len(starts)) - first[:-1][row]
            some = np.flatnonzero(z > a)
            if not len(some):
                continue
            a, n, row, place = a[some], (z - a)[some], row[some], place[some]
            single, m = distinct_words(words, n)        # every word is in one of these lines
            sim = simhash(single, np.cumsum(m) - m, m)
            keys, n_keys = block_keys(single, m)
            with np.errstate(over="ignore"):
                fwd, inv = ta._Pow.upto(len(words) + 1)
                ids = []
                for salt in (31, 32):
                    total = np.zeros(len(words) + 1, np.uint64)
                    np.cumsum(ta.mix(words ^ ta.MIX[salt]) * fwd[:-1], out=total[1:])
                    ids.append(ta.mix((total[a + n] - total[a]) * inv[a] + n.astype(np.uint64) * ta.MIX[salt]))
            i64 = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
            keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_keys)]).astype(np.int32)), i64(keys))
            yield pa.RecordBatch.from_arrays(
                [i64(ids[0]), i64(ids[1]), i64(sim[:, 0]), i64(sim[:, 1]), pa.array(doc[lo + row]),
                 pa.array(tie[lo + row] << 39 | place), keys], names=["id", "id2", "s1", "s2", "doc", "at", "keys"])


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Normalised text of wanted lines."""
    for b in batches:
        want = b.column(1)
        for i in range(b.num_rows):
            raw = _norm[np.frombuffer((b.column(0)[i].as_py() or "").encode(), np.uint8)]
            starts, ends, _ = lines_of(raw, np.array([0, len(raw)]))
            w = want.slice(i, 1).flatten()
            out = []
            for at in w.field("at").to_numpy() & (2**39 - 1):
                line = raw[starts[at]:ends[at]]
                keep = WORD[line]
                line = np.where(keep, line, np.uint8(32))
                out.append(" ".join(line.tobytes().decode("utf-8", "replace").split(" ")).strip())
            out = [" ".join(x.split()) for x in out]
            yield pa.RecordBatch.from_arrays([w.field("id"), pa.array(out, pa.string())], names=["id", "line"])


def script_cost(a: str, b: str) -> int:
    """Length of one edit script between two lines, so at least their edit
    distance: words that each line holds once, in common order, stay, and what
    lies between is replaced, but for the words it begins and ends with alike."""
    wa, wb = a.split(" "), b.split(" ")
    ca, cb = Counter(wa), Counter(wb)
    where = {w: j for j, w in enumerate(wb) if cb[w] == 1}
    ends, best, before = [], [], {}         # longest increasing run of places in b
    for i, w in enumerate(wa):
        j = where.get(w) if ca[w] == 1 else None
        if j is not None:
            k = bisect_left(ends, j)
            before[j] = (i, best[k - 1] if k else None)
            ends[k:k + 1], best[k:k + 1] = [j], [j]
    stay, j = [(len(wa), len(wb))], best[-1] if best else None
    while j is not None:
        i, last = before[j]
        stay.append((i, j))
        j = last
    cost, i, j = 0, 0, 0
    for x, y in reversed(stay):
        hi, hj = x, y
        while i < hi and j < hj and wa[i] == wb[j]:
            i, j = i + 1, j + 1
        while i < hi and j < hj and wa[hi - 1] == wb[hj - 1]:
            hi, hj = hi - 1, hj - 1
        cost += max(sum(map(len, wa[i:hi])) + hi - i, sum(map(len, wb[j:hj])) + hj - j)
        i, j = x + 1, y + 1
    return cost


def within(a: str, b: str, room: int) -> bool:
    """Whether the edit distance of two lines is at most `room`: a script as
    short is enough; where none is found, the distance itself by columns of bits
    (Myers), up to where the diagonal of the end exceeds the room, as no diagonal
    ever descends."""
    if abs(len(a) - len(b)) > room:
        return False
    if script_cost(a, b) <= room:
        return True
    lo, hi, most = 0, 0, min(len(a), len(b))
    while lo < most and a[lo] == b[lo]:
        lo += 1
    while hi < most - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo:len(a) - hi], b[lo:len(b) - hi]
    n, ahead, at = len(a), len(b) - len(a), {}
    for i, c in enumerate(a):
        at.setdefault(c, []).append(i)
    if n > 2000:                                    # one bit after the other would copy the whole mask each time
        masks = {}
        for c, places in at.items():
            bits = np.zeros(n, np.uint8)
            bits[places] = 1
            masks[c] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    else:
        masks = {c: sum(1 << i for i in places) for c, places in at.items()}
    full = (1 << n) - 1
    up, down = full, 0                              # rows where the column ascends and descends by one
    for j, c in enumerate(b, 1):
        same = masks.get(c, 0)
        v = same | down
        h = (((same & up) + up) ^ up) | same
        right = down | (full & ~(h | up))
        left = up & h
        right = right << 1 | 1
        up = (left << 1 | ~(v | right)) & full
        down = right & v & full
        if j % 32 == 0 and j > ahead:
            above = (1 << min(n, j - ahead)) - 1
            if j + (up & above).bit_count() - (down & above).bit_count() > room:
                return False
    return len(b) + up.bit_count() - down.bit_count() <= room


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (columns 0 and 1) whose lines are within the room."""
    for b in batches:
        la, lb, room = (b.column(i).to_pylist() for i in (2, 3, 4))
        close = pa.array([within(x, y, r) for x, y, r in zip(la, lb, room)], pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(close)


def _earlier(t: pa.Table) -> np.ndarray:
    """Bits of each row's lists (`lists`) that come before this one (`key`)."""
    lists = t.column("lists").combine_chunks()
    flat, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    before = flat < t.column("key")[0].as_py()
    _, column = np.unique(flat[before], return_inverse=True)
    out = np.zeros((len(lists), column.max(initial=-1) // 8 + 1), np.uint8)
    np.bitwise_or.at(out, (owner[before], column // 8), np.left_shift(1, column % 8).astype(np.uint8))
    return out


def _block(similarity: float):
    """Task that links the lines of one block pair of a list: pairs within the
    distance that are not linked yet, each in the first list that both are in."""
    def run(t: pa.Table) -> pa.Table:
        comp, side, ids = (t.column(c).to_numpy() for c in ("comp", "side", "id"))
        sig = np.stack([t.column("s1").to_numpy(), t.column("s2").to_numpy()], axis=1).view(np.uint64)
        line, earlier = t.column("line").to_pylist(), _earlier(t)
        size = np.array([len(x) for x in line])
        comp = np.unique(comp, return_inverse=True)[1]
        right, a, b = np.flatnonzero(side != 1), [], []
        for i in np.flatnonzero(side != 2):
            other = right[comp[right] != comp[i]]
            room = np.floor(np.maximum(size[other], size[i]) * (1 - similarity) + 1e-9).astype(np.int64)
            may = (np.bitwise_count(sig[other] ^ sig[i]).sum(axis=1) <= BITS_OFF) & (np.abs(size[other] - size[i]) <= room)
            if side[i] == 0:
                may &= ids[other] > ids[i]
            may[may] &= ~(earlier[other[may]] & earlier[i]).any(axis=1)
            for j, r in zip(other[may].tolist(), room[may].tolist()):
                if comp[j] != comp[i] and within(line[i], line[j], r):
                    comp[comp == comp[j]] = comp[i]
                    a.append(min(ids[i], ids[j]))
                    b.append(max(ids[i], ids[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _source(docs: DataFrame, doc: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{doc}`").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.expr(f"pmod(xxhash64(`{text}`), {1 << 24})").alias("tie"), F.col(f"`{text}`").alias("text"))


def links(src: DataFrame, different: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between different lines (id, s1, s2, doc, at, keys).

    Keys are counted first, as bare numbers; only lines that meet another are
    then dealt out with their SimHash.  In the shortest lists all pairs are tested
    for the distance where they meet; others go through a hub, and what that
    leaves apart is compared in pairs or, in long lists, in blocks."""
    keys = F.explode("keys").alias("key")
    size = saved(different.select(keys).groupBy("key").agg(F.count(F.lit(1)).alias("len")).where("len > 1"), "line-keys")
    lists = saved(different.select("id", "s1", "s2", keys).join(bounded_broadcast(size, 1_000_000), "key"), "line-lists")
    few = lists.where(f"len <= {TINY}").select("key", "id", "s1", "s2")
    near = saved(few.join(few.toDF("key", "id2", "t1", "t2"), "key")
                 .where(f"id < id2 and bit_count(s1 ^ t1) + bit_count(s2 ^ t2) <= {BITS_OFF}")
                 .select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct(), "line-near")
    long = lists.where(f"len > {TINY}")
    active = near.select(F.explode(F.array("a", "b")).alias("id")).union(long.select("id")).distinct()
    active = saved(active.join(different.drop("keys"), "id"), "line-active")
    want = active.groupBy("doc", F.expr("shiftright(at, 39)").alias("tie")).agg(
        F.collect_list(F.struct("id", "at")).alias("want"))                     # bounded by the text
    want = bounded_broadcast(saved(want, "line-wanted"), 200_000, "want")
    text = saved(src.join(want, ["doc", "tie"]).select("text", "want")
                 .mapInArrow(_text_rows, "id long, line string").dropDuplicates(["id"]), "line-texts")

    def similar(pairs: DataFrame) -> DataFrame:
        both = pairs.join(text.toDF("a", "la"), "a").join(text.toDF("b", "lb"), "b")
        room = F.expr(f"cast(floor(greatest(length(la), length(lb)) * {1 - similarity} + 1e-9) as int)")
        both = both.select("a", "b", "la", "lb", room.alias("room")).where("abs(length(la) - length(lb)) <= room")
        return both.mapInArrow(_close, "a long, b long")

    def confirm(pairs: DataFrame) -> DataFrame:
        s = active.select("id", "s1", "s2")
        return similar(pairs.join(s.toDF("a", "s1", "s2"), "a").join(s.toDF("b", "t1", "t2"), "b")
                       .where(f"bit_count(s1 ^ t1) + bit_count(s2 ^ t2) <= {BITS_OFF}").select("a", "b"))

    def far(rows: DataFrame) -> DataFrame:
        # the lines themselves go to the blocks, so that of a block only links come back and no pairs
        lists = rows.groupBy("id").agg(F.sort_array(F.collect_list("key")).alias("lists"))     # bounded by the line's keys
        rows = saved(rows.join(lists, "id").join(active.select("id", "s1", "s2"), "id").join(text, "id"), "line-far")
        chars = rows.groupBy("key").agg(F.sum(F.length("line")).alias("chars"))
        full = ls.block_pairs(rows.join(chars, "key"), f"ceil(greatest(len / {BLOCK}, chars / {BLOCK_CHARS}))").drop("chars")
        full = full.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "bi", "bj")
        return full.groupBy("key", "bi", "bj").applyInArrow(_block(similarity), "a long, b long").distinct()

    found = similar(near)
    if long.isEmpty():
        return found
    # the hub of a list is its member that meets most others in all
    score = long.groupBy("id").agg(F.sum("len").alias("score"))
    long = saved(long.select("key", "id", "len").join(score, "id"), "line-long")
    return found.union(ls.connect(long, confirm, far, short=SHORT, name="line"))


def dropped(docs: DataFrame, similarity: float = 0.8, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, tie, places): the lines of each text that repeat an earlier one;
    (doc, tie) names the rows of `_source`."""
    small_batches(docs.sparkSession)
    src = _source(docs, doc, text)
    rows = saved(src.where("text <> ''").mapInArrow(
        _line_rows, LINE), "lines")
    different = saved(rows.groupBy("id", "id2").agg(F.min(F.struct("doc", "at")).alias("p"), F.first("s1").alias("s1"),
                                                    F.first("s2").alias("s2"), F.first("keys").alias("keys"),
                                                    F.count(F.lit(1)).alias("n"))
                      .select("id", "s1", "s2", "p.doc", "p.at", "keys", "n"), "lines-different")
    roots = components(links(src, different.drop("n"), similarity)).withColumnRenamed("node", "id")
    grouped = saved(different.join(roots, "id"), "line-groups")
    first = grouped.groupBy("root").agg(F.min(F.struct("doc", "at")).alias("p"))
    grouped = grouped.select("id", "root").join(first, "root").select("id", "p.doc", "p.at")
    alone = different.where("n > 1").join(grouped.select("id"), "id", "left_anti").select("id", "doc", "at")
    kept = grouped.union(alone).toDF("id", "kept_doc", "kept_at")
    gone = rows.select("id", "doc", "at").join(kept, "id").where("doc <> kept_doc or at <> kept_at")
    return gone.groupBy("doc", F.expr("shiftright(at, 39)").alias("tie")).agg(
        F.collect_set(F.expr(f"cast(at & {2**39 - 1} as int)")).alias("places"))


def keep_first_lines(docs: DataFrame, similarity: float = 0.8, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the column `text` reduced to the lines that are the kept
    occurrence of their group, and the new columns n_lines and n_dropped.

    Two lines are linked when they agree on a block, their SimHashes differ in
    at most 36 of 128 bits, and the edit distance of the normalised lines is at
    most 1 - `similarity` of the longer one.  Lines of one or two different words
    meet lines of the same words, or of one word more.  Lines without a word
    stay.  Null stays null; an empty text has no lines.  Ids are integers; a null id sorts last.  Texts that
    share an id are ordered by a hash; rows with equal id and text count as
    one document and get the same result each.  Columns of other names are
    kept as they are, n_lines and n_dropped are replaced; an empty table gives
    an empty result.
    """
    gone = bounded_broadcast(saved(dropped(docs, similarity, doc, text), "line-gone"), 1_000_000, "places", 4_000_000)
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    full = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                       F.coalesce(F.col(f"`{doc}`").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.expr(f"pmod(xxhash64(`{text}`), {1 << 24})").alias("tie"))
    full = full.join(gone, ["doc", "tie"], "left").withColumn("t", F.col("row").getField(text))
    # the text is split once: its lines are bound to s
    left = F.expr("""case when places is null then t else transform(array(split(t, '\\n', -1)), s -> array_join(transform(
        array_except(sequence(0, size(s) - 1), places), i -> s[i]), '\\n'))[0] end""")
    cols = [left.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in keep]
    return full.select(*cols, F.expr("cast(case when t <> '' then length(t) - length(replace(t, '\\n', '')) + 1 else 0 end as long)").alias("n_lines"),
                       F.expr("cast(case when places is null then 0 else size(places) end as long)").alias("n_dropped"))
