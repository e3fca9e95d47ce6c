"""Spelling variants: words at edit distance one, found with FM-indexes.

Two words that differ by one inserted, deleted or replaced code point agree
exactly on either half of the first word.  The search scheme has two parts:

* left half exact, the error in the right half: the left half is matched from
  the front delimiter on, then the search goes right with one error to spend;
* right half exact, the error in the left half: the mirror of it.

The index holds both directions of the delimited vocabulary: part one runs on
the FM-index of the reversed words (a backward step there reads the next letter
to the right), part two on that of the words as they are.  A state of the
search is an interval of suffix ranks; a step narrows it by one letter, and
where the error may fall all letters that follow in the interval are tried.

Scale: a pair of part one shares its first letters, one of part two its last
ones, so the vocabulary is dealt by these letters to blocks of about `BLOCK`
words, each with an index of its own.  Letters that more than a block of words
share are cut into several blocks, and their words are asked in each of them:
the search costs the same in a large interval as in a small one, so no group is
compared in pairs.  A block returns one row per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved

BLOCK = 50_000          # words of one index, 16 letters each
_SLICE = 20_000         # words searched at once in a task
_WIDE = 256             # intervals up to this size are read row by row for the letters that follow


def words(docs: DataFrame, doc: str = "doc_id", text: str = "text", shortest: int = 7, least: int = 2,
          typos: int = 31) -> DataFrame:
    """(word, n): letter runs of the texts, A-Z lower-cased, of at least
    `shortest` code points and `least` occurrences.

    A run whose crc32 (of `<doc_id>:<run>`) `typos` divides loses the code
    point at that value modulo its length.  A null text has no runs; a null id
    is written as nothing; rows with equal ids count each.
    """
    # a run that ends up long enough was at least as long before
    run = F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{max(shortest, 1)},}}"), F.lit(0)))
    rows = docs.select(F.coalesce(F.col(f"`{doc}`").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    low = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = rows.select("id", low.alias("run"))
    rows = rows.withColumn("h", F.expr("crc32(cast(concat(id, ':', run) as binary))"))
    rows = rows.select(F.expr(f"""case when h % {typos} <> 0 then run else concat(
        substring(run, 1, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2)) end""").alias("word"))
    return (rows.where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least))


class FmIndex:
    """Suffix-rank intervals over the words (symbols from 2 on), read from
    the delimiter behind each word's last symbol backwards."""

    def __init__(self, symbols: np.ndarray, lens: np.ndarray):
        k = len(lens)
        starts = np.cumsum(lens) - lens
        text = np.ones(len(symbols) + k + 2, np.int64)              # 1 delimits, a single 0 ends
        text[np.arange(len(symbols)) + np.repeat(np.arange(1, k + 1), lens)] = symbols
        text[-1] = 0
        self.n = len(text)
        order = _suffix_order(text)
        before = text[order - 1]
        by_symbol = np.argsort(before, kind="stable")
        self.before = before.astype(np.int32)
        self.step = np.empty(self.n, np.int64)                      # rank after reading the symbol before a row
        self.step[by_symbol] = np.arange(self.n)
        self.keys = before[by_symbol] * (self.n + 1) + by_symbol
        self.root = (1, k + 2)                                      # rows that begin with a delimiter
        self.word = np.searchsorted(starts + np.arange(k), order[1:k + 2])
        self.top = int(text.max())

    def extend(self, lo, hi, symbol):
        """Intervals narrowed by one symbol each (empty: lo >= hi)."""
        out_lo, out_hi = self.step[lo], self.step[lo] + 1
        out_hi -= self.before[lo] != symbol                         # right where the interval is one row
        wide = np.flatnonzero(hi - lo > 1)
        at = symbol[wide].astype(np.int64) * (self.n + 1)
        out_lo[wide] = np.searchsorted(self.keys, at + lo[wide])
        out_hi[wide] = np.searchsorted(self.keys, at + hi[wide])
        return out_lo, out_hi

    def following(self, lo, hi):
        """(state, symbol, lo, hi) for every letter that extends a state."""
        size = hi - lo
        few, many = np.flatnonzero(size <= _WIDE), np.flatnonzero(size > _WIDE)
        n = size[few]
        state = np.repeat(few, n)
        row = np.arange(len(state)) - np.repeat(np.cumsum(n) - n, n) + lo[state]
        symbol = self.before[row]
        order = np.argsort(state * (self.top + 1) + symbol, kind="stable")
        state, symbol, row = state[order], symbol[order], row[order]
        new = np.ones(len(state), bool)
        new[1:] = (state[1:] != state[:-1]) | (symbol[1:] != symbol[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(state)))
        a = [state[first], symbol[first], self.step[row[first]], self.step[row[first]] + count]
        letters = np.arange(2, self.top + 1)
        state, symbol = np.repeat(many, len(letters)), np.tile(letters, len(many))
        b = [state, symbol, *self.extend(lo[state], hi[state], symbol)] if len(many) else [np.zeros(0, np.int64)] * 4
        state, symbol, l, h = (np.concatenate(x) for x in zip(a, b))
        ok = (symbol > 1) & (l < h)
        return state[ok], symbol[ok], l[ok], h[ok]


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the length that is compared."""
    bits = max(1, int(text.max()).bit_length())
    k = 63 // bits
    key = np.zeros(len(text), np.int64)
    for j in range(k):
        key <<= bits
        key[:len(text) - j] |= text[j:]
    while True:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(len(text), np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))
        if rank[order[-1]] == len(text) - 1:
            return order
        later = np.zeros(len(text), np.int64)
        later[:max(0, len(text) - k)] = rank[k:] + 1
        key = rank * (len(text) + 1) + later
        k *= 2


def near(index: FmIndex, flat: np.ndarray, off: np.ndarray, lens: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(asked, found): words of the index that begin with the first `exact`
    symbols of an asked word and differ from it by one edit behind them."""
    q = np.arange(len(lens))
    lo, hi = np.full(len(q), index.root[0]), np.full(len(q), index.root[1])
    for t in range(int(exact.max(initial=0))):
        go = np.flatnonzero(exact[q] > t)
        lo[go], hi[go] = index.extend(lo[go], hi[go], flat[off[q[go]] + t])
        ok = lo < hi
        q, lo, hi = q[ok], lo[ok], hi[ok]
    at = exact[q]                                                     # symbols of the asked word read so far
    eq, el, eh, ea = (np.zeros(0, np.int64) for _ in range(4))        # states whose error is spent
    pairs = []
    while len(q) or len(eq):
        # one symbol on without error; the delimiter ends a word
        done = ea == lens[eq]
        symbol = np.where(done, 1, flat[np.minimum(off[eq] + ea, len(flat) - 1)])
        el, eh = index.extend(el, eh, symbol)
        ok = el < eh
        hit = ok & done
        pairs.append(eq[hit] * len(index.word) + index.word[el[hit] - index.root[0]])
        ok &= ~done
        eq, el, eh, ea = eq[ok], el[ok], eh[ok], ea[ok] + 1
        # the error: left out (at the end of a run of one letter), another letter instead, or one more before it
        inside = at < lens[q]
        here = np.where(inside, flat[np.minimum(off[q] + at, len(flat) - 1)], -1)
        after = np.where(at + 1 < lens[q], flat[np.minimum(off[q] + at + 1, len(flat) - 1)], -1)
        out = inside & (here != after)
        s, c, sl, sh = index.following(lo, hi)
        same = c == here[s]
        other = ~same
        instead = other & inside[s]
        eq = np.concatenate([eq, q[out], q[s[instead]], q[s[other]]])
        el = np.concatenate([el, lo[out], sl[instead], sl[other]])
        eh = np.concatenate([eh, hi[out], sh[instead], sh[other]])
        ea = np.concatenate([ea, at[out] + 1, at[s[instead]] + 1, at[s[other]]])
        q, lo, hi, at = q[s[same]], sl[same], sh[same], at[s[same]] + 1
    both = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    return both // len(index.word), both % len(index.word)


def _block(t: pa.Table) -> pa.Table:
    """Near words of one block: a row per asked word that has any."""
    left = t.column("side")[0].as_py() == 0
    word, n, own = t.column("word").to_pylist(), t.column("n").to_numpy(), t.column("own").to_numpy()
    order = sorted(range(len(word)), key=word.__getitem__)            # code-point order
    word, n, own = [word[i] for i in order], n[order], own[order]
    lens = np.array([len(w) for w in word], np.int64)
    codes = np.frombuffer("".join(word).encode("utf-32-le"), np.uint32)
    off = np.cumsum(lens) - lens
    flat = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 2
    mirror = np.repeat(2 * off + lens - 1, lens) - np.arange(len(flat))
    forth, back = flat, flat[mirror]                                   # each word read forwards, backwards
    ids = np.flatnonzero(own)
    mine = np.repeat(own, lens).astype(bool)
    index = FmIndex((back if left else forth)[mine], lens[ids])
    asked, half = (forth if left else back), lens // 2
    exact = half if left else lens - half
    rows = {"word": [], "n_near": [], "best_n": [], "best": []}
    for lo in range(0, len(word), _SLICE):
        hi = min(lo + _SLICE, len(word))
        a, b = near(index, asked, off[lo:hi], lens[lo:hi], exact[lo:hi])
        a, b = a + lo, ids[b]
        if not left:              # pairs that agree on the left half are found by the other part
            apart = np.zeros(len(a), bool)
            for t_ in range(int(half[lo:hi].max(initial=0))):
                on = np.flatnonzero((half[a] > t_) & ~apart)
                apart[on] = (lens[b[on]] <= t_) | (flat[off[a[on]] + t_] != flat[np.minimum(off[b[on]] + t_, len(flat) - 1)])
            a, b = a[apart], b[apart]
        o = np.lexsort((b, -n[b], a))
        a, b = a[o], b[o]
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
        rows["word"] += [word[i] for i in a[first]]
        rows["n_near"] += np.diff(np.append(first, len(a))).tolist()
        rows["best_n"] += n[b[first]].tolist()
        rows["best"] += [word[i] for i in b[first]]
    return pa.table(rows, schema=pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]))


def _dealt(vocabulary: DataFrame, side: int, blocks: int, letters: int) -> DataFrame:
    """Rows (side, hot, block, own, word, n): every word once as a member of
    its block (own) and, where its letters fill several blocks, as a question
    in each of them."""
    key = F.substring("word", 1, letters) if side == 0 else F.expr(f"right(word, {letters})")
    v = vocabulary.select("word", "n", key.alias("key"))
    crowded = v.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > BLOCK)
    crowded = crowded.select("key", F.ceil(F.col("c") / BLOCK).cast("int").alias("pieces"))
    v = v.join(crowded, "key", "left")
    few = v.where("pieces is null").select(
        F.lit(side).alias("side"), F.lit(None).cast("string").alias("hot"), F.expr(f"pmod(xxhash64(key), {blocks})").alias("block"),
        F.lit(True).alias("own"), "word", "n")
    many = v.where("pieces is not null").withColumn("block", F.explode(F.expr("sequence(0, pieces - 1)"))).select(
        F.lit(side).alias("side"), F.col("key").alias("hot"), F.col("block").cast("long").alias("block"),
        (F.col("block") == F.expr("pmod(xxhash64(word), pieces)")).alias("own"), "word", "n")
    return few.unionByName(many)


def variants(vocabulary: DataFrame, shortest: int = 7, factor: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of `vocabulary`
    (word, n), whose words are different and at least `shortest` code points
    long.

    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point.  form: the near word of largest n (ties: the first in
    code-point order), if its n is at least `factor` > 1 times the word's,
    else null; root: the end of the chain of forms, the word itself if it has
    none.  An empty vocabulary gives an empty result.
    """
    v = saved(vocabulary.select("word", F.col("n").cast("long").alias("n")), "variants-words")
    count, chars = v.agg(F.count(F.lit(1)), F.sum(F.length("word"))).first()
    blocks = max(1, -(-count // BLOCK), -(-(chars or 0) // (16 * BLOCK)))
    rows = _dealt(v, 0, blocks, shortest // 2).unionByName(_dealt(v, 1, blocks, shortest // 2))
    found = saved(rows.groupBy("side", "hot", "block").applyInArrow(
        _block, "word string, n_near long, best_n long, best string"), "variants-found")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
    out = v.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("b.m") >= F.col("n") * factor, F.struct(F.col("b.best").alias("form"), (-F.col("b.m")).alias("form_n"))).alias("f"))
    out = saved(out.select("word", "n", "n_near", "f.form", "f.form_n"), "variants-forms")
    # chains of forms, their length halved in each round; n grows by `factor` a step, so they end
    chain = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        chain = saved(chain.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variants-roots")
        if chain.where("moved").isEmpty():
            break
        chain = chain.drop("moved")
    return out.join(chain.select("word", "root"), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
