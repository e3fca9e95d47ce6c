"""Language-model scores from a probabilistic suffix tree over words.

The model predicts each word, and the end of a text, from a context of
variable length.  It is learned in one pass over the corpus per context length:

* a context (the last 1 to `depth` words; a text's start counts as a word) is a
  candidate, and a word behind it an entry, if the sequence occurs at least
  twice, and makes up at least the share `p_min` of all training tokens.  All
  occurrences are counted.  No share is asked for by default, so the tree holds
  every sequence that the corpus repeats;
* a candidate is retained as a state if its next-word distribution diverges
  from the one of its longest retained suffix by at least `divergence` bits
  (relative entropy over its entries and the rest);
* distributions are smoothed into the suffix's: what a state has seen outside
  its entries, and one more count per entry, goes to the suffix state's
  distribution, down to the word frequencies of the whole training corpus.

A word is scored at the longest suffix of its history that is a state.

The word counts are exact for every word and are never brought to the driver
whole: words that hold at least 1 / `head` of all tokens, at most `head`
of them, and those of a tree that travels go with the model, the others are joined by shuffle.  Words are
64-bit hashes.

A tree of which a level may have more than 1 / `HELD` entries is not brought to the driver
either (`_grown`): its sequences are counted, joined with their contexts and
suffixes and tested as tables, by shuffle.  A text's score is then a sum over
the sequences in it, because a state scales all words outside its entries by one factor:
a sequence adds its own factor as a context, and as an entry what it differs by from
its context's.  Sequences that hold `HELD` of all tokens travel with the model, the
sums of the others are joined by shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import textarrays as ta
from tidemark.llm.common import saved, small_batches

HEAD = 2_000_000        # words whose counts travel with the model, at most
P_MIN = 0.0             # least share of the training tokens of a context and of an entry
HELD = 2e-6             # share of the training tokens from which a sequence travels with the model
BEGIN, END = np.array([0x5D3C9A71E2B8460F, 0x1F86B4D3907AE52D], np.uint64)     # in place of words
DIVERGENCE = 0.02       # bits by which a state differs from its suffix


class Tally:
    """Counts of 64-bit keys, merged as they come; `full` says that a task
    should hand on what it has."""

    def __init__(self, limit: int = 1 << 21):
        self.limit, self.keys, self.counts, self.pending = limit, np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.pending.append(np.unique(keys, return_counts=True))
        if sum(len(k) for k, _ in self.pending) > self.limit // 2:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.pending]])
        counts = np.concatenate([self.counts, *[c for _, c in self.pending]])
        self.keys, at = np.unique(keys, return_inverse=True)
        self.counts = np.bincount(at, counts, len(self.keys)).astype(np.int64)
        self.pending = []

    @property
    def full(self) -> bool:
        return len(self.keys) > self.limit

    def take(self) -> pa.RecordBatch:
        self.merge()
        out = pa.RecordBatch.from_arrays([pa.array(self.keys), pa.array(self.counts)], names=["key", "n"])
        self.keys, self.counts = self.keys[:0], self.counts[:0]
        return out


def _tallied(keys_of: Callable[[np.ndarray, np.ndarray], list[np.ndarray]]):
    """Task that counts the keys of all texts (column 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for b in batches:
            for _, _, data, offs in ta.pieces(b.column(0)):
                for keys in keys_of(*ta.word_hashes(data, offs)):
                    tally.add(keys)
                if tally.full:
                    yield tally.take()
        yield tally.take()
    return run


def _count(texts: DataFrame, keys_of) -> DataFrame:
    return texts.mapInArrow(_tallied(keys_of), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


@dataclass
class Level:
    """Contexts of one length.  keys: context * width + next word of each
    entry, ascending; counts; total and listed of each context: occurrences,
    and those that entries hold; entries: their number; state: retained."""
    keys: np.ndarray
    counts: np.ndarray
    total: np.ndarray
    listed: np.ndarray
    entries: np.ndarray
    state: np.ndarray


@dataclass
class Model:
    """tokens, distinct, texts: of the training corpus; head: hashes of the
    frequent words, ascending, and their counts; word: their number among the
    words that contexts hold, or -1; width: those words, start and end."""
    tokens: int
    distinct: int
    texts: int
    head: np.ndarray
    head_n: np.ndarray
    word: np.ndarray
    width: int
    levels: list[Level] = field(default_factory=list)
    #: of a tree that does not travel: its depth, and its frequent sequences
    #: (keys, ascending) with what they add to a score
    grown: int = 0
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    adds: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def base(self, counts: np.ndarray) -> np.ndarray:
        """Smoothed share of words that occur `counts` times."""
        return (counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))

    def sequence(self, words: np.ndarray, first: np.ndarray):
        """Start, words and end of every text in one row: (number among the
        context words or -1, count or -1 if not in the head, is start, owner,
        place of the words)."""
        n = np.diff(first)
        owner = np.repeat(np.arange(len(n)), n + 2)
        begin = first[:-1] + 2 * np.arange(len(n))
        ids = np.full(len(owner), self.width - 1)
        count = np.full(len(owner), self.texts)
        start = np.zeros(len(owner), bool)
        start[begin] = True
        ids[begin] = self.width - 2
        inner = np.ones(len(owner), bool)
        inner[begin] = False
        inner[begin + n + 1] = False
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, words), len(self.head) - 1)
            known = self.head[at] == words
            ids[inner], count[inner] = np.where(known, self.word[at], -1), np.where(known, self.head_n[at], -1)
        else:
            ids[inner], count[inner] = -1, -1
        return ids, count, start, owner, inner

    def contexts(self, ids: np.ndarray, start: np.ndarray):
        """For each level: (context of every position or -1, its key with the
        word there or -1, the entry or -1)."""
        context = np.append(-1, ids[:-1])
        context[start] = -1
        for level in self.levels:
            yield (context, *(ke := self._entry(level, context, ids)))
            context = np.append(-1, ke[1][:-1])
            context[start] = -1

    def _entry(self, level: Level, context: np.ndarray, ids: np.ndarray):
        key = np.where((context >= 0) & (ids >= 0), context * self.width + ids, -1)
        if not len(level.keys):
            return key, np.full(len(key), -1)
        at = np.minimum(np.searchsorted(level.keys, key), len(level.keys) - 1)
        return key, np.where(level.keys[at] == key, at, -1)

    def longer(self, words: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        """Keys of the next level: contexts that are entries of the last one,
        with words that may follow them often enough."""
        ids, _, start, _, _ = self.sequence(words, first)
        context = np.append(-1, ids[:-1])
        context[start] = -1
        may = (context >= 0) & (ids >= 0)
        for _, _, entry in self.contexts(ids, start):
            may &= entry >= 0                       # a part of the sequence that is too rare
            context = np.append(-1, entry[:-1])
            context[start] = -1
        may &= context >= 0
        return [context[may] * self.width + ids[may]]

    def _at(self, level: Level, context: np.ndarray, word: np.ndarray, p: np.ndarray) -> np.ndarray:
        if not len(level.keys):
            return p
        key = np.where((context >= 0) & (word >= 0), context * self.width + word, -1)
        at = np.minimum(np.searchsorted(level.keys, key), len(level.keys) - 1)
        n = np.where((key >= 0) & (level.keys[at] == key), level.counts[at], 0)
        c = np.maximum(context, 0)
        room = level.total[c] + level.entries[c] + 1.0
        smooth = (n + (room - level.listed[c]) * p) / room
        return np.where((context >= 0) & level.state[c], smooth, p)

    def _suffix(self, k: int, context: np.ndarray) -> np.ndarray:
        """Contexts of level k without their first word, as contexts of the
        level below."""
        key = np.where(context >= 0, self.levels[k - 1].keys[np.maximum(context, 0)], -1)
        before, last = key // self.width, key % self.width
        if k == 1:
            return np.where(context >= 0, last, -1)
        before = self._suffix(k - 1, np.where(context >= 0, before, -1))
        below = self.levels[k - 2]
        want = np.where(before >= 0, before * self.width + last, -1)
        at = np.minimum(np.searchsorted(below.keys, want), max(len(below.keys) - 1, 0))
        return np.where((want >= 0) & (below.keys[at] == want), at, -1)

    @property
    def _counts(self) -> np.ndarray:
        """Counts of the context words, start and end."""
        out = np.zeros(self.width, np.int64)
        held = self.word >= 0
        out[self.word[held]] = self.head_n[held]
        out[-2:] = self.texts
        return out

    def add_level(self, keys: np.ndarray, counts: np.ndarray, divergence: float) -> None:
        """The next level from its entries: contexts tested against their
        suffix."""
        k = len(self.levels)
        total = self._counts if k == 0 else self.levels[-1].counts
        context = keys // self.width
        listed = np.bincount(context, counts, len(total))
        entries = np.bincount(context, minlength=len(total))
        with np.errstate(divide="ignore", invalid="ignore"):
            p = counts / total[context]
            q = self._expected(k, keys)
            gain = np.bincount(context, p * np.log2(p / q), len(total))
            p_rest = np.maximum(1 - np.bincount(context, p, len(total)), 0)
            q_rest = np.maximum(1 - np.bincount(context, q, len(total)), 1e-12)
            gain = gain + np.where(p_rest > 0, p_rest * np.log2(p_rest / q_rest), 0.0)
        state = (entries > 0) & (gain >= divergence)
        self.levels.append(Level(keys, counts, total, listed, entries, state))

    def _expected(self, k: int, keys: np.ndarray) -> np.ndarray:
        word, context = keys % self.width, keys // self.width
        p = self.base(self._counts[word])
        chain = []
        while k > 0:
            context = self._suffix(k, context)
            k -= 1
            chain.append((k, context))
        for k, c in reversed(chain):
            p = self._at(self.levels[k], c, word, p)
        return p

    def held(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the sequences that travel add to a score (others: 0), and
        which these are."""
        if not len(self.keys):
            return np.zeros(len(keys)), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        here = self.keys[at] == keys
        return np.where(here, self.adds[at], 0.0), here

    def score(self, words: np.ndarray, first: np.ndarray):
        """Of each text: tokens, known tokens in the head, log10 of the word
        shares of head tokens, log10 of the model without the word shares of
        the others; then the others: owner, hash."""
        ids, count, start, owner, inner = self.sequence(words, first)
        head = count >= 0
        p0 = np.where(head, self.base(np.maximum(count, 0)), 1.0)
        p = p0.copy()
        for level, (context, _, entry) in zip(self.levels, self.contexts(ids, start)):
            if not len(level.keys):
                break
            c = np.maximum(context, 0)
            at = (context >= 0) & level.state[c]
            n = np.where(entry >= 0, level.counts[np.maximum(entry, 0)], 0)
            room = level.total[c] + level.entries[c] + 1.0
            p = np.where(at, (n + (room - level.listed[c]) * p) / room, p)
        m, says = len(first) - 1, ~start
        sums = [np.bincount(owner[says], x[says], m) for x in (np.log10(p0), np.log10(p))]
        tokens = np.bincount(owner[says], minlength=m)
        known = np.bincount(owner[says & (count > 0)], minlength=m)
        if self.grown:
            for at, keys in _sequences(words, first, self.grown):
                add, _ = self.held(keys)
                sums[1] = sums[1] + np.bincount(at, add, m)
        rare = ~head[inner]
        return tokens, known, *sums, owner[inner][rare], words[rare]


@dataclass
class Tables:
    """words: (key, n) of all training words; adds: (key, add) of the sequences
    of a tree that does not travel, without the frequent ones."""
    words: DataFrame
    adds: DataFrame | None = None


def _joined(k: int, context, suffix):
    """Key of a sequence of k + 1 words from those of its first and its last k
    (arrays of uint64, or columns of longs)."""
    by = (23 + 18 * (k - 1)) % 61 + 1
    if isinstance(context, np.ndarray):
        return ((context << ta.U(by)) | (context >> ta.U(64 - by))) ^ suffix ^ ta.MIX[k]
    turned = F.shiftleft(context, by).bitwiseOR(F.shiftrightunsigned(context, 64 - by))
    return turned.bitwiseXOR(suffix).bitwiseXOR(F.lit(int(ta.MIX[k].view(np.int64))))


def _sequences(words: np.ndarray, first: np.ndarray, depth: int, parts: bool = False):
    """For sequences of 1 to depth + 1 words, start and end among them: (owner, keys),
    with `parts` from two words on: (keys, keys of the first words, of the last)."""
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n + 2)
    keys = np.empty(len(owner), np.uint64)
    begin = first[:-1] + 2 * np.arange(len(n))
    inner = np.ones(len(owner), bool)
    inner[begin], inner[begin + n + 1] = False, False
    keys[begin], keys[begin + n + 1], keys[inner] = BEGIN, END, words
    if not parts:
        yield owner, keys
    for k in range(1, depth + 1):
        same = owner[k:] == owner[:-k]
        context, suffix = keys[:-1], keys[1:]       # of the sequences of k words that begin at each place
        keys = _joined(k, context, suffix)
        yield (keys[same], context[same], suffix[same]) if parts else (owner[k:][same], keys[same])


def _bits(rows: int) -> int:
    """Leading bits of a key that deal so many rows into groups of about a million."""
    return max(3, int(rows >> 20).bit_length())


def _packed(x: np.ndarray) -> bytes:
    """An array by byte places: sorted or small numbers shrink well."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unpacked(blocks, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.concatenate([np.zeros(0, dtype), *[
        np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype) for b in blocks]])


def _dealt(bits: int, keys: np.ndarray, /, **columns) -> pa.RecordBatch:
    """One row per group of ascending keys: its number, and its part of each array
    (packed) or a number that is the same for all."""
    group = np.unique(keys >> ta.U(64 - bits))
    lo = np.searchsorted(keys, group << ta.U(64 - bits))
    ends = list(zip(lo, np.append(lo[1:], len(keys))))
    return pa.RecordBatch.from_pydict({"part": pa.array(group.astype(np.int32)), **{
        name: pa.array([_packed(x[i:j]) for i, j in ends], pa.binary()) if isinstance(x, np.ndarray) else pa.array([x] * len(ends), pa.int64())
        for name, x in columns.items()}})


def _pairs(k: int, bits: int, limit: int = 1 << 21):
    """Task that counts the sequences of k + 1 words of all texts (column 0),
    some million words at a time, and deals the counts by key."""
    def counted(found):
        keys, context, suffix = (np.concatenate(x) for x in zip(*found))
        keys, at, n = np.unique(keys, return_index=True, return_counts=True)
        return _dealt(bits, keys, context=context[at], suffix=suffix[at], n=n.astype(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for _, _, data, offs in ta.pieces(b.column(0)):
                *_, found = _sequences(*ta.word_hashes(data, offs), k, parts=True)
                held.append(found)
                size += len(found[0])
                if size > limit:
                    yield counted(held)
                    held, size = [], 0
        if size:
            yield counted(held)
    return run


def _repeated(k: int, least: int):
    """Function of one group's counts: its sequences that occur so often."""
    def run(t: pa.Table) -> pa.Table:
        context, suffix = (_unpacked(t.column(c).to_pylist(), np.uint64) for c in ("context", "suffix"))
        _, at, same = np.unique(_joined(k, context, suffix), return_index=True, return_inverse=True)
        n = np.bincount(same, _unpacked(t.column("n").to_pylist(), np.uint32), len(at)).astype(np.int64)
        at, n = at[n >= least], n[n >= least]
        return pa.table({"context": context[at].view(np.int64), "suffix": suffix[at].view(np.int64), "n": n})
    return run


def _grown(texts: DataFrame, model: Model, counts: DataFrame, depth: int, least: int, divergence: float, often: int) -> DataFrame:
    """Adds to the model the sequences that occur `often`; (key, add) of all others
    that add something to a score, 1 to `depth` + 1 words long."""
    spark, bottom = texts.sparkSession, model.tokens + 0.5 * (model.distinct + 1)
    ends = spark.createDataFrame([(int(w.view(np.int64)), model.texts) for w in (BEGIN, END)], "key long, n long")
    known = counts.union(ends).withColumn("p", (F.col("n") + 0.5) / F.lit(float(bottom))).withColumn("add", F.lit(0.0))
    adds = []
    for k in range(1, depth + 1):
        found = texts.mapInArrow(_pairs(k, _bits(model.tokens)), "part int, context binary, suffix binary, n binary")
        found = found.groupBy("part").applyInArrow(_repeated(k, least), "context long, suffix long, n long")
        entry = (found.join(known.select(F.col("key").alias("suffix"), F.col("p").alias("q")), "suffix")
                 .join(known.select(F.col("key").alias("context"), F.col("n").alias("total")), "context"))
        p = F.col("n") / F.col("total")
        entry = saved(entry.withColumn("gain", p * F.log2(p / F.col("q"))), "lm-entries")
        rest = F.lit(1.0) - F.col("listed") / F.col("total")
        state = entry.groupBy("context", "total").agg(
            F.sum("n").alias("listed"), F.count(F.lit(1)).alias("entries"), F.sum("gain").alias("gain"), F.sum("q").alias("below"))
        state = state.withColumn("gain", F.col("gain") + F.when(
            F.col("listed") < F.col("total"), rest * F.log2(rest / F.greatest(F.lit(1.0) - F.col("below"), F.lit(1e-12)))).otherwise(0.0))
        state = saved(state.where(F.col("gain") >= divergence).withColumn("room", F.col("total") + F.col("entries") + 1.0).withColumn(
            "outside", (F.col("room") - F.col("listed")) / F.col("room")).select("context", "room", "outside"), "lm-states")
        # what a sequence adds as a context of this level, besides what it adds as an entry of the one before
        adds.append(known.join(state.select(F.col("context").alias("key"), "outside"), "key", "left").select(
            "key", "n", (F.col("add") + F.coalesce(F.log10("outside"), F.lit(0.0))).alias("add")))
        smooth = F.when(F.col("room").isNotNull(), F.col("n") / F.col("room") + F.col("outside") * F.col("q")).otherwise(F.col("q"))
        known = saved(entry.join(state, "context", "left").withColumn("p", smooth).select(
            _joined(k, F.col("context"), F.col("suffix")).alias("key"), "n", "p",
            F.when(F.col("room").isNotNull(), F.log10(F.col("p") / F.col("q") / F.col("outside"))).otherwise(0.0).alias("add")), "lm-known")
    adds.append(known.select("key", "n", "add"))
    whole = adds[0]
    for a in adds[1:]:
        whole = whole.union(a)
    whole = saved(whole.where((F.col("add") != 0) | (F.col("n") >= often)), "lm-adds")
    top = whole.where(F.col("n") >= often).toArrow()                        # at most 1 / held rows a level
    keys = top.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    model.grown, model.keys, model.adds = depth, keys[order], top.column("add").to_numpy()[order]
    return whole.where(F.col("n") < often).select("key", "add")


def _train_texts(docs: DataFrame, text: str, train: str) -> DataFrame:
    return docs.where(train).select(F.col(f"`{text}`").cast("string").alias("text"))


def fit(docs: DataFrame, train: str = "true", text: str = "text", depth: int = 2, p_min: float = P_MIN,
        divergence: float = DIVERGENCE, head: int = HEAD, held: float = HELD) -> tuple[Model, Tables]:
    """(model, tables): the tree of the rows that the SQL condition `train`
    selects, and what of it does not travel.  A null text is an
    empty one, whose only token is its end; without rows every token has
    probability one."""
    small_batches(docs.sparkSession)
    texts = _train_texts(docs, text, train)
    counts = saved(_count(texts, lambda w, first: [w.view(np.int64)]), "words")
    n_texts = texts.count()
    distinct, tokens = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    tokens, distinct = (tokens or 0) + n_texts, distinct + (n_texts > 0)
    least = max(2, int(np.ceil(tokens * p_min)))
    travels = least >= tokens * held                                         # else a level may have too many entries
    top = max(1, min(-(-tokens // head), least) if travels else -(-tokens // head))
    top = counts.where(F.col("n") >= top).toArrow()                          # at most head or 1 / held rows
    hashes = top.column("key").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes, n = hashes[order], top.column("n").to_numpy()[order]
    word = np.where(n >= least, np.cumsum(n >= least) - 1, -1)
    model = Model(tokens, distinct, n_texts, hashes, n, word, int(word.max(initial=-1)) + 3)
    if not travels:
        return model, Tables(counts, _grown(texts, model, counts, depth, least, divergence, int(np.ceil(tokens * held))))
    sc = docs.sparkSession.sparkContext
    for _ in range(depth):
        sent = sc.broadcast(model)
        found = _count(texts, lambda w, first, sent=sent: sent.value.longer(w, first)).where(F.col("n") >= least)
        found = found.toArrow()                                                  # at most 1 / held rows
        sent.destroy()
        keys = found.column("key").to_numpy()
        order = np.argsort(keys)
        model.add_level(keys[order], found.column("n").to_numpy()[order], divergence)
    return model, Tables(counts)


_RESULT = [("n_tokens", "long"), ("n_known", "long"), ("base", "double"), ("score", "double"),
           ("rare", "array<long>"), ("times", "array<long>")]


def _scored(sent, texts: bool):
    """Task that scores the texts; `texts`: hands them on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in ta.pieces(b.column(1)):
                tokens, known, base, score, owner, words = sent.value.score(*ta.word_hashes(data, offs))
                order = np.lexsort((words, owner))
                owner, words = owner[order], words[order]
                new = np.ones(len(words), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (words[1:] != words[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(words)))
                bounds = pa.array(np.searchsorted(owner[at], np.arange(hi - lo + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(tokens), pa.array(known), pa.array(base), pa.array(score),
                     pa.ListArray.from_arrays(bounds, pa.array(words[at].view(np.int64))),
                     pa.ListArray.from_arrays(bounds, pa.array(times)), *([b.column(1).slice(lo, hi - lo)] * texts)],
                    names=["row", *[n for n, _ in _RESULT], *(["text"] * texts)])
    return run


_BLOCK = "part int, base long, keys binary, of binary"


def _asked(sent, bits: int, limit: int = 1 << 21):
    """Task that lists the sequences of the texts (row number, text) that do
    not travel, some million at a time, dealt by key; `of`: row number less `base`."""
    def dealt(found):
        rid, keys = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(keys)
        base = int(rid.min())
        return _dealt(bits, keys[order], base=base, keys=keys[order], of=(rid[order] - base).astype(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, held, size = sent.value, [], 0
        for b in batches:
            for lo, hi, data, offs in ta.pieces(b.column(1)):
                rid = b.column(0).slice(lo, hi - lo).to_numpy()
                for owner, keys in _sequences(*ta.word_hashes(data, offs), model.grown):
                    rest = ~model.held(keys)[1]
                    held.append((rid[owner[rest]], keys[rest]))
                    size += len(held[-1][1])
                if size > limit:
                    yield dealt(held)
                    held, size = [], 0
        if size:
            yield dealt(held)
    return run


def _adds(bits: int):
    """Task that deals (key, add) by key; these blocks have no `base`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy().view(np.uint64)
            order = np.argsort(keys)
            yield _dealt(bits, keys[order], base=None, keys=keys[order], of=b.column(1).to_numpy()[order])
    return run


def _found(t: pa.Table) -> pa.Table:
    """Of one group: for each block of texts, what its sequences add."""
    base, keys, of = (t.column(c).to_pylist() for c in ("base", "keys", "of"))
    table = [i for i, x in enumerate(base) if x is None]
    known, add = _unpacked([keys[i] for i in table], np.uint64), _unpacked([of[i] for i in table], np.float64)
    order = np.argsort(known)
    known, add = known[order], add[order]
    out = []
    for x, k, o in zip(base, keys, of):
        if x is not None and len(known):
            k, o = _unpacked([k], np.uint64), _unpacked([o], np.uint32)
            at = np.minimum(np.searchsorted(known, k), len(known) - 1)
            here = known[at] == k
            if here.any():
                row, same = np.unique(o[here], return_inverse=True)
                out.append((x, _packed(row), _packed(np.bincount(same, add[at[here]]))))
    return pa.table({n: pa.array([x[i] for x in out], t) for i, (n, t) in enumerate(
        (("base", pa.int64()), ("of", pa.binary()), ("add", pa.binary())))})


def _summed(t: pa.Table) -> pa.Table:
    """Of one block of texts: what its sequences of all groups add."""
    row, add = _unpacked(t.column("of").to_pylist(), np.uint32), _unpacked(t.column("add").to_pylist(), np.float64)
    row, same = np.unique(row, return_inverse=True)
    return pa.table({"rid": t.column("base")[0].as_py() + row.astype(np.int64), "add": np.bincount(same, add)})


def score(docs: DataFrame, model: Model, tables: Tables, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all) of `docs` with n_tokens, n_known,
    train_tokens, base_score and score, in place of columns of these names:
    log10 probabilities of each whole text by its words alone and by the tree.
    A null text is scored as an empty one, rows that repeat are scored each;
    an empty table gives an empty result."""
    small_batches(docs.sparkSession)
    names = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    keep = [c for c in keep or docs.columns if c not in names]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], *[T.StructField(n, T.DataType.fromDDL(t)) for n, t in [*_RESULT, *[("text", "string")] * (model.grown > 0)]]])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    # numbered and written before the numbers are used: they are read from there on
    scored = saved(rows.mapInArrow(_scored(sent, model.grown > 0), schema).withColumn("rid", F.monotonically_increasing_id()), "lm-scored")
    rare = scored.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("t")).select(
        "rid", F.col("t.rare").alias("key"), F.col("t.times").alias("times"))
    rare = rare.join(tables.words, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    bottom = float(model.tokens + 0.5 * (model.distinct + 1))
    rare = rare.groupBy("rid").agg(
        F.sum(F.col("times") * F.log10((F.col("n") + 0.5) / bottom)).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("also"))
    if model.grown:
        bits = _bits((model.grown + 1) * (scored.agg(F.sum("n_tokens")).first()[0] or 0))
        asked = scored.select("rid", "text").mapInArrow(_asked(sent, bits), _BLOCK).union(tables.adds.mapInArrow(_adds(bits), _BLOCK))
        added = asked.groupBy("part").applyInArrow(_found, "base long, of binary, add binary")
        added = added.groupBy("base").applyInArrow(_summed, "rid long, add double")
        scored = scored.join(saved(added, "lm-added"), "rid", "left").withColumn("score", F.col("score") + F.coalesce("add", F.lit(0.0)))
    sent.destroy()
    return scored.drop("rare", "times").join(rare, "rid", "left").select(
        *[F.col("row").getField(c).alias(c) for c in keep], "n_tokens", (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))
