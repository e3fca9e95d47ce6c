import math
import os
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
from conftest import SMALL  # noqa: E402
from tidemark.llm import line_dedup as ld  # noqa: E402
from tidemark.llm import textarrays as ta  # noqa: E402
from tidemark.llm.queries import QUERIES  # noqa: E402


def edit(a, b):
    b = np.array(list(b))
    step = np.arange(len(b) + 1)
    row = step.copy()
    for i, x in enumerate(a, 1):
        new = np.append(i, np.minimum(row[1:] + 1, row[:-1] + (b != x)))
        row = np.minimum.accumulate(new - step) + step
    return row[-1]


def normal(line):
    return " ".join(re.sub(r"[0-9]", "0", w.translate(brute.UP)) for w in re.findall("[0-9A-Za-z\x80-\U0010ffff]+", line))


def sims(lines):
    """SimHash of the distinct words of normalised lines, and the blocks they
    may meet on, with the module's word hashes."""
    out, keys = {}, {}

    def major(h):
        return 2 * np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0) > len(h)

    for x in set(lines):
        data, offs = ta.texts(pa.array([x]))
        s, e = ta.runs(ld.WORD[data], offs)
        h = np.unique(ta.hashes(data, s, e, ld._BYTE))
        out[x], keys[x], n = np.concatenate([major(h), major(ta.mix(h ^ ta.MIX[30]))]), set(), len(h)
        if n <= 8:
            keys[x].add(frozenset(h))
        if 3 <= n <= 9:
            keys[x] |= {frozenset(h) - {w} for w in h}
        if n > 8:
            for classes in {2 ** int(math.log2(n / 4)), 2 ** int(math.log2(1.25 * n / 4))}:
                part = ta.mix(h ^ ta.MIX[41]) % np.uint64(classes)
                keys[x] |= {(classes, c, major(h[part == c]).tobytes()) for c in range(classes) if (part == c).sum() >= 4}
    return out, keys


def expected(rows, similarity=0.8):
    """doc_id -> kept text; all pairs of lines compared."""
    rows = sorted(rows, key=lambda r: r[0])
    split = {i: (t.split("\n") if t else []) for i, t in rows}
    norm = {(i, k): normal(x) for i, ls in split.items() for k, x in enumerate(ls)}
    words = sorted({n for n in norm.values() if n})
    (sim, keys), u = sims(words), brute.Union()
    for x, a in enumerate(words):
        for b in words[x + 1:]:
            if keys[a] & keys[b] and (sim[a] != sim[b]).sum() <= 36 and u.find(a) != u.find(b) and \
                    edit(a, b) <= int((1 - similarity) * max(len(a), len(b)) + 1e-9):
                u.join(a, b)
    seen, out = set(), {}
    for i, t in rows:
        keep = []
        for k, x in enumerate(split[i]):
            g = norm[i, k] and u.find(norm[i, k])
            if not g or g not in seen:
                keep.append(x)
            seen.add(g)
        out[i] = "\n".join(keep) if t is not None else None
    return out


def check(df, rows):
    got = {r.doc_id: r for r in df.collect()}
    want = expected(rows)
    assert len(got) == len(want)
    for i, t in rows:
        assert got[i].text == want[i], (i, got[i].text, want[i], t)
        n = len(t.split("\n")) if t else 0
        assert got[i].n_lines == n
        if t:
            assert got[i].n_dropped == n - (len(want[i].split("\n")) if want[i] or n == 0 else 0) or want[i] == ""


def planted(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghé") for _ in range(r.randint(1, 7)))
    base = [" ".join(word() for _ in range(r.choice([1, 3, 8, 40, 300]))) for _ in range(30)]
    rows = []
    for i in range(80):
        lines = []
        for _ in range(r.randint(0, 6)):
            w = r.choice(base).split()
            kind = r.random()
            if kind < .3:
                w[r.randrange(len(w))] = word()
            elif kind < .45:
                r.shuffle(w)
            elif kind < .6:
                w = [x.upper() + r.choice(["!", ",", ""]) for x in w]
            elif kind < .7:
                w = [word()] * r.randint(1, 30)
            lines.append(" ".join(w) if kind < .9 else r.choice(["", "   ", "--", "No. 7", "no 8!"]))
        rows.append((i, "\n".join(lines)))
    return rows + [(100, None), (101, ""), (102, "\n\n"), (103, "a\n"), (104, rows[5][1]), (105, "x y " * 9000)]


def test_script_is_never_shorter_than_the_edit_distance():
    r = random.Random(9)
    for _ in range(400):
        a = [r.choice(["a", "bb", "ccc", "the", "dddd", "é", "ff g"]) + str(r.choice(["", "x", r.randrange(99)])) for _ in range(r.randint(1, 12))]
        b = list(a)
        for _ in range(r.randint(0, 4)):
            b.insert(r.randrange(len(b) + 1), "w" * r.randint(1, 4))
            if r.random() < .6:
                b.pop(r.randrange(len(b)))
        if r.random() < .2:
            r.shuffle(b)
        a, b = " ".join(a), " ".join(b)
        assert ld.script_cost(a, b) >= edit(a, b)
        assert (ld.script_cost(a, b) == 0) == (a == b)
    assert ld.script_cost("one two three four", "one two 3 four") == 6


def test_within_is_the_edit_distance():
    r = random.Random(12)
    for _ in range(300):
        a = "".join(r.choice("abé ") for _ in range(r.choice([0, 1, 5, 40, 70, 130])))
        b = list(a)
        for _ in range(r.randint(0, len(a) // 2 + 2)):
            i = r.randrange(len(b) + 1)
            b[i:i + r.randint(0, 1)] = r.choice(["", "a", "c", "é"])
        b = "".join(b)
        d = int(edit(a, b)) if b else len(a)
        for room in {0, max(0, d - 1), d, d + 1}:
            assert ld.within(a, b, room) == (d <= room), (a, b, d, room)
    a = "".join(r.choice("abcd") for _ in range(2500))
    b = a[:700] + "xyz" + a[705:1900] + a[1904:]
    assert ld.within(a, b, 9) and not ld.within(a, b, 8)


def test_block_returns_links_and_no_pairs():
    """Near copies that share a block: what leaves the block follows its
    members, and connects what all pairs connect; a pair is tested in its first
    list only."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(60)]
    lines = []
    for share in [.02] * 25 + [.1] * 25 + [.2] * 30:
        lines.append(" ".join([*(word() if r.random() < share else w for w in base), word()]))
    rows = pa.Table.from_batches(list(ld._line_rows(iter([pa.RecordBatch.from_arrays(
        [pa.array(range(len(lines))), pa.array([0] * len(lines)), pa.array(lines)], names=["doc", "tie", "text"])]))))
    ids = rows.column("id").to_pylist()

    def block(lists, comp=ids, side=None):
        t = pa.table({"key": [7] * len(ids), "id": ids, "comp": comp, "side": side or [0] * len(ids), "line": lines,
                      "s1": rows.column("s1"), "s2": rows.column("s2"), "lists": pa.array(lists, pa.list_(pa.int64()))})
        return [tuple(x.values()) for x in ld._block(0.8)(t).to_pylist()]

    bits = [np.unpackbits(np.array([x, y]).view(np.uint8)) for x, y in zip(rows.column("s1").to_pylist(), rows.column("s2").to_pylist())]
    u, pairs, across = brute.Union(), 0, brute.Union()
    for i, a in enumerate(lines):
        for j in range(i):
            if (bits[i] != bits[j]).sum() <= 36 and edit(a, lines[j]) <= int(0.2 * max(len(a), len(lines[j])) + 1e-9):
                pairs += 1
                u.join(ids[i], ids[j])
                if i % 2 != j % 2:
                    across.join(ids[i], ids[j])
    groups = len({u.find(i) for i in ids})
    got, links = brute.Union(), block([[7]] * len(ids))
    for a, b in links:
        got.join(a, b)
    assert {(i, j) for i in ids for j in ids if got.find(i) == got.find(j)} == {(i, j) for i in ids for j in ids if u.find(i) == u.find(j)}
    assert len(links) == len(ids) - groups < pairs / 5 and groups > 1
    both, two = brute.Union(), block([[7]] * len(ids), side=[1 + i % 2 for i in range(len(ids))])
    for a, b in two:
        both.join(a, b)
    assert {(i, j) for i in ids for j in ids if both.find(i) == both.find(j)} == {(i, j) for i in ids for j in ids if across.find(i) == across.find(j)}
    assert block([[3, 7]] * len(ids)) == [] == block([[7]] * len(ids), comp=[1] * len(ids))
    some = block([[3, 7] if i % 3 else [5, 7, 9] for i in range(len(ids))])
    assert some and all(ids.index(a) % 3 == 0 or ids.index(b) % 3 == 0 for a, b in some)


def test_text_of_many_lines(spark):
    """Splitting the text anew for each of its lines took minutes."""
    import time
    text = "\n".join(["one two three", *[f"{'abcdefgh'[i % 8]}{'ijklmnop'[i // 8 % 8]} --" if i % 2 else "--" for i in range(60_000)]])
    start = time.monotonic()
    got = ld.keep_first_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert time.monotonic() - start < 100
    split, seen, kept = text.split("\n"), set(), []
    for x in split:
        n = normal(x)
        kept += [] if n and n in seen else [x]
        seen.add(n)
    assert got[0].text == "\n".join(kept) and got[0].n_lines == 60_001 and got[0].n_dropped == 60_001 - len(kept)


@pytest.mark.parametrize("short", [32, 2])
def test_planted_lines(spark, monkeypatch, short):
    monkeypatch.setattr(ld, "SHORT", short)
    monkeypatch.setattr(ld, "TINY", min(ld.TINY, short))
    monkeypatch.setattr(ld, "BLOCK", 5)
    rows = [r for r in planted(short) if r[0] != 105]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, id string, at int").repartition(3)
    check(ld.keep_first_lines(df), rows)


def test_many_variants_of_a_line(spark):
    """A block value shared by many lines."""
    r = random.Random(4)
    base = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(150)]
    rows = []
    for i in range(150):
        w = list(base)
        w[r.randrange(150)] = f"{'qrstuvwxyz'[i % 10]}{'qrstuvwxyz'[i // 10 % 10]}{'qrst'[i // 100]}"
        rows.append((i, " ".join(w)))
    check(ld.keep_first_lines(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_query_on_documents(spark):
    import hashlib
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: r.kept_sha256 for r in QUERIES["op2_line_dedup"](spark, SMALL).collect()}
    want = expected(rows)
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}


def test_recall_on_edit_similarity_alone(spark):
    """All pairs of lines of up to 600 characters compared by edit distance
    only: at least 0.95 of those of similarity 0.9, and 0.9 of those of 0.8, are
    linked, and no others."""
    import duckdb
    import pandas as pd
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    lines = sorted({normal(x) for t in texts if t for x in t.split("\n")} - {""}, key=len)
    lines = [x for x in lines if len(x) <= 600]
    count = np.zeros((len(lines), 256), np.int32)       # byte pairs: an edit changes at most four counts
    for i, x in enumerate(lines):
        raw = np.frombuffer(x.encode(), np.uint8).astype(int)
        np.add.at(count[i], (raw[:-1] * 31 + raw[1:]) % 256, 1)
    size, near = np.array([len(x) for x in lines]), []
    for i, x in enumerate(lines):
        last = np.searchsorted(size, size[i] / 0.8 + 1e-6, side="right")
        room = size[i + 1:last] * 0.2 * 4 * max(1, len(x.encode()) / max(1, len(x)))
        for j in np.flatnonzero(np.abs(count[i + 1:last] - count[i]).sum(axis=1) <= room) + i + 1:
            near.append((x, lines[j]))
    cand = pd.DataFrame(near, columns=["x", "y"])  # noqa: F841  (read by the SQL)
    want = {(x, y): s for x, y, s in duckdb.sql("select x, y, 1 - levenshtein(x, y) / length(y) from cand").fetchall() if s >= 0.8 - 1e-9}
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string").repartition(4)
    rows = df.select("doc_id", "text").orderBy("doc_id").collect()
    src = ld._source(df, "doc_id", "text")
    got = src.mapInArrow(ld._line_rows, ld.LINE).select("id", "s1", "s2", "doc", "at", "keys")
    by = {r.id: rows[r.doc].text for r in got.collect()}
    found = {tuple(sorted((by[r.a], by[r.b]), key=lambda x: (len(x), x))) for r in ld.links(src, got, 0.8).collect()}
    pairs = {tuple(sorted(p, key=lambda x: (len(x), x))): s for p, s in want.items()}
    assert len(pairs) > 30 and found <= pairs.keys()
    for least, recall in ((0.8, 0.9), (0.9, 0.95)):
        some = {p for p, s in pairs.items() if s >= least}
        assert len(some & found) >= recall * len(some), (least, len(some & found), len(some))


def test_empty_null_and_repeats(spark):
    schema = "doc_id long, text string, n_lines string, places int"
    assert ld.keep_first_lines(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(2, "one two\nthree", "x", 7), (2, "one two\nthree", "x", 7), (None, "One  two!\nfour", None, None),
                                (None, None, None, None), (3, "three\n\nthree", "y", 8)], schema)
    got = sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped, r.places) for r in ld.keep_first_lines(df).collect() if r.text is not None)
    assert got == [("2", "one two\nthree", 2, 0, 7), ("2", "one two\nthree", 2, 0, 7), ("3", "", 3, 2, 8), ("None", "four", 2, 1, None)]
