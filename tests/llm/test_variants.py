"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute(counts, factor=10):
    forms, near = {}, {}
    for w in counts:
        near[w] = [v for v in counts if one_edit(w, v)]
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= factor * counts[w] else None

    def root(w):
        return w if forms[w] is None else root(forms[w])
    return sorted((w, n, len(near[w]), forms[w], counts[forms[w]] if forms[w] else None, root(w)) for w, n in counts.items())


def result(spark, counts, shortest):
    df = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    return sorted(tuple(r) for r in variants.variants(df, shortest).select("word", "n", "n_near", "form", "form_n", "root").collect())


def vocabulary(seed, n, letters, low, high):
    rng = random.Random(seed)
    out = {}
    for _ in range(n):
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(low, high)))
        out[w] = rng.choice([2, 3, 30, 300, 4000])
    return out


@pytest.mark.parametrize("letters,low,high,shortest", [("ab", 3, 9, 3), ("abé", 1, 6, 1), ("aéz", 7, 9, 7)])
def test_equals_all_pairs(spark, letters, low, high, shortest):
    counts = vocabulary(5, 250, letters, low, high)
    assert result(spark, counts, shortest) == brute(counts)


def test_letters_shared_by_more_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(variants, "BLOCK", 20)
    counts = {f"abc{w}xyz": n for w, n in vocabulary(6, 200, "ab", 1, 7).items()} | vocabulary(7, 60, "abcd", 7, 9)
    assert result(spark, counts, 7) == brute(counts)


def test_wide_intervals_and_long_words(spark):
    counts = vocabulary(8, 500, "abcdefghij", 3, 5) | {"x" * 5000: 50, "x" * 4999 + "y": 2, "x" * 4999: 600}
    assert result(spark, counts, 3) == brute(counts)


def test_index_orders_suffixes():
    rng = np.random.default_rng(1)
    text = np.append(rng.integers(1, 4, 300), 0)
    order = variants._suffix_order(text)
    assert sorted(range(len(text)), key=lambda i: text[i:].tolist()) == order.tolist()
    same = np.append(np.ones(200, np.int64), 0)
    assert variants._suffix_order(same).tolist() == list(range(200, -1, -1))


def test_words_of_odd_rows(spark):
    rng = random.Random(3)
    texts = [(i, " ".join(rng.choice(["Aloueten", "aloueteN", "Ététernel", "kurz", "Straßenbahn", "x×÷abcdef"]) for _ in range(40))) for i in range(30)]
    texts += [(None, "aloueten " * 9), (None, None), (31, ""), (31, "  "), (32, None), (5, texts[5][1]), (33, "bahnhofes" * 3000 + " fin " + "aloueten " * 20000)]
    counts = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    expected = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    docs = spark.createDataFrame(texts, "`doc.id` long, `the text` string").selectExpr("*", "1 as word", "2 as n", "3 as run", "4 as id", "5 as h")
    got = {r.word: r.n for r in variants.words(docs, "doc.id", "the text").collect()}
    assert got == expected
    assert variants.words(docs.limit(0), "doc.id", "the text").count() == 0


def test_empty_vocabulary(spark):
    assert result(spark, {}, 7) == []
