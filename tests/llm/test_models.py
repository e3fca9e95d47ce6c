import numpy as np
import pytest

from conftest import MEDIUM, SMALL
from tidemark.llm import langid, quality
from tidemark.llm.queries import QUERIES


def test_quality_held_out(spark):
    got = QUERIES["op6_quality"](spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "quality")
    assert got.count() == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_quality_trains_only_on_its_folds(spark):
    docs = spark.createDataFrame([(i, f"word{i}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    rows = quality.training_rows(docs, labels, 1000).collect()
    import zlib
    assert sorted(r.text for r in rows) == sorted(f"word{i}" for i in range(200) if zlib.crc32(str(i).encode()) % 5)
    assert quality.training_rows(docs, labels, 20).count() == 20


def test_quality_odd_rows(spark):
    schema = "doc_id long, text string, score double, row string, y int"
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = [(1, "good text here", 1.0, "a", 1), (2, "### !!!", 2.0, "b", 2), (None, None, None, None, None),
            (3, "", 0.0, "", 0), (1, "good text here", 1.0, "a", 1), (4, "x " * 60000, 0.0, "", 0)]
    df = spark.createDataFrame(rows, schema)
    got = quality.classify(df, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns
    assert quality.classify(df.limit(0), labels).collect() == []
    assert all(r.score == 0.5 for r in quality.classify(df, labels.limit(0)).collect())


def test_language_held_out(spark):
    got = QUERIES["op10_language"](spark, MEDIUM)
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert 150 < len(held) < 350
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(spark):
    schema = "doc_id long, text string, lang string, ok string, t string"
    rows = [(i, "the cat and the dog " * 3, "en", "", "") for i in range(8)]
    rows += [(10 + i, "der hund und die katze " * 3, "de", "", "") for i in range(8)]
    rows += [(20, None, "en", "", ""), (21, "", None, "", ""), (22, "123 !!", "de", "", ""), (23, "١٢٣", None, "", ""),
             (24, "x" * 100000, None, "", ""), (None, "hund", None, "", ""), (25, "日本語", None, "", "")]
    df = spark.createDataFrame(rows, schema)
    got = langid.identify(df).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert [by[i].lang_pred for i in (20, 21, 22, 23)] == ["und"] * 4 and by[20].score == 0
    assert by[24].lang_pred in ("en", "de") and by[25].lang_pred in ("en", "de")
    assert by[3].lang_pred == "en" and by[13].lang_pred == "de"
    assert langid.identify(df.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.identify(df.where("lang is null")).collect()} == {"und"}


def test_gradient_matches_differences():
    r = np.random.default_rng(0)
    p = {k: v.astype(float) for k, v in langid.initial(3).items()}
    x, y = r.integers(0, 256, (4, 5)), r.integers(0, 3, 4)

    def loss():
        return -np.log(langid.label(p, x)[np.arange(4)[:, None], np.arange(5)[None], y[:, None]]).mean()
    g = langid.gradient(p, x, y)
    for k in p:
        i = np.unravel_index(np.argmax(np.abs(g[k])), p[k].shape)
        was = p[k][i]
        p[k][i] = was + 1e-3
        up = loss()
        p[k][i] = was - 1e-3
        down = loss()
        p[k][i] = was
        assert g[k][i] == pytest.approx((up - down) / 2e-3, rel=1e-3)


def test_whole_texts_are_read(spark):
    """Position sums over distinct pieces equal sums over every occurrence."""
    import pyarrow as pa

    from tidemark.llm import textarrays as ta
    p = langid.initial(2)
    text = "ab cd ab abcdefghijklmnop cd é " * 50
    (lo, hi, data, offs), = ta.pieces(pa.array([text]))
    s, e, first = langid._cut(data, offs)
    back, table = langid._Known(p, 2).sums(data, s, e)
    slow = sum(langid.label(p, data[a:b][None])[0].sum(axis=0) for a, b in zip(s, e))
    assert np.allclose(table[back].sum(axis=0), slow, rtol=1e-4)
    assert (e - s).sum() == sum(len(w.encode()) for w in text.split())


def test_small_tables(spark):
    assert QUERIES["op6_quality"](spark, SMALL).count() == 200
