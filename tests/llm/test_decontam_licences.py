import os
import sys

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
from conftest import SMALL  # noqa: E402
from tidemark.llm import decontam, licences  # noqa: E402
from tidemark.llm.queries import QUERIES  # noqa: E402


def expected(docs, items, width=5):
    out = {}
    for j, t in items:
        w = min(width, len(brute.words(t)))
        if not w:
            continue
        q = brute.shingles(t, w)
        for i, d in docs:
            n = len(q & brute.shingles(d, w)) if len(brute.words(d)) >= w else 0
            if 5 * n >= 4 * len(q):
                out[i, j] = (len(q), n)
    return out


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id): (r.n_shingles, r.n_found) for r in QUERIES["op3_decontamination"](spark, SMALL).collect()}
    assert got == expected(docs, items) and got


def test_sizes_and_limits(spark):
    w = [f"w{i}" for i in range(400)]
    items = [(n, " ".join(w[:n])) for n in (1, 2, 4, 5, 6, 9, 24, 25, 26, 130)] + [(900, None), (901, " "), (24, " ".join(w[:24]))]
    docs = [(1, " ".join(w)), (2, " ".join(w[:100] + ["x"] + w[100:])), (3, " ".join(w[3:])), (4, "w0"), (5, "W0\tw1"),
            (6, None), (7, ""), (8, " ".join(w[:20])), (9, " ".join(w[4:23])), (10, " ".join(w[:8] + ["y"] + w[9:]))]
    df = spark.createDataFrame([(*d, 0, "h") for d in docs], "doc_id long, text string, item_id int, h string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_shingles, r.n_found) for r in decontam.contaminated(df, bench).collect()}
    assert got == expected(docs, items)
    kept = decontam.clean(df, bench)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in got}


def test_null_ids_and_empty_tables(spark):
    long = " ".join(f"a{i}" for i in range(30))
    df = spark.createDataFrame([(None, long), (None, "b c"), (1, long + " z"), (1, "q")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, long)], "item_id long, text string")
    assert sorted(str(r.doc_id) for r in decontam.contaminated(df, bench).collect()) == ["1", "None"]
    assert decontam.contaminated(df.limit(0), bench).collect() == []
    assert decontam.contaminated(df, bench.limit(0)).collect() == []
    assert decontam.clean(df, bench.limit(0)).count() == 4


def test_licence_variants(spark):
    mit = next(t for i, t in licences.KNOWN if i == "MIT")
    texts = [mit, "Copyright (c) 2020 A. Person\n\n" + mit, mit.upper().replace(",", " ;"), mit.replace("sublicense", "sub-license"),
             mit.replace("copyright holders", "Copyright Owners"), "© 2019 X\n# (C) 2018 Y\n" + "  " + mit.replace("\n", "\n\t* "),
             mit + " more", mit[:-20], None, "", "Copyright 2020 nobody", "x\nReleased under the MIT Licence!\nreleased under the mit license"]
    df = spark.createDataFrame([(i, t, "d", "h") for i, t in enumerate(texts)], "doc_id long, text string, digest string, h string")
    known = licences.known_digests(spark)
    got = {r.doc_id: r for r in licences.scan_texts(df, known).collect()}
    assert [got[i].license_id for i in range(12)] == ["MIT"] * 6 + [None] * 6
    assert got[3].digest == "d"
    lines = {(r.doc_id, r.license_id): r.n_lines for r in licences.scan_lines(df, known).collect()}
    assert lines == {(11, "MIT"): 2}


def test_licence_query_and_empty(spark):
    got = QUERIES["op8_licences"](spark, SMALL)
    assert got.count() == 200
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    assert licences.scan_texts(docs, licences.known_digests(spark)).collect() == []
    twice = spark.createDataFrame([(1, "Licensed under CC BY 4.0"), (1, "Licensed under CC BY 4.0"), (None, "licenced under CC BY 4.0.")],
                                  "doc_id long, text string")
    assert [r.license_id for r in licences.scan_texts(twice, licences.known_digests(spark)).collect()] == ["CC-BY-4.0"] * 3
