import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
import test_line_dedup as lines  # noqa: E402
import corpus_pipeline as cp  # noqa: E402
from conftest import SMALL  # noqa: E402
from tidemark.llm import quality  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage."""
    out, docs = {}, spark.read.parquet(f"{SMALL}/documents.parquet")
    out["documents"] = docs.collect()
    for name, stage in cp.STAGES:
        got = stage(spark, docs, SMALL)
        if name != cp.STAGES[-1][0]:
            assert got.columns == docs.columns
        path = str(tmp_path_factory.mktemp(name) / "out")
        got.write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs.collect()
    return out


def test_stage_names():
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "line_dedup", "minhash_near_dedup",
                                         "benchmark_decontamination", "source_mixing"]


def test_quality(spark, stages):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages["quality_classifier"]}
    known = [i for i in label if i in {r.doc_id for r in stages["documents"]}]
    assert sum((i in kept) == (label[i] == 1) for i in known) >= 0.9 * len(known)       # 87 labels in all
    assert all(i in kept for i in known if label[i] == 1)


def test_lines(stages):
    rows = [(r.doc_id, r.text) for r in stages["quality_classifier"]]
    want = lines.expected(rows)
    got = {r.doc_id: r for r in stages["line_dedup"]}
    for i, t in rows:
        if want[i] == t or lines.normal(want[i].replace("\n", " ")):
            assert got[i].text == want[i]
            assert got[i].n_chars == len(want[i])
        else:
            assert i not in got


def test_near_duplicates(stages):
    rows = [(r.doc_id, r.text) for r in stages["line_dedup"]]
    want = {i for i, (_, c) in brute.near_groups(rows, 5, 80).items() if i == c}
    assert {r.doc_id for r in stages["minhash_near_dedup"]} == want


def test_decontamination(spark, stages):
    items = [brute.shingles(r.text, 5) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = set()
    for r in stages["minhash_near_dedup"]:
        s = brute.shingles(r.text, 5)
        if not any(5 * len(x & s) >= 4 * len(x) for x in items):
            want.add(r.doc_id)
    assert {r.doc_id for r in stages["benchmark_decontamination"]} == want


def test_mixture_keeps_all(stages):
    a = sorted(tuple(r) for r in stages["benchmark_decontamination"])
    assert a == sorted(tuple(r)[:5] for r in stages["source_mixing"])
    assert len({r.mix_order for r in stages["source_mixing"]}) == len(a)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.collect() == []


def test_quality_module_is_what_the_stage_uses():
    assert cp.quality is quality
