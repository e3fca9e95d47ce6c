"""Upsert sink, account of late rows, processing-time timers."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from tidemark.operators import relational, windows
from tidemark.streaming import stateful, upsert
from tidemark.streaming.run import EndOfInput, dropped_rows, run_stream, run_to_tables

T0 = dt.datetime(2024, 1, 1)


def _files(spark, scratch, batches, schema, at=0):
    """One file per batch in <scratch>/src, to be read in order."""
    os.makedirs(f"{scratch}/src", exist_ok=True)
    for i, rows in enumerate(batches, at):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/b{i}")
        for f in os.listdir(f"{scratch}/b{i}"):
            if f.endswith(".parquet"):
                os.link(f"{scratch}/b{i}/{f}", f"{scratch}/src/{i}-{f}")
                os.utime(f"{scratch}/src/{i}-{f}")
                time.sleep(0.05)


def _size(folder):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


def _drain_words(spark, scratch, every):
    s = spark.readStream.schema("doc_id bigint, text string").option("maxFilesPerTrigger", "1").parquet(f"{scratch}/src")
    counts = relational.word_count(relational.words_ws(s, "text"), name="cnt")
    run_stream(counts, "t_words", mode="update", checkpoint=f"{scratch}/ck",
               each_batch=upsert.upsert_writer(f"{scratch}/out", counts.schema, ["word"], every)).awaitTermination()
    return counts.schema


def _words(spark, scratch, schema):
    return {r.word: r.cnt for r in upsert.read_upserts(spark, f"{scratch}/out", schema, ["word"]).collect()}


def test_upsert_writes_changed_words_only(spark, scratch):
    many = " ".join(f"w{i}" for i in range(20_000))
    _files(spark, scratch, [[(1, many)], [(2, "w1 w1 new")], [(3, "w2")]], "doc_id bigint, text string")
    schema = _drain_words(spark, scratch, False)
    sizes = [_size(f"{scratch}/out/changes/epoch={i}") for i in range(3)]
    assert sizes[1] < sizes[0] / 20 and sizes[2] < sizes[0] / 20
    got = _words(spark, scratch, schema)
    want = {f"w{i}": 1 for i in range(20_000)} | {"w1": 3, "w2": 2, "new": 1}
    assert got == want

    # an epoch that is run again replaces its folder
    write = upsert.upsert_writer(f"{scratch}/out", schema, ["word"], False)
    write(spark.createDataFrame([("w2", 2)], schema), 2)
    assert _words(spark, scratch, schema) == want
    # an epoch cut off in the middle (files, but no marker) is not seen
    spark.createDataFrame([("w2", 77)], schema).write.parquet(f"{scratch}/out/changes/epoch=3")
    os.replace(f"{scratch}/out/changes/epoch=3/_SUCCESS", f"{scratch}/marker")
    assert _words(spark, scratch, schema) == want
    write(spark.createDataFrame([("w3", 9)], schema), 3)
    assert _words(spark, scratch, schema) == want | {"w3": 9}


def test_upsert_compacts_and_resumes(spark, scratch):
    _files(spark, scratch, [[(1, "a b")], [(2, "a")], [(3, "c a")]], "doc_id bigint, text string")
    schema = _drain_words(spark, scratch, True)
    assert _words(spark, scratch, schema) == {"a": 3, "b": 1, "c": 1}
    _files(spark, scratch, [[(4, "b d")], [(5, "d d")], [(6, "e")]], "doc_id bigint, text string", 3)
    assert _drain_words(spark, scratch, True) == schema
    want = {"a": 3, "b": 2, "c": 1, "d": 3, "e": 1}
    assert _words(spark, scratch, schema) == want
    assert upsert._committed(spark, f"{scratch}/out", "base")
    for _ in range(2):      # folding all changes, and folding again without any
        upsert.compact(spark, f"{scratch}/out", schema, ["word"])
        assert upsert._live(spark, f"{scratch}/out")[1] == [] and _words(spark, scratch, schema) == want


def test_upsert_without_an_epoch(spark, scratch):
    s = spark.createDataFrame([], "word string, cnt bigint").schema
    assert upsert.read_upserts(spark, f"{scratch}/none", s, ["word"]).collect() == []


LATE = [[(1, T0, "a"), (2, T0 + dt.timedelta(hours=2), "a")],
        [(3, T0 + dt.timedelta(hours=3), "a")],
        [(4, T0 + dt.timedelta(minutes=5), "a"), (5, T0 + dt.timedelta(hours=4), "a"), (6, T0 + dt.timedelta(minutes=6), "b")],
        [(7, T0 + dt.timedelta(hours=1, minutes=1), "c"), (8, T0 + dt.timedelta(hours=5), "c"), (9, None, "c")]]


def _late_source(spark, scratch):
    _files(spark, scratch, LATE, "seq bigint, ts timestamp, k string")
    return spark.readStream.schema("seq bigint, ts timestamp, k string").option("maxFilesPerTrigger", "1").parquet(f"{scratch}/src")


def test_kept_and_late_rows_are_the_input(spark, scratch):
    end = EndOfInput(spark)
    out = stateful.count_with_late(end.attach(_late_source(spark, scratch), "ts"), 3600)
    both = run_to_tables(out, "output", ["count", "late"], "t_account", f"{scratch}/out", end=end)
    late = sorted(r.seq for r in both["late"].collect())
    assert late == [4, 6, 7]
    kept = {r.start_us: r.n for r in both["count"].groupBy("start_us").agg(F.sum("n").alias("n")).collect()}
    us = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    assert kept == {us + h * 3_600_000_000: 1 for h in (0, 2, 3, 4, 5)}
    assert sum(kept.values()) + len(late) == sum(ts is not None for b in LATE for _, ts, _ in b)


def test_dropped_rows_are_counted(spark, scratch):
    s = _late_source(spark, scratch).withWatermark("ts", "0 seconds")
    q = run_stream(windows.tumbling_count(s, "ts", 3600, ["k"]), "t_dropped", f"{scratch}/out", checkpoint=f"{scratch}/ck")
    q.awaitTermination()
    assert dropped_rows(q) == 3     # (00:00, a), (00:00, b), (01:00, c): one row each after combination


def test_clock_timer_fires_without_further_input(spark, scratch):
    rows = [(1, T0, "up", 1.0), (2, T0 + dt.timedelta(seconds=1), "up", 2.0),
            (3, T0, "down", 1.0), (4, T0 + dt.timedelta(seconds=1), "down", 2.0), (5, T0 + dt.timedelta(seconds=2), "down", 1.5),
            (6, T0, "one", 5.0), (7, T0, "none", None), (8, T0, None, 1.0), (9, T0 + dt.timedelta(seconds=1), None, 2.0)]
    schema = "seq bigint, ts timestamp, k string, value double"
    _files(spark, scratch, [rows], schema)
    s = spark.readStream.schema(schema).parquet(f"{scratch}/src")
    q = run_stream(stateful.rise_by_clock(s, ["k"], 1000), "t_clock", f"{scratch}/out", checkpoint=f"{scratch}/ck",
                   trigger="300 milliseconds")
    try:
        until = time.time() + 60
        got = []
        while len(got) < 2 and time.time() < until:
            time.sleep(0.5)
            got = spark.read.schema("k string, alert_ms bigint").parquet(f"{scratch}/out").collect() if os.path.isdir(f"{scratch}/out") else []
        time.sleep(2)
    finally:
        q.stop()
    got = spark.read.schema("k string, alert_ms bigint").parquet(f"{scratch}/out").collect()
    assert sorted(str(r.k) for r in got) == ["None", "up"]
