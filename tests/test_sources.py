"""Synthetic sensor source (batch and stream) and the text readers."""

import statistics

from pyspark.sql import functions as F

from tidemark.sources import generator, text
from tidemark.streaming.run import run_to_table


def test_sensor_walk_batch_shape_and_steps(spark):
    df = generator.sensor_walk(spark, 400, seed=3, chunk_ticks=64)
    assert df.count() == 4000
    assert {r["id"] for r in df.select("id").distinct().collect()} == \
        {f"sensor_{i}" for i in range(1, 11)}
    pdf = df.toPandas().sort_values(["id", "timestamp"])
    steps = pdf.groupby("id")["temperature"].diff().dropna()
    assert abs(statistics.mean(steps)) < 0.15 and 0.85 < statistics.pstdev(steps) < 1.15
    # deterministic whatever the partitioning
    again = generator.sensor_walk(spark, 400, seed=3, chunk_ticks=64).repartition(7)
    assert df.exceptAll(again).count() == 0


def test_sensor_stream_replays_after_restart(spark, scratch):
    generator.register(spark)

    def run(max_ticks, ck):
        s = (spark.readStream.format("sensor_walk").option("seed", "5")
                  .option("ticksPerBatch", "7").option("maxTicks", str(max_ticks)).load())
        return run_to_table(s, f"sensor_{max_ticks}", path=f"{scratch}/out", checkpoint=ck,
                            drain="all")

    run(20, f"{scratch}/ck")                # stop after 20 ticks
    resumed = run(50, f"{scratch}/ck")      # resume to 50 ticks
    whole = (spark.readStream.format("sensor_walk").option("seed", "5")
                  .option("ticksPerBatch", "7").option("maxTicks", "50").load())
    fresh = run_to_table(whole, "sensor_fresh", path=f"{scratch}/out2", checkpoint=f"{scratch}/ck2",
                         drain="all")
    assert resumed.count() == 500
    assert resumed.exceptAll(fresh).count() == 0 and fresh.exceptAll(resumed).count() == 0


def test_text_stream_word_count(spark, scratch):
    import os
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.txt", "w") as fh:
        fh.write("hello spring\nhello  summer\n")
    lines = text.stream_lines(spark, f"{scratch}/in")
    words = lines.select(F.explode(F.split("value", "[ \t\n\x0B\f\r]")).alias("word")) \
        .filter(F.length("word") > 0)
    counts = words.groupBy("word").count()
    q = (counts.writeStream.format("memory").queryName("wc_stream").outputMode("complete")
               .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.table("wc_stream")
    assert {r["word"]: r["count"] for r in out.collect()} == {"hello": 2, "spring": 1, "summer": 1}


def test_collection_text_file_and_table(spark, scratch):
    """S1 in-memory rows, S2 text file lines, S11 DataFrame as an SQL table."""
    rows = text.from_rows(spark, [("ws_001", 1577844001, 45.0), ("ws_002", 1577844015, 43.0)],
                          text.WATER_SENSOR)
    text.to_table(rows, "water_sensor")
    got = spark.sql("SELECT id FROM water_sensor WHERE vc > 44").collect()
    assert [r["id"] for r in got] == ["ws_001"]
    with open(f"{scratch}/hello.txt", "w") as fh:
        fh.write("hello spring\nhello summer\n")
    assert [r["value"] for r in text.read_lines(spark, f"{scratch}/hello.txt").collect()] == \
        ["hello spring", "hello summer"]
