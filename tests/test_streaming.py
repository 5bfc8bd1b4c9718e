"""Streams keep the state of a series between batches."""

from pyspark.sql import functions as F

from cadenza.operators import series as S
from cadenza.streaming.latches import latch_stream, set_reset_stream


def drain(spark, out, name, path):
    q = out.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(path)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_latch_over_batches_equals_the_window_form(spark, tmp_path):
    values = [("a", i, 0.05 if 3 < i < 12 or i > 20 else 0.9) for i in range(30)] + [("b", i, 0.05) for i in range(5)]
    rows = spark.createDataFrame(values, "key string, i long, x double")
    for k in range(3):  # three files, one batch each
        rows.filter((F.col("i") >= 10 * k) & (F.col("i") < 10 * k + 10)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = {(r.key, r.i): r.on for r in drain(spark, latch_stream(stream, 0.09, 0.45), "latched", tmp_path / "c1").collect()}
    want = rows.withColumn("on", S.latch(["key"], F.col("x") < 0.09, F.col("x") > 0.45, 4, 3))
    assert got == {(r.key, r.i): r.on for r in want.collect()} and any(got.values())


def test_set_reset_stream(spark, tmp_path):
    rows = spark.createDataFrame([("a", i, i in (2, 7), i in (5, 7)) for i in range(10)], "key string, i long, enter boolean, leave boolean")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    got = {r.i: r.on for r in drain(spark, set_reset_stream(stream), "switched", tmp_path / "c2").collect()}
    assert [got[i] for i in range(10)] == [False, False, True, True, True, False, False, True, True, True]
