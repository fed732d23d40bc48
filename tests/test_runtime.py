from pyspark.sql import functions as F

from khayt import runtime as R


def test_small_sides_only_are_broadcast(spark):
    few, left = spark.range(10).select(F.col("id").cast("string").alias("k")), spark.range(100).select(F.col("id").cast("string").alias("k"))
    plan = lambda side: left.join(side, "k")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(R.small(few)).lower()
    assert "broadcast" not in plan(R.small(few, max_bytes=100)).lower()
    assert R.small(few.limit(0)).count() == 0


def test_stored_and_released(spark):
    df, where = R.store(spark.range(3).toDF("a"))
    assert sorted(r[0] for r in df.collect()) == [0, 1, 2]
    R.release(spark, where)
    path, fs = R._path(spark, where)
    assert not fs.exists(path)


def test_one_row(spark):
    a, b = spark.range(2).agg(F.count("id").alias("n")), spark.range(3).agg(F.max("id").alias("m"))
    assert [tuple(r) for r in R.one_row(a, b).collect()] == [(2, 2)]
