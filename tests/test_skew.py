import random

from pyspark.sql import functions as F

from khayt.operators import skew as K

L, R = "k string, g string, v double, rows int", "k string, h string, w double, rows int"


def frames(spark, seed=3, n=200):
    rnd = random.Random(seed)
    key = lambda: "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "c", None])
    left = [(key(), rnd.choice(["x", "y", None]), rnd.choice([1.0, 2.5, None]), 7) for _ in range(n)]
    right = [(key() if rnd.random() < 0.5 else "d", rnd.choice(["p", "q"]), rnd.choice([3.0, None]), 7) for _ in range(n // 4)]
    return spark.createDataFrame(left, L), spark.createDataFrame(right, R)


def plain(rows):
    return sorted(tuple("" if v is None else str(round(float(v), 6)) if isinstance(v, (int, float)) else v for v in r) for r in rows)


def test_equals_the_join(spark):
    a, b = frames(spark)
    for how in ("inner", "left"):
        got = K.eager_join_aggregate(a, b, [("k", "k")], ["g"], ["h"], {"v": F.col("v")}, {"w": F.col("w")}, how)
        r = b.select(F.col("k").alias("k2"), "h", "w")
        j = a.join(r, F.col("k") == F.col("k2"), how).groupBy("g", "h").agg(F.count(F.lit(1)).alias("rows"), F.sum("v").alias("sum_v"), F.count("v").alias("count_v"), F.sum("w").alias("sum_w"), F.count("w").alias("count_w"))
        cols = ["g", "h", "rows", "sum_v", "count_v", "sum_w", "count_w"]
        assert plain([tuple(x) for x in got.select(cols).collect()]) == plain([tuple(x) for x in j.select(cols).collect()])


def test_empty_and_null(spark):
    a, b = frames(spark)
    assert K.eager_join_aggregate(a.limit(0), b, [("k", "k")], ["g"], []).count() == 0
    assert K.eager_join_aggregate(a, b.limit(0), [("k", "k")], ["g"], []).count() == 0
    assert K.member_profile(a.limit(0), "k", "g", "v", b, "h").count() == 0
    assert {r["on_record"] for r in K.member_profile(a, "k", "g", "v", b.limit(0), "h").collect()} == {0}
    none = K.member_profile(spark.createDataFrame([(None, None, None, 1)] * 3, L), "k", "g", "v", b, "h")
    assert [tuple(r) for r in none.collect()] == [(None, 3, 0, 0, None, 0)] and K.heavy_keys(none, "k", 4).count() == 0 and K.heavy_keys(none.limit(0), "k", 4).count() == 0


def test_profile_and_heavy(spark):
    a, _ = frames(spark)
    known = spark.createDataFrame([("x", "clash"), ("x", ""), (None, "")], "member string, rows string")
    got = {r["k"]: r for r in K.member_profile(a, "k", "g", "v", known, "member").collect()}
    for k in {r["k"] for r in a.collect()}:
        rows = [r for r in a.collect() if r["k"] == k]
        v = [r["v"] for r in rows if r["v"] is not None]
        assert (got[k]["rows"], got[k]["members"], got[k]["on_record"], got[k]["valued"]) == (len(rows), len({r["g"] for r in rows} - {None}), sum(r["g"] == "x" for r in rows), len(v))
        assert abs(got[k]["total"] - sum(v)) < 1e-9
    df = spark.createDataFrame([("a", 10), ("b", 9), (None, 381)], "k string, rows bigint")
    assert [tuple(r) for r in K.heavy_keys(df, "k", 40).collect()] == [("a", 10, 400)]
