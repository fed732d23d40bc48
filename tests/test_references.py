import datetime as dt
import random

from pyspark.sql import functions as F

from khayt.operators import references as R

T = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
PARENT = "key string, loaded_at timestamp_ntz, record_id string, state string"
CHILD = "rid string, key string, at timestamp_ntz, stem string, n int"


def find(spark, children, parents, gone, block=4):
    p, c = spark.createDataFrame(parents, PARENT), spark.createDataFrame(children, CHILD)
    d = spark.createDataFrame(gone, "key string, deleted_at timestamp_ntz")
    states = R.parent_states(p, F.col("key"), F.col("loaded_at"), d)
    return sorted(map(tuple, R.orphan_references(c, F.col("rid"), F.col("key"), F.col("at"), states, block).collect()))


def brute(children, parents, gone):
    out = set()
    for rid, key, at, *_ in children:
        if key is None:
            continue
        rows = [t for k, t, *_ in parents if k == key]
        last = max((t for k, t in gone if k == key and t is not None), default=None)
        if not rows:
            state = "missing"
        elif last and not any(t is not None and t > last for t in rows):
            state = "deleted"
        elif at is not None and min((t for t in rows if t is not None), default=at) > at:
            state = "late"
        else:
            continue
        out.add((rid or "", key, at.strftime("%Y-%m") if at else "", state))
    return sorted(out)


def test_against_brute_force(spark):
    rnd = random.Random(5)
    key = lambda: f"{rnd.choice('ab')}:{rnd.randrange(40)}" if rnd.random() < 0.8 else rnd.choice(["x", "a:007", "", "9" * 25, "b:"])
    parents = [(key(), T(rnd.randrange(30)), "clash", "clash") for _ in range(60)]
    children = [(f"r{i % 150}", key() if rnd.random() < 0.95 else None, T(rnd.randrange(60)), "clash", 1) for i in range(300)]
    gone = [(key(), T(rnd.randrange(40))) for _ in range(20)] * 2
    for block in (1, 4, 1 << 16):
        assert find(spark, children, parents, gone, block) == brute(children, parents, gone)


def test_empty_tables_nulls_and_hot_key(spark):
    one = [("r", "k:1", T(3), "s", 1)]
    assert find(spark, [], [], []) == []
    assert find(spark, one, [], []) == [("r", "k:1", "2024-01", "missing")]
    assert find(spark, one * 500, [("k:1", T(1), "", "")] * 3, []) == []
    assert find(spark, [(None, "q", None, "s", 1)], [("p", None, "", "")], [(None, None)]) == [("", "q", "", "missing")]
    assert find(spark, [("r", "p", T(1), "s", 1)], [("p", None, "", "")], [("p", T(0))]) == [("r", "p", "2024-01", "deleted")]


def test_split_is_one_to_one(spark):
    keys = ["a1", "a01", "a", "1", "", "a:0", "a" * 3000 + "5", "x" + "9" * 18, "x" + "9" * 19, "٣"]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select("k", *R.split_key(F.col("k"))).collect()
    assert len({(r[1], r[2]) for r in got}) == len(keys)
    assert all(r[0] == r[1] + (str(r[2]) if r[2] >= 0 else "") for r in got)
