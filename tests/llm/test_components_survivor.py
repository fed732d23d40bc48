import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from khayt.llm import components as C
from khayt.llm import survivor as V


def groups(edges):
    root = {}
    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        root.setdefault(a, a)
        root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a in root and b in root and a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    n = rnd.choice([6, 40, 90])
    edges = [(f"n{rnd.randrange(n):02}", f"n{rnd.randrange(n):02}") for _ in range(n // 2 + 2)]
    edges += [(b, a) for a, b in edges[:5]] + edges[:3] + [(None, "x"), ("x", None), ("y", "y")]
    df = spark.createDataFrame([(a, b, "clash", 1) for a, b in edges], "left string, right string, id string, group_id int")
    assert {r[0]: r[1] for r in C.connected(df).collect()} == groups(edges)


def test_chain_star_and_empty(spark):
    chain = [(f"{i:03}", f"{i + 1:03}") for i in range(120)]
    assert {r[1] for r in C.connected(spark.createDataFrame(chain, "left string, right string")).collect()} == {"000"}
    star = [("hub", f"{i:03}") for i in range(300)]
    got = C.connected(spark.createDataFrame(star, "left string, right string")).collect()
    assert len(got) == 301 and {r[1] for r in got} == {"000"}
    assert C.connected(spark.createDataFrame([], "left string, right string")).count() == 0
    ints = C.connected(spark.createDataFrame([(5, 3), (3, 9)], "left int, right int")).collect()
    assert {tuple(r) for r in ints} == {(3, 3), (5, 3), (9, 3)}


def test_hub_is_spread_over_tasks(spark):
    n = 20_000
    name = lambda c: F.format_string("n%06d", c)
    edges = spark.range(1, n).select(name("id").alias("u"), F.when(F.col("id") % 2 == 0, name(F.lit(0))).otherwise(name(F.col("id") - 1)).alias("v"))
    turned = edges.select(F.when(F.col("v") == "n000000", F.lit("z")).otherwise(F.col("u")).alias("u"), F.when(F.col("v") == "n000000", F.col("u")).otherwise(F.col("v")).alias("v"))
    was = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in zip(was, ("false", "-1", "16"), strict=True):
        spark.conf.set(k, v)
    try:
        for star, given in ((C._large_star, edges), (C._small_star, turned)):
            whole = lambda hub: {tuple(r) for r in star(given, hub).collect()}  # noqa: B023, E731
            assert whole(100) == whole(10**9)
        low = turned.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("links"))
        spread = lambda hub: [r[1] for r in C._join_minima(turned, low, hub).where("m is not null").groupBy(F.spark_partition_id()).count().collect()]
        assert max(spread(100)) < n / 8 and max(spread(10**9)) > n / 2.2 and sum(spread(100)) == n - 1
    finally:
        for k, v in was.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_links_by_element_are_linear(spark):
    d = spark.createDataFrame([(f"n{i}", "hot") for i in range(200)] * 2 + [("a", None), (None, "e"), ("a", "solo")], "n string, e string")
    assert C.links_by_element(d, "n", "e").count() == 199


def test_narrator_links(spark):
    can = spark.createDataFrame([("nar:a", [" S:1 ", None]), ("nar:b", ["s:1"]), ("nar:c", ["n/a", "Unknown", ""]), ("nar:d", ["N/A"]), ("nar:e", None), ("nar:e", ["x"]), (None, ["s:1"])], "canonical_id string, source_ids array<string>")
    mat = spark.createDataFrame([("c", "nar:d", "ACCEPTED"), ("nar:d", "nar:gone", "accepted"), ("nar:a", "nar:e", "rejected"), ("nar:a", "nar:e", None), (None, "nar:a", "accepted")], "left_id string, right_id string, decision string")
    men = spark.createDataFrame([("m", "nar:d"), ("m", "nar:e"), ("m", None), ("k", "nar:a"), ("k", "nar:zz"), (None, "nar:a")], "mention_id string, canonical_narrator_id string")
    got = {r[0]: r[1] for r in C.connected(C.narrator_links(can, mat, men)).collect()}
    assert got == {"nar:a": "nar:a", "nar:b": "nar:a", "nar:c": "nar:c", "nar:d": "nar:c", "nar:e": "nar:c"}
    assert C.connected(C.narrator_links(can.limit(0), mat, men)).count() == 0


KIND = "canonical_id string, death_year_ah int, death_year_provenance string, generation string, gender string, loaded_at timestamp_ntz, field_name string"
T = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)


def fields(spark, rows):
    return {(r[0], r[1]): r[2] for r in V.narrator_survivors(spark.createDataFrame([(*r, "clash") for r in rows], KIND)).collect()}


def test_survivors(spark):
    got = fields(spark, [
        ("a", 150, "Uncorroborated", " Tabii ", None, T(9)), ("a", 151, " corroborated", "unknown", "MALE", T(1)), ("a", 152, None, "", "female", T(0)), ("a", 9999, "corroborated", None, "UNKNOWN", T(20)),
        ("b", None, "corroborated", None, None, T(1)), ("b", 0, None, " ", "unknown", T(2)), ("c", 100, "corroborated", "later", "male", T(1)), (None, 1, None, "x", "x", T(1)), (None, 1, None, "x", "x", T(1)),
        ("d", 7, None, "x", "y", None), ("d", 7, None, "x", "y", None),
    ])
    assert got == {("a", "death_year_ah"): "151", ("a", "death_year_provenance"): "corroborated", ("a", "generation"): "tabii", ("a", "gender"): "male", ("d", "death_year_ah"): "7", ("d", "generation"): "x", ("d", "gender"): "y"}
    assert fields(spark, []) == {}


def test_survivors_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(f"k{rnd.randrange(30)}", rnd.choice([None, 0, 100, 120, 1501]), rnd.choice([None, "corroborated", "uncorroborated", "UNKNOWN", ""]), rnd.choice([None, "", "a", "B "]), rnd.choice([None, "male", "x"]), T(rnd.randrange(6))) for _ in range(120)]
    clean = lambda v: None if v is None or v.strip().lower() in ("", "unknown") else v.strip().lower()
    want = {}
    for k in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == k]
        if len(own) < 2:
            continue
        rank = {"corroborated": 2, "uncorroborated": 1}
        dated = [(rank.get(clean(r[2]), 0), r[5], r[1], clean(r[2]) or "") for r in own if r[1] is not None and 1 <= r[1] <= 1500]
        if dated:
            _, _, y, p = max(dated)
            want[k, "death_year_ah"] = str(y)
            if p:
                want[k, "death_year_provenance"] = p
        for name, i in (("generation", 3), ("gender", 4)):
            if v := [(r[5], clean(r[i])) for r in own if clean(r[i])]:
                want[k, name] = max(v)[1]
    assert fields(spark, rows) == want


def test_clean_value(spark):
    d = spark.createDataFrame([("\u00a0X\t",), ("",), (None,)], "v string")
    assert [r[0] for r in d.select(V.clean_value(F.col("v"))).collect()] == ["x", None, None]
