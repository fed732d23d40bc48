import datetime as dt

import pytest
from pyspark.sql import functions as F

from khayt import pipeline
from khayt.functions import places
from khayt.operators import resolution as N

MENTION = "mention string, hadith_id string, chain_index int, position int, name_ar string, name_en string, person string, stage string"
RECORD = "id string, name string, name_en string, keys array<string>, death_year int, provenance string, gender string, generation string, mention_count int, external_id string"


def record(id_, name, year=None, gender=None, count=1, generation=None):
    return (id_, name, None, [name], year, None, gender, generation, count, None)


def test_places(spark):
    d = spark.createDataFrame([("Basra, Iraq",), ("al-Kufah",), ("المدينة المنورة",), ("ما وراء النهر",), ("نيسابور",), ("nowhere",), ("",), (None,)], "p string")
    assert [r[0] for r in d.select(places.region(F.col("p"))).collect()] == ["iraq", "iraq", "hijaz", "transoxiana", "khurasan", None, None, None]
    z = spark.createDataFrame([("andalus", ["khurasan"]), ("andalus", ["khurasan", "iraq"]), ("andalus", [None]), (None, ["fars"]), ("andalus", None)], "a string, b array<string>")
    assert [r[0] for r in z.select(places.travel_ok_with_any(F.col("a"), F.col("b"))).collect()] == [False, True, True, True, True]


def test_years_and_places_speak_against(spark):
    records = spark.createDataFrame(
        [(*record("nar:a", "زيد بن عمرو الكوفي", 150), "Kufa"), (*record("nar:b", "حسن بن علي البصري", 100), "Cordoba"), (*record("nar:t", "مالك بن انس", 120), "Medina"), (*record("nar:s", "سعيد بن جبير", 180), "Samarqand")], RECORD + ", place string"
    )
    rows = [
        ("m1", "h", 0, 0, "سعيد بن جبير", None, "nar:s", "given"), ("m2", "h", 0, 1, "زيد بن عمرو الكوفي", None, None, None), ("m3", "h", 0, 2, "مالك بن انس", None, "nar:t", "given"),
        ("m4", "g", 0, 0, "سعيد بن جبير", None, "nar:s", "given"), ("m5", "g", 0, 1, "حسن بن علي البصري", None, None, None), ("m6", None, 0, 0, "حسن بن علي البصري", None, None, None),
        ("m7", "f", 0, 0, "مالك بن انس", None, "nar:t", "given"), ("m8", "f", 0, 1, "مالك بن انس", None, None, None), ("m9", "f", 0, 1, None, None, None, None),
    ]
    mentions = spark.createDataFrame(rows, MENTION)
    names = mentions.where("person is null").select(F.col("name_ar").alias("mention"), "name_ar", "name_en").dropna(subset=["mention"]).distinct()
    found = N.disambiguate(mentions, records, N.name_matches(names, records))
    # m5: Cordoba to Samarqand is too far; m8: nobody is his own neighbour of the same year; m6 has no chain and nothing against it.
    assert {(r["mention"], r["candidate"], r["stage"]) for r in found.collect()} == {("m2", "nar:a", "exact"), ("m6", "nar:b", "exact")}
    filled = {r["mention"]: (r["person"], r["stage"]) for r in N.back_fill(mentions, found).collect()}
    assert filled["m2"] == ("nar:a", "exact") and filled["m1"] == ("nar:s", "given") and filled["m8"] == (None, None) and len(filled) == 9
    assert N.disambiguate(mentions.limit(0), records, N.name_matches(names, records)).count() == 0


def test_merging_and_splitting_rewrite_mentions(spark):
    records = spark.createDataFrame([record("nar:a", "زيد بن عمرو الكوفي", 150, None, 5), record("nar:b", "زيد بن عمرو الكوفي", None, "male", 2), record("nar:c", "زيد بن عمرو الكوفي", 300)], RECORD)
    mentions = spark.createDataFrame([("m1", "h", 0, 0, "x", None, "nar:b", "given"), ("m2", "h", 0, 1, "x", None, "nar:c", "given"), ("m3", "h", 0, 2, "x", None, None, None)], MENTION)
    m, r = N.cluster(mentions, records)
    assert {x["mention"]: x["person"] for x in m.collect()} == {"m1": "nar:a", "m2": "nar:c", "m3": None}
    got = {x["id"]: (x["death_year"], x["gender"], x["mention_count"]) for x in r.collect()}
    assert got == {"nar:a": (150, "male", 7), "nar:c": (300, None, 1)}

    people = [record("nar:x", "اسم"), record("nar:e", "مبكر", 60), record("nar:l", "متاخر", 330)]
    rows = [row for i in range(24) for row in ((f"a{i:02}", f"h{i}", 0, 0, "n", None, "nar:e" if i < 12 else "nar:l", "given"), (f"b{i:02}", f"h{i}", 0, 1, "n", None, "nar:x", "given"))]
    m, r = N.split(spark.createDataFrame(rows, MENTION), spark.createDataFrame(people, RECORD))
    moved = {x["mention"]: x["person"] for x in m.where("mention like 'b%'").collect()}
    new = {x["id"]: x for x in r.collect() if x["id"] not in ("nar:x", "nar:e", "nar:l")}
    assert len(new) == 1 and sum(p in new for p in moved.values()) == 12 and sum(p == "nar:x" for p in moved.values()) == 12
    assert next(iter(new.values()))["death_year"] == 377 and r.count() == 4


def test_unify_joins_all_that_pass(spark):
    records = spark.createDataFrame([record("nar:a", "a", 100), record("nar:b", "b", 101), record("nar:c", "c", 300)], RECORD)
    rows = [(f"{p}{i}", f"{p}{i}", 0, k, "n", None, who, "given") for p, me in (("a", "nar:a"), ("b", "nar:b"), ("c", "nar:c")) for i in range(3) for k, who in ((0, "nar:t"), (1, me))]
    mentions = spark.createDataFrame([(f"{m}-{k}", h, c, k, n, e, who, s) for m, h, c, k, n, e, who, s in rows], MENTION)
    pairs = spark.createDataFrame([("nar:b", "nar:a"), ("nar:a", "nar:c"), ("nar:a", "nar:a"), (None, "nar:a"), ("nar:a", "nar:b")], "a string, b string")
    m, r = N.unify(mentions, records, pairs, spark.createDataFrame([], "id string"))
    assert {x["id"] for x in r.collect()} == {"nar:a", "nar:c"} and m.where("person = 'nar:b'").count() == 0 and m.where("person = 'nar:a'").count() == 6
    m, r = N.unify(mentions, records, pairs, spark.createDataFrame([("nar:b",)], "id string"))
    assert r.count() == 3


def test_the_command_stops_and_goes_on(spark, tmp_path):
    data, out = tmp_path / "data", str(tmp_path / "out")
    t = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("m1", "h", 0, 0, "زيد بن عمرو الكوفي", None, t), ("m2", "h", 0, 1, "مالك", "c", t)], "mention_id string, hadith_id string, chain_index int, position_in_chain int, name_raw string, canonical_narrator_id string, loaded_at timestamp_ntz").write.parquet(f"{data}/mentions_resolved.parquet")
    spark.createDataFrame(
        [("nar:a", "زيد بن عمرو الكوفي", None, None, 150, None, None, "exact", None, None, None, None, 3, False, t)],
        "canonical_id string, name_ar string, name_en string, aliases array<string>, death_year_ah int, death_year_ah_earliest int, death_year_ah_latest int, death_date_precision string, death_year_provenance string, gender string, generation string, external_id string, mention_count int, over_merged boolean, loaded_at timestamp_ntz",
    ).write.parquet(f"{data}/narrators_canonical.parquet")
    spark.createDataFrame([("a", "a", "accepted")], "left_id string, right_id string, decision string").write.parquet(f"{data}/narrator_matches.parquet")
    assert pipeline.main(["resolve", str(data), out, "--stop-after", "disambiguate"]) == pipeline.Exit.OK
    assert {r["mention"]: r["person"] for r in spark.read.parquet(f"{out}/mentions").collect()} == {"m1": "nar:a", "m2": "nar:c"}
    assert not (tmp_path / "out" / "measures").exists()
    assert pipeline.main(["resolve", str(data), out, "--from-step", "cluster"]) == pipeline.Exit.OK
    got = {r["measure"]: r["value"] for r in spark.read.parquet(f"{out}/measures").collect()}
    assert (got["mentions"], got["resolved"], got["by_exact"], got["by_given"], got["records"]) == (2, 2, 1, 1, 1)
    assert pipeline.main(["resolve", str(data), out, "--from-step", "mentions"]) == pipeline.Exit.BAD_ARGUMENT
    assert pipeline.main(["resolve", str(data), out, "--stop-after", "nothing"]) == pipeline.Exit.BAD_ARGUMENT


def test_curated_stages_need_their_tables():
    names = [s.name for s in pipeline.resolve_stages()]
    assert names == ["mentions", "records", "disambiguate", "cluster", "narrator_split", "reconcile", "generation_dates", "unify", "measures"]
    assert {"contextual", "over_merged", "links", "bio_promote"} < {s.name for s in pipeline.resolve_stages(tuple(pipeline.CURATED))}
    with pytest.raises(ValueError, match="no stage"):
        pipeline.run_stages(pipeline.resolve_stages(), {}, stop_after="x")
