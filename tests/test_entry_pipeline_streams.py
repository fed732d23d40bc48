import pathlib
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from pyspark.sql import functions as F

from khayt import pipeline
from khayt.operators import quality as K
from khayt.streaming import flows

ROOT = pathlib.Path(entry.__file__).parent


def test_contract(spark, data):
    assert len(entry.entry(spark).columns) == 6
    names, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(names) and all(sql.values())


def test_core_does_not_need_the_subpackage(tmp_path):
    for x in ("khayt", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / x).is_dir() else shutil.copy)(ROOT / x, tmp_path / x)
    shutil.rmtree(tmp_path / "khayt/llm", ignore_errors=True)
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); assert 'p2_found' in q and 'p1_found' not in q; e.oracle_sql()"], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    for f in (ROOT / "khayt").rglob("*.py"):
        assert "llm" in f.parts or "khayt.llm" not in f.read_text()


def test_runner(spark):
    df = spark.range(1)
    stages = [pipeline.Stage("a", ["x"], lambda t: {"y": t["x"]}), pipeline.Stage("b", ["nope"], lambda t: {}), pipeline.Stage("c", ["y"], lambda t: 1 / 0), pipeline.Stage("d", ["y"], lambda t: {"z": t["y"]}, resumable=False)]
    got = pipeline.run_stages(stages, {"x": df})
    assert got.ran == ["a", "d"] and set(got.failed) == {"b", "c"} and "missing" in got.failed["b"]
    assert pipeline.run_stages(stages, {"x": df, "y": df}, from_step="b", skip=["c"]).ran == ["d"]
    for bad in ({"from_step": "q"}, {"from_step": "d"}):
        with pytest.raises(ValueError):
            pipeline.run_stages(stages, {}, **bad)


def test_command_line(spark, data, tmp_path):
    assert pipeline.main(["load", data, str(tmp_path / "g"), "--skip", "metrics"]) == 0
    assert spark.read.parquet(str(tmp_path / "g/e_transmitted_to")).count() > 0
    assert pipeline.main(["sql", "select 1"]) == 0
    assert pipeline.main(["validate", data]) in (0, pipeline.Exit.FINDINGS)
    assert pipeline.main(["load", data, str(tmp_path / "g"), "--from-step", "nope"]) == pipeline.Exit.BAD_ARGUMENT


def test_load_makes_all_edges_and_measures(spark, data, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    for n in ("hadiths", "narrators_canonical", "collections", "mentions_resolved"):
        (d / f"{n}.parquet").symlink_to(f"{data}/{n}.parquet")
    assert pipeline.main(["load", data, str(tmp_path / "a"), "--skip", "chains", "edges"]) == pipeline.Exit.MISSING_INPUT
    a, b = [r["id"] for r in spark.read.parquet(str(tmp_path / "a/n_hadith")).orderBy("id").limit(2).collect()]
    spark.createDataFrame([(b, a, 0.9, "verbatim", False), (a, "hdt:gone", 0.9, "verbatim", False)], "hadith_id_a string, hadith_id_b string, similarity_score float, variant_type string, cross_sect boolean").write.parquet(str(d / "parallel_links.parquet"))
    spark.createDataFrame([("مالك", None, "نافع", None, "STUDIED_UNDER")], "from_name string, from_external_id string, to_name string, to_external_id string, relation string").write.parquet(str(d / "network_edges.parquet"))
    assert pipeline.main(["load", str(d), str(tmp_path / "g")]) == 0
    assert [(r["from_id"], r["to_id"]) for r in spark.read.parquet(str(tmp_path / "g/e_parallel_of")).collect()] == [(a, b)]
    assert (tmp_path / "g/e_studied_under").exists()
    for m in ("m_betweenness", "m_community"):
        assert spark.read.parquet(str(tmp_path / f"g/{m}")).count() > 0


def test_quality(spark):
    d = spark.createDataFrame([("a", "x"), ("a", None), (None, "bad")], "id string, g string")
    assert {(r["column_name"], r["null_pct"]) for r in K.null_shares(d, "t").collect()} == {("id", 33.33), ("g", 33.33)}
    assert K.table_checks(d, "t", "id").first()["value"] == 1
    assert [tuple(r) for r in K.out_of_domain(d, {"g": ("x",)}).collect()] == [("g", "bad", 1)]
    assert K.unrouted(d, "g", ["x"]) == ["bad"]
    m = lambda *v: spark.createDataFrame(list(v), "metric string, value double")
    got = {r["metric"]: (r["drift_pct"], r["within"]) for r in K.drift(m(("a", 120.0), ("z", 0.0), ("y", 1.0)), m(("a", 100.0), ("z", 0.0), ("y", 0.0))).collect()}
    assert got == {"a": (20.0, True), "z": (0.0, True), "y": (100.0, False)}
    assert K.null_shares(d.limit(0), "t").where("null_pct = 0").count() == 2


def test_streams(spark, data, tmp_path):
    batch = spark.read.parquet(f"{data}/events.parquet")
    got = flows.drain(spark, flows.tumbling(flows.events(spark, data), late="3650 days"), str(tmp_path / "a"), "complete")
    assert got.groupBy().sum("events").first()[0] == batch.count()
    s = flows.drain(spark, flows.sessions(flows.events(spark, data)), str(tmp_path / "b"))
    assert s.where("session_end <= session_start").count() == 0
    one = flows.drain(spark, flows.first_seen(flows.events(spark, data), "event_id"), str(tmp_path / "c"))
    assert one.count() == batch.select("event_id").distinct().count()
    for n in range(3):  # several files, one at each trigger, and a second run on the same state
        batch.where(F.col("event_id") % 3 == n).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: flows.events(spark, str(tmp_path / "in"), "*.parquet")
    got = flows.drain(spark, flows.tumbling(stream(), late="3650 days"), str(tmp_path / "e"), "complete")
    assert got.columns == ["window_start", "event_type", "events", "total"] and got.count() == got.select("window_start", "event_type").distinct().count() and got.groupBy().sum("events").first()[0] == batch.count()
    for extra in (0, 5):
        if extra:
            batch.limit(extra).write.mode("append").parquet(str(tmp_path / "in"))
        got = flows.drain(spark, flows.running_totals(stream()), str(tmp_path / "f"), "update", ["user_id"])
        assert got.count() == batch.select("user_id").distinct().count() and got.groupBy().sum("events").first()[0] == batch.count() + extra
    with pytest.raises(ValueError, match="keys"):
        flows.drain(spark, flows.running_totals(stream()), str(tmp_path / "g"), "update")
    files = flows.drain(spark, flows.landed(spark, data, "*.parquet"), str(tmp_path / "d"))
    assert files.where("size > 0").count() == len(list(pathlib.Path(data).glob("*.parquet")))
