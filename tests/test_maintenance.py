import hashlib
import json

import pytest
from pyspark.sql import functions as F

from khayt.operators import maintenance as M
from khayt.sources import fetch


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_ids_and_measures(spark):
    e = spark.createDataFrame([("hdt:lk:lk:1",), ("lk:x:1",), ("hdt:lk:lk",), (None,)], "h string")
    new, changed = M.migrate_ids(e, "h")
    assert rows(new) == sorted([("hdt:lk:1",), ("hdt:lk:x:1",), ("hdt:lk:lk",), (None,)], key=str)
    assert ("hdt:lk:lk:1", "hdt:lk:1", 1) in rows(changed)
    n = spark.createDataFrame([("a", 0.5)], "id string, rank double")
    assert rows(M.invalidate(n, ["rank"])) == [("a", None)]
    with pytest.raises(ValueError):
        M.invalidate(n, ["nope"])


def test_scrub_cascades(spark):
    r = spark.createDataFrame([("1", "مالك رضي الله عنه"), ("2", "رجل")], "id string, name string")
    m = spark.createDataFrame([("m", "1"), ("n", "2")], "mention string, person string")
    k = spark.createDataFrame([("1", "2"), ("1", "1")], "a string, b string")
    got = M.scrub_names(r, m, k)
    assert rows(got[0]) == [("1", "مالك")] and got[1].count() == 1 and rows(got[2].select("a", "b")) == [("1", "1")]


def test_facts_topics_samples(spark):
    c = spark.createDataFrame([("lk:x", None, 5), ("lk:y", "own", None)], "collection_id string, compiler_name string, expected_count int")
    f = spark.createDataFrame([("x", "A", 9), ("y", "B", 9)], "slug string, compiler_name string, expected_count int")
    assert rows(M.fill_collections(c, f, ("compiler_name", "expected_count"))) == [("lk:x", "A", 5), ("lk:y", "own", 9)]
    t = spark.createDataFrame([("1", "prayer and fasting, prayer again and trade"), ("2", "short prayer"), ("3", None)], "id string, t string")
    got = M.topics(t, "id", "t", {"worship": ["prayer", "fasting"], "law": ["trade"], "none": ["x"]})
    assert [r[:3] for r in rows(got)] == [("1", 1, "worship"), ("1", 2, "law")]
    d = spark.range(50)
    assert rows(M.sample(d, "id", 5)) == rows(M.sample(d.repartition(3), "id", 5)) and M.sample(d, "id", 5).count() == 5
    b = spark.createDataFrame([("key",), (None,)], "t string").select(M.blake2b("t"))
    assert rows(b) == sorted([(hashlib.blake2b(b"key", digest_size=8).hexdigest(),), (None,)], key=str)


def test_fetch(spark, tmp_path):
    for n in (1, 2):
        (tmp_path / f"p{n}.json").write_text(json.dumps({"data": [{"n": n}, {"n": n * 10}]}))
    got = fetch.paged_json(spark, f"file://{tmp_path}/p{{page}}.json", 4)
    assert rows(got.select("page", F.get_json_object("record", "$.n"))) == [(1, "1"), (1, "10"), (2, "2"), (2, "20")]
    out = fetch.download(f"file://{tmp_path}/p1.json", str(tmp_path / "d/x"))
    assert fetch.download("file:///none", out) == out
    with pytest.raises(ValueError):
        fetch.download(f"file://{tmp_path}/p1.json", str(tmp_path / "d/y"), sha256="0")
    with pytest.raises(OSError):
        fetch.download("file:///none/x", str(tmp_path / "d/z"), tries=1)


def test_pages_that_cannot_be_had_fail_the_read(spark, tmp_path):
    import http.server
    import threading

    class Pages(http.server.BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            code = {"1": 200, "2": 404}.get(self.path[1:], 500)
            self.send_response(code)
            self.end_headers()
            self.wfile.write(b'{"data": [{"a": 1}]}' if code == 200 else b"{}")

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/{{page}}"
    assert [r["page"] for r in fetch.paged_json(spark, url, 2).collect()] == [1]
    with pytest.raises(Exception, match="500"):
        fetch.paged_json(spark, url, 3, tries=2, wait=0.01).collect()
    server.shutdown()
