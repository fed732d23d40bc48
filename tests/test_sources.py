import dataclasses
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from khayt.operators import quality as K
from khayt.sources import adapters as A
from khayt.sources import readers as R
from khayt.sources import sinks, views


def put(path, text, mode="w"):
    path.parent.mkdir(parents=True, exist_ok=True)
    (path.write_bytes if mode == "b" else path.write_text)(text)


def workbook(path, table):
    path.parent.mkdir(parents=True, exist_ok=True)
    cell = lambda i, j, v: f'<c r="{chr(65 + j)}{i + 1}" t="inlineStr"><is><t>{v}</t></is></c>'
    body = "".join(f'<row r="{i + 1}">{"".join(cell(i, j, v) for j, v in enumerate(r) if v is not None)}</row>' for i, r in enumerate(table))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    head = ",".join(A.BILINGUAL)
    put(d / "lk/Nesai/Chapter1.csv", head + '\n1.0,One,باب,2,S,ق,3.0,"Full, text",Narrated Ali:,Matn <b>en</b>,كامل,حدثنا مالك عن نافع,متن,nan,nan,صحيح\n')
    put(d / "sanadset/x.csv", 'Hadith,Book,Num_hadith,grade\n"<SANAD>حدثنا <NAR>مالك</NAR> عن <NAR>نافع</NAR></SANAD><MATN>النص</MATN>",My Book,7,sahih\n"حدثنا مالك عن نافع عن ابن عمر قال: كذا وكذا",My Book,8,\n')
    put(d / "sunnah_api/nasai_hadiths.json", json.dumps([{"hadithNumber": "5", "bookNumber": "1", "hadith": [{"lang": "ar", "body": "نص"}, {"lang": "en", "body": "text"}], "grades": [{"grade": "Sahih"}]}]))
    put(d / "sunnah_scraped/musnad.json", json.dumps([{"book_number": "1", "text_ar": "ا"}, {"book_number": "1", "text_ar": "ب"}, {"book_number": "2", "hadith_number": "9", "text_ar": "ج"}]))
    put(d / "fawaz/ara-qudsi.json", json.dumps({"hadiths": [{"hadithnumber": 1, "text": "عربي"}, {"hadithnumber": 2, "text": "ثان"}]}))
    put(d / "fawaz/eng-qudsi.json", json.dumps({"hadiths": [{"hadithnumber": 1, "text": "english", "grades": [{"grade": "Hasan"}]}, {"hadithnumber": 3, "text": "third"}]}))
    put(d / "thaqalayn/1.json", json.dumps([{"bookId": "kafi", "id": 1, "book": "Al-Kafi", "volume": 2, "arabicText": "نص", "englishText": "e", "majlisiGrading": "", "behbudiGrading": "sahih"}, {"bookId": "kafi", "id": 1, "englishText": "again"}]))
    put(d / "tusi/b/1.json", json.dumps({"kind": "verse_detail", "data": {"verse": {"path": "/books/istibsar:1:2:3", "text": ["متن"], "narrator_chain": {"parts": [{"text": "عن علي"}]}}, "chapter_title": {"ar": "باب"}}}))
    put(d / "tusi/b/index.json", json.dumps({"kind": "chapter_list"}))
    put(d / "bihar/volume-1-part-1.html", "<html><body><p>باب 1 كذا</p><p>1- نص أول<sup>a</sup></p><p>English one</p><p>تتمة</p><p>2- نص ثان</p></body></html>")
    put(d / "halimbahae/Musnad.csv", "1,‏نص مشكول\n2,آخر\n")
    workbook(d / "mis/d.xlsx", [["Hadith No", "Isnad No", "Position", "Narrator Name"], ["1", "1", "1", "a"], ["1", "1", "2", "b"], ["1", "2", "1", "c"], ["1", "2", "2", "a"]])
    put(d / "itqan/0.json", json.dumps({"1": {"id": "1", "full_name": "مالك", "grade_en": "reliable", "death": "179 هـ", "teachers": ["2"], "students": [], "namings": ["مالك الإمام", "مالك", "-"], "tabaqat": "السابعة"}, "2": {"id": "2", "full_name": "نافع", "students": ["1"], "grade_en": "companion"}}))
    put(d / "muhaddithat/narrators.csv", "id,displayName,gender\n1,Aisha,Female\n2,Amra,Female\n")
    put(d / "muhaddithat/hadiths.csv", 'id,narrator_ids\n9,"1, 2,2, 3"\n')
    return str(d)


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_all_adapters(spark, raw, tmp_path):
    tables, failed = A.parse_all(spark, raw)
    assert not failed
    h = tables["hadiths"].cache()
    assert rows(h.where("_source = 'lk'"), "source_id", "matn_en", "grade") == [("lk:nesai:1:3", "Matn en", "صحيح")]
    m = tables["narrator_mentions"]
    assert rows(m.where("_source = 'lk'"), "chain_index", "position_in_chain", F.coalesce("name_ar", "name_en")) == [(0, 0, "مالك"), (0, 1, "نافع"), (1, 0, "Ali")]
    assert rows(m.where("_source = 'sanadset'"), "source_hadith_id", "name_ar") == [("sanadset:my_book:7", "مالك"), ("sanadset:my_book:7", "نافع"), ("sanadset:my_book:8", "ابن عمر"), ("sanadset:my_book:8", "مالك"), ("sanadset:my_book:8", "نافع")]
    assert rows(h.where("_source = 'sunnah_api'"), "source_id", "matn_en", "grade") == [("sunnah:nasai:1:5", "text", "Sahih")]
    assert rows(h.where("_source = 'sunnah_scraped'"), "book_number", "hadith_number", "matn_ar") == [(1, 1, "ا"), (1, 2, "ب"), (2, 9, "ج")]
    assert rows(h.where("_source = 'fawaz'"), "hadith_number", "matn_ar", "matn_en", "grade") == [(1, "عربي", "english", "Hasan"), (2, "ثان", None, None), (3, None, "third", None)]
    assert rows(h.where("_source = 'thaqalayn'"), "source_id", "grade", "full_text_en") == [("thaqalayn:kafi:1", "sahih", "e")]
    assert rows(h.where("_source = 'tusi'"), "source_id", "matn_ar") == [("tusi:istibsar:1:2:3", "عن علي متن")]
    assert rows(h.where("_source = 'bihar'"), "hadith_number", "chapter_number", "matn_ar", "matn_en") == [(1, 1, "نص أول تتمة", "English one"), (2, 1, "نص ثان", None)]
    assert rows(h.where("_source = 'halimbahae'"), "source_id", "full_text_ar") == [("halimbahae:musnad:1", "نص مشكول"), ("halimbahae:musnad:2", "آخر")]
    e = tables["network_edges"]
    assert rows(e.where("_source = 'mis'"), "from_narrator_name", "to_narrator_name", "relation") == [("a", "b", "TRANSMITTED_TO"), ("c", "a", "TRANSMITTED_TO")]
    assert rows(e.where("_source = 'itqan'"), "from_narrator_name", "to_narrator_name", "relation") == [("مالك", "نافع", "STUDIED_UNDER")]
    assert rows(e.where("_source = 'muhaddithat'"), "from_narrator_name", "to_narrator_name") == [("Aisha", "Amra"), ("Amra", "3")]
    b = tables["narrators_bio"]
    assert rows(b.where("_source = 'itqan'"), "bio_id", "death_year_ah", "generation", "trustworthiness") == [("itqan:1", 179, "taba_tabii", "thiqa"), ("itqan:2", None, "sahabi", "thiqa")]
    assert rows(tables["narrator_aliases"], "alias") == [("مالك الإمام",)]
    assert ("thaqalayn:kafi", "Al-Kafi (Volume 2)", 1) in rows(tables["collections"], "collection_id", "name_en", "total_hadiths")
    sinks.write_staged(h, "hadiths", str(tmp_path / "hadiths"))
    assert spark.read.parquet(str(tmp_path / "hadiths")).count() == h.count()
    with pytest.raises(sinks.Refused):
        sinks.write_staged(h.withColumn("source_id", F.lit(None).cast("string")), "hadiths", str(tmp_path / "x"))
    got = A.enrich(h.where("_source = 'fawaz'").drop("_source"), h.where("_source = 'fawaz'").drop("_source"))
    assert got.count() == 3


def test_failing_source_stops_no_other(spark, raw):
    tables, failed = A.parse_all(spark, raw + "/none", ["lk"])
    assert not tables and "lk" in failed


def test_readers(spark, tmp_path):
    put(tmp_path / "a.csv", "x,y\n1,é\n".encode("latin-1"), "b")
    assert R.texts(spark, str(tmp_path), "*.csv").first()["text"].endswith("é\n")
    assert R.select_texts("<div class='a'>one<br>two</div><p>three</p>", ["p.none", ".a"]) == ["one two"]
    assert R.select_texts("", ["p"]) == [] and R.select_texts("<p>cut", ["p"]) == []
    put(tmp_path / "s.yaml", "- {id: e1, n: 3}\n- {id: e2}\n")
    assert rows(R.yaml(spark, str(tmp_path / "s.yaml"), "id string, n int"), "id", "n") == [("e1", 3), ("e2", None)]


def test_views(spark, tmp_path):
    assert views.plan_views({"hadiths_a": (1,), "hadiths_b": (1,), "other": (2,)})["hadiths"] == ["hadiths_a", "hadiths_b"]
    for n in ("hadiths_a", "hadiths_b"):
        spark.createDataFrame([(n, 1)], "id string, v int").write.parquet(str(tmp_path / f"{n}.parquet"))
    put(tmp_path / "broken.parquet", "no")
    assert views.query(spark, {"staging": str(tmp_path)}, "select count(*) n from staging_hadiths").first()["n"] == 2


def test_manifests_and_records(spark, tmp_path):
    put(tmp_path / "d/a.txt", "1")
    put(tmp_path / "d/b.txt", "1")
    was = spark.createDataFrame(K.manifest(spark, str(tmp_path / "d")).collect())
    put(tmp_path / "d/b.txt", "2")
    put(tmp_path / "d/c.txt", "3")
    (tmp_path / "d/a.txt").unlink()
    got = {r["path"][-5:]: r["state"] for r in K.compare_manifests(K.manifest(spark, str(tmp_path / "d")), was).collect()}
    assert got == {"a.txt": "removed", "b.txt": "modified", "c.txt": "added"}
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    assert K.fingerprint(df).first() == K.fingerprint(df.orderBy(F.desc("a"))).first()
    rec = sinks.run_record(str(tmp_path / "run.json"), {"s": "ran"}, {"t": df}, "complete")
    assert sinks.may_publish(rec, {"t"}) == [] and sinks.may_publish(rec, {"u"}) == ["u is missing"]
    with pytest.raises(ValueError):
        sinks.run_record(str(tmp_path / "r.json"), {"s": "failed"}, {}, "complete")
    assert json.loads(sinks.messages(df, "a").first()["value"]) == {"a": 1, "b": "x"}
    assert sinks.send(df, "a", "localhost:1", sinks.TOPICS[0]) is False
    with_facts = sinks.with_provenance(df, "b", detector="lexical")
    with_facts.write.parquet(str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).schema["b"].metadata["detector"] == "lexical"


def test_csv_falls_back_file_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("k,v\n1,قال\n".encode())
    (tmp_path / "b.csv").write_bytes("k,v\n2,caf\xe9\n".encode("latin-1"))
    assert {(r["k"], r["v"]) for r in R.csv(spark, str(tmp_path)).collect()} == {("1", "قال"), ("2", "café")}
    assert {(r["a"], r["b"]) for r in R.csv(spark, str(tmp_path), columns=["a", "b"]).collect()} == {("1", "قال"), ("2", "café")}


def test_a_source_that_fails_as_it_runs_stops_no_other(spark, tmp_path, monkeypatch):


    def broken(spark, path):
        return {"hadiths": spark.range(3).select(F.raise_error(F.lit("corrupt")).cast("string").alias("source_id"))}

    def fine(spark, path):
        return {"hadiths": spark.range(2).select(F.col("id").cast("string").alias("source_id"))}

    made = {k: dataclasses.replace(next(iter(A.ADAPTERS.values())), slug=k, parse=f, active=True) for k, f in (("one", broken), ("two", fine))}
    monkeypatch.setattr(A, "ADAPTERS", made)
    got, failed = A.parse_all(spark, str(tmp_path))
    assert list(failed) == ["one"] and got["hadiths"].count() == 2 and {r["_source"] for r in got["hadiths"].collect()} == {"two"}


def test_wrong_column_raises_and_no_broker_does_not(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception, match="nope"):
        sinks.send(df, "nope", "localhost:1", sinks.TOPICS[0])
