import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from khayt.functions import arabic as A
from khayt.functions import names as N
from khayt.functions import scalars as S
from khayt.functions import segment as G
from khayt.functions import similarity as Y


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize(("raw", "want"), [("أَحْمَدُ  بْنُ‏ مُوسَى", "احمد بن موسي"), ("فاطمة", "فاطمه"), ("مـحـمد علي", "محمد علي"), ("کریم", "كريم"), ("سؤال", "سءال"), ("", ""), (None, None), ("   ", "")])
def test_normalize(spark, raw, want):
    assert one(spark, raw, A.normalize_arabic) == want
    if raw is not None:
        assert G.normal(raw) == want


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ابةىأؤـَ​ x،1", max_size=30))
def test_normal_is_idempotent(text):
    assert G.normal(G.normal(text)) == G.normal(text)


def test_text_functions(spark):
    assert one(spark, "متن، متن12", A.strip_to_letters) == "متن متن"
    assert one(spark, "John (saw) محمد بن علي 12", A.arabic_span) == "محمد بن علي"
    assert one(spark, "John", A.arabic_span) == "John"
    assert one(spark, "حَدَّثَنا مالك", A.has_transmission_term) is True
    assert one(spark, "عنبسة ومقالة", A.has_transmission_term) is False
    assert one(spark, "أبي عبدالله عليا", A.canonical_surface) == "ابو عبد الله علي"
    assert one(spark, "ابن عمر", A.transliterate) == "Ibn Umar"
    assert one(spark, "محمد بن صطم", A.transliterate) == "Muhammad ibn Stm"
    assert one(spark, None, A.transliterate) == ""


@pytest.mark.parametrize(("raw", "want"), [("صحيح لغيره", "sahih_li_ghayrihi"), ("Da'if", "daif"), ("حَسَن", "hasan"), ("fabricated", "mawdu"), (None, "unknown"), ("?", "unknown"), ("authentic chain", "sahih")])
def test_grade(spark, raw, want):
    assert one(spark, raw, S.normalize_grade) == want


@pytest.mark.parametrize(
    ("said", "want"),
    [("168 هـ", (168, 168, 168, "exact")), ("بين 161 هـ إلى 170 هـ", (161, 161, 170, "range")), ("135-130", (135, 130, 135, "range")), ("بعد ١٣٠", (130, 130, None, "after")), ("قبل 95 هـ", (95, None, 95, "before")),
     ("180 هـ تقريبا", (180, 180, 180, "circa")), ("73 هـ أو 74 هـ وقيل 59 هـ", (73, 59, 74, "range")), ("-", None), ("في خلافة", None), ("9999", None), (None, None), ("99999999999", None)],
)
def test_year_notation(spark, said, want):
    got = one(spark, said, S.parse_year)
    assert (tuple(got) if got else None) == want


def test_calendar(spark):
    assert one(spark, 1, S.ah_to_ce, "int") == 622 and one(spark, 1, S.ah_to_ce_end, "int") == 623
    assert one(spark, 256, S.ah_to_ce, "int") == 869 and one(spark, 0, S.ah_to_ce, "int") is None
    assert one(spark, 1, S.hijri_date, "int").isoformat() == "0622-07-19"
    for y in (1, 100, 450, 1400):
        assert abs(one(spark, one(spark, y, S.ah_to_ce_end, "int"), S.ce_to_ah, "int") - y) <= 1


def test_ids(spark):
    ns = uuid.UUID(S.NAMESPACE)
    for name in ("محمد بن علي", "", "x" * 5000):
        assert one(spark, name, S.uuid5) == str(uuid.uuid5(ns, name))
    assert one(spark, "a", lambda c: S.canonical_id(c, F.lit("d:1"))) == "nar:" + str(uuid.uuid5(ns, "a\x1fd:1"))
    assert one(spark, "a", lambda c: S.canonical_id(c, F.lit(""))) == one(spark, "a", S.canonical_id)
    assert one(spark, "lk:lk:1", S.is_doubled) is True and one(spark, "hdt:lk:x:1", S.is_doubled) is False
    assert one(spark, "hdt:fawaz:nawawi:1", S.in_composition_by_id) is True and one(spark, "fawaz:bukhari:1", S.in_composition_by_id) is False and one(spark, "lk", S.in_composition_by_id) is True


def test_sects_and_deaths(spark):
    for corpora, want in ((["lk"], "sunni"), (["thaqalayn"], "shia"), (["lk", "thaqalayn"], "neutral"), (["muhaddithat"], "neutral"), (["itqan"], "unknown"), (None, "unknown"), ([None], "unknown")):
        assert one(spark, corpora, S.sect_affiliation, "array<string>") == want
    assert one(spark, 300, lambda c: S.plausible_death(c, F.lit("sahabi")), "int") is False
    assert one(spark, 300, lambda c: S.plausible_death(c, F.lit(None).cast("string")), "int") is True
    assert one(spark, -5, S.clamp_death, "int") == 11
    assert [one(spark, v, S.safe_int) for v in ("1.0", "nan", "inf", "x", None, " 7 ")] == [1, None, None, None, None, 7]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcة ", max_size=25), st.text(alphabet="abcة ", max_size=25))
def test_ratio(a, b):
    assert Y.lcs(a, b) == lcs(a, b)
    assert 0 <= Y.ratio(a, b) <= 100 and Y.ratio(a, a) == 100


def test_token_set_ratio():
    assert Y.token_set_ratio("a b c", "a b") == 100 and Y.token_set_ratio("", "a") == 0
    assert Y.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100


def test_segment():
    text = "حَدَّثَنَا مالك عن نافع قال سمعت ابن عمر يقول"
    assert [(n, m) for n, _, m in G.segment(text)] == [("مالك", "haddathana"), ("نافع", "an"), ("ابن عمر", "samitu")]
    assert G.segment("عنبسة بن معن") == [("عنبسه بن معن", 0, None)]
    assert [n for n, _, _ in G.segment("Narrated Ali from Umar said that", "en")] == ["Ali", "Umar"]
    assert G.segment(None) == [] and G.segment("  ") == []
    got = G.split_chain("حدثنا مالك عن نافع عن ابن عمر أن النبي قال: كذا")
    assert got[0] == "حدثنا مالك عن نافع عن ابن عمر" and got[2] == "both"
    assert G.split_chain("كلام بلا سند") is None and G.split_chain(None) is None


@pytest.mark.parametrize(
    ("raw", "want"),
    [("محمد بن علي رضي الله عنه", "محمد بن علي"), ("رجل", None), ("رجل من قريش", None), ("ابيه", None), ("النبي", None), ("رسول الله", None), ("حميد قلت لزينب", "حميد"), ("قال الرجل", None),
     ("it was narrated", None), ("<b>مالك</b>", "مالك"), ("عائشه زوج النبي", "عائشه"), ("يعني مالك", "مالك"), (None, None), ("", None), ("ا " * 40, None), ("Imam Malik (r.a)", "Malik")],
)
def test_clean_name(raw, want):
    assert N.clean_name(raw) == want
    if want:
        assert N.clean_name(want) == want
