import unicodedata

import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from khayt.llm import lookalike as L
from khayt.llm import markup as M
from khayt.llm import repetition as R


def plain(*texts):
    a, odd = L.plain_array(pa.array(texts, pa.string()))
    return a.to_pylist(), odd.tolist()


@pytest.mark.parametrize(
    ("raw", "want"),
    [("ﻻ إله", "لا إله"), ("أ", "أ"), ("إ", "إ"), ("ىٔ", "ئ"), ("کی", "كي"), ("مغفو٥ بن ز١دوك", "مغفوه بن زادوك"), ("١لكتاب هذ١", "الكتاب هذا"), ("سَعِيدُ بنُ عُمَرَ وَ١لنُّور", "سَعِيدُ بنُ عُمَرَ وَالنُّور"),
     ("a b　c", "a b c"), ("زي‌د", "زيد"), ("Αhmad Мalik", "Ahmad Malik"), ("ｆｕｌｌ－（", "full-("), ("ā", "ā"), ("ﬁn", "fin"), ("۱۲۳", "١٢٣"),
     ("K", "K"), ("أَ", "أَ")],
)
def test_odd(raw, want):
    assert plain(raw) == ([want], [True])


@pytest.mark.parametrize("text", ["", "قال ﷺ مُحَمَّد", "ـ علـي", "﴿نص﴾ «نص»", "پ چ ژ گ", "٤٥/٦ (ص ٤٥)", "Bukhārī, al-Ṣaḥīḥ", "two  blanks\nline", "Ελλάδα και Ψυχή", "Привет, Жизнь", "x < 3 & y", "٤٥", "نص A", "ج٥ ص١", "ح١ د٥", "قال١ ثم", "هذا١", "مج٢ ١٥", "ص ١", "بيت٥", "١٥محمد"])
def test_not_odd(text):
    assert plain(text) == ([text], [False])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abاأيىـَّٕٔ ​کﻻ١٥ΑА\u0304é\n", max_size=12)), max_size=8))
def test_form_is_a_fixed_point_and_composed(texts):
    out, odd = plain(*texts)
    again, none = plain(*out)
    assert again == out and not any(none)
    for a, b, o in zip(texts, out, odd, strict=True):
        assert (a is None) == (b is None)
        if a is not None:
            assert unicodedata.normalize("NFC", b) == b
            assert o or unicodedata.normalize("NFC", a) == unicodedata.normalize("NFC", b)


def test_plain_text_frame(spark):
    d = spark.createDataFrame([("a", "x y", 1, "clash"), ("a", "x y", 1, "clash"), (None, None, None, None), ("b", "", 2, ""), ("c", "ﻻ" * 300_000, 3, None)], "id string, t string, odd int, plain string")
    got = [tuple(r) for r in L.plain_text(d, "t", ["id", "odd"]).selectExpr("id", "left(plain, 3)", "length(plain)", "count(*) over ()").collect()]
    assert len(got) == 5 and ("c", "لال", 600_000, 5) in got and (None, None, None, 5) in got and ("b", "", 0, 5) in got
    assert L.plain_text(d.limit(0), "t", ["id"]).count() == 0


MARKED = {
    "<p>x": "tag", "cut off <spa": "tag", "cut </di": "tag", "a <span class=\"": "tag", "a</td></tr>": "tag", "a <!-- p. 3 --> b": "comment", "a &nbsp;b": "reference", "a &amp;nbsp; b": "reference", "cut &nbsp": "reference", "x &#1548; y": "reference", "## Head\n\ntext": "heading",
    "Head\n=====\ntext": "heading", "== Head ==\nx": "heading", "a **bold** b": "bold", "an *em* b": "emphasis", "an _em_ b": "emphasis", "a `code` b": "code", "```\nx = 1\n```": "code", "[a](https://x.y/1)": "link", "see [https://x.y lab] z": "outer link",
    "[[a|b]] c": "wiki link", "a ''b'' c": "wiki mark", "a '''b''' c": "wiki mark", "x{{cite|p=1}} y": "template", "{| class=\"t\"\n|-\n| 1 || 2\n|}": "wiki table", "| a | b |\n|---|---|\n| c | d |": "table", "t\n\n- a\n- b": "list",
    "1. a\n2. b": "list", "> q\n>\n> r": "quote", "\\textbf{x} y": "command", "\\begin{quote}x": "command", "a \\( \\tfrac{1}{2} \\) b": "formula", "a $\\frac{1}{4}$ b": "formula",
}
PLAIN = ["", "x & y", "&c. and so", "3 < 4 > 2", "<8> or > that", "<...> a <…> b <>", "<بن> كذا", "[sic] {word} [كذا]", "costs $26 or $4", "no. #7", "16 * 17", "word* and star*", "x (*) y", "ms_33_b", "= 27", "a -- b", "Bu'ayta 'Aljan ibn Sa'id", "it's 'quoted' here", "12. أيلول ثم 45. نص", "C:\\ x"]


@pytest.mark.parametrize(("text", "kind"), MARKED.items())
def test_markup_is_found_and_cleaned(text, kind):
    assert kind in {k for _, _, k in M.spans(text)}
    left = {k for _, _, k in M.spans(M.clean(text))}
    assert left <= {"heading", "list", "table", "code", "formula"}


@pytest.mark.parametrize("text", PLAIN)
def test_ordinary_signs_are_none(text):
    assert M.spans(text) == [] and M.clean(text) == text


def test_clean_keeps_structure():
    assert M.clean("<h2>T</h2><ul><li>a</li><li>b</li></ul><table><tr><td>1</td><td>2</td></tr></table>") == "## T\n- a\n- b\n| 1 | 2 |"
    assert M.clean("\\section*{T}\n\\begin{itemize}\n\\item a\n\\item b\n\\end{itemize}\nz") == "# T\n- a\n- b\nz"
    assert M.clean("a &lt;i&gt;b&lt;/i&gt; c") == "a b c" and M.clean("x [[a|b]] **c**") == "x b c"
    assert M.clean("```\nx = '''1'''\n```\n\\( a_1 \\)") == "```\nx = '''1'''\n```\n$a_1$"
    assert M.clean("<script>var x;</script>a<br>b") == "a\nb"


def test_content_regions():
    page = "\n".join(["<li><a href='#'>m</a></li>"] * 8 + ["A long line of plain text that says something of weight, again and again."] * 8 + ["<div><a href='x'>f</a></div>"] * 8)
    good = M.content_lines(page)
    assert good[10:14].all() and not good[:6].any() and not good[-6:].any()
    assert M.content_lines("a\nb").all() and M.content_lines("").all() and M.content_lines("== Head ==\n\nA line of text.\n- item\n\n| a | b |\n|---|---|").all()
    short = "<ul><li><a href='/a'>x</a></li><li><a href='/b'>y</a></li></ul>\nA line of text that says something.\nAnd another one."
    assert M.content_lines(short).tolist() == [False, True, True]
    assert M.content_lines("<p>A paragraph of text in its tags.</p>\n<p>And one more.</p>").all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*MARKED, *PLAIN, "", "plain text"]), max_size=12))
def test_regions_are_there_if_and_only_if_signs_are(parts):
    text = "\n\n".join(parts)
    assert M.holds_markup(text) == bool(M.spans(text))


def test_no_length_hides_markup():
    for text in ("a \\(" + "x + " * 800 + "\\) b", "a $$" + "x + " * 800 + "$$ b", "a $" + "x + " * 800 + "\\alpha$ b", "class=\"" + "t " * 500 + "\">rest", "words " * 9_000 + "<b>x</b>", "x &" + "amp;" * 40 + "lt;b&gt; y"):
        assert M.holds_markup(text)
    assert {k for _, _, k in M.spans("a \\(" + "x + " * 800 + "\\) b")} == {"formula"} and M.clean("x &" + "amp;" * 40 + "lt;b&gt; y") == "x  y"
    assert not M.holds_markup("costs $5 and \\ more, " * 5_000)
    for hard in ("$" * 20_000, "$\\a" * 20_000, "<" * 20_000, "\\(" * 20_000, "&amp;" * 20_000, "[[" * 20_000, "$ " + "\\a " * 20_000):
        M.spans(hard)


def test_markup_frame(spark):
    d = spark.createDataFrame([("a", "<b>x</b>", "clash"), ("b", None, "c"), ("c", "", None), ("d", "plain " * 50_000, ""), ("e", "<i>y</i> " * 5_000, ""), ("a", "<b>x</b>", "clash")], "id string, t string, found string")
    got = {r["id"]: r for r in M.read_markup(d, "t", ["id"]).collect()}
    assert got["a"]["found"] and got["a"]["clean"] == "x" and not got["b"]["found"] and got["b"]["clean"] is None and got["c"]["clean"] == "" and not got["d"]["found"] and "<" not in got["e"]["clean"]
    assert M.read_markup(d, "t", ["id"], want=False).where("found").count() == 3 and M.read_markup(d.limit(0), "t", ["id"]).count() == 0


def brute(text, window=5):
    if not text:
        return 0, 0
    words = regex.findall(r"\p{L}+", "".join(c for c in text.lower() if not unicodedata.category(c).startswith("M")))
    seen, mark = set(), [False] * len(words)
    for i in range(len(words) - window + 1):
        key = tuple(words[i : i + window])
        if key in seen:
            mark[i : i + window] = [True] * window
        seen.add(key)
    return len(words), sum(mark)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aA bَ\n.ا1", max_size=80)), max_size=6))
def test_repetition_against_brute_force(texts):
    got = R.judge(pa.array(texts, pa.string()))
    assert list(zip(got["words"].tolist(), got["repeated"].tolist(), strict=True)) == [brute(t) for t in texts]


LINES = st.lists(st.sampled_from(["one two three four five six. ", "one two three four five\n", "Home | About us | Contact\n", "All rights reserved\r", "*** ---\n", "a b ! ? ; :\n", "نص آخر؟ ", "x ", "\n"]), max_size=12).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(LINES, max_size=4))
def test_what_is_kept_has_the_words_not_lost(texts):
    got = R.judge(pa.array(texts, pa.string()))
    for t, words, lost, rep, kept in zip(texts, got["words"], got["lost"], got["repeated"], got["text"].to_pylist(), strict=True):
        assert brute(t)[1] == rep <= lost and brute(kept)[0] == words - lost


def test_line_rules():
    def kept(t):
        got = R.judge(pa.array([t]))
        return got["text"].to_pylist()[0], got["failed"].tolist()[0]

    assert kept("Home | About us | Contact\nA line of text | with one bar") == ("A line of text | with one bar", 1)
    assert kept("-- ++ == x\nwords here") == ("words here", 1) and kept("12\u202834 plain") == ("34 plain", 1)
    assert kept("Good text. All rights reserved. More text.") == ("Good text. More text.", 1) and kept("The rights reserved, all of them.")[1] == 0
    assert kept("one two three four five six\nNow one two three four five, he said") == ("one two three four five six\nNow he said", 0)
    assert kept("سياسة الخصوصيّة\nكلام") == ("كلام", 1)


def test_repetition_frame(spark):
    line = "one two three four five six"
    d = spark.createDataFrame([(1, f"{line}\n{line}\nother words here", "clash"), (1, "short", None), (2, None, ""), (3, "", ""), (4, " \n ", ""), (5, "w x y z v " * 60_000, ""), (6, "***\nabc", "")], "id int, t string, share string")
    rows = R.repetition(d, "id", "t").collect()
    by = {r["id"]: r for r in rows if r["id"] != 1}
    first = next(r for r in rows if r["lines"] == 3)
    assert len(rows) == 7 and (first["words"], first["repeated"], first["failed_lines"], first["rejected"], first["kept"]) == (15, 6, 1, True, f"{line}\nother words here")
    assert by[2]["share"] == 0 and by[2]["kept"] is None and not by[3]["rejected"] and by[4]["words"] == 0 and by[5]["rejected"] and by[6]["failed_lines"] == 1
    assert R.repetition(d.limit(0), "id", "t").count() == 0
    nav = spark.createDataFrame([(1, "Home | About us | Contact\n" * 13 + "One sentence that is left of it all here.")], "id int, t string")
    assert R.repetition(nav, "id", "t", window=99).first()["rejected"]
