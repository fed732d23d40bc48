"""The sources: a registry of adapters, each of which turns its raw folder into staging tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from khayt.functions import arabic as A
from khayt.functions import scalars as S
from khayt.functions.segment import segment_ar, segment_en, split_udf
from khayt.operators import sequence as Q
from khayt.runtime import stored
from khayt.schemas import conform
from khayt.sources import readers as R

Staged = dict[str, DataFrame]


@dataclass(frozen=True)
class Adapter:
    slug: str
    corpus: str
    sect: str
    parse: Callable[[SparkSession, str], Staged]
    active: bool = True


def _id(corpus: str, *parts: Column | str) -> Column:
    return F.concat_ws(":", F.lit(corpus), *[F.coalesce(p.cast("string"), F.lit("0")) if isinstance(p, Column) else F.lit(p) for p in parts])


def _mentions(hadiths: DataFrame) -> DataFrame:
    """Mentions of both chains: the Arabic is chain 0, the English chain 1; chains that cannot be cut are left out, never made names."""
    made = []
    for i, (lang, cut) in enumerate((("ar", segment_ar), ("en", segment_en))):
        rows = hadiths.where(F.trim(f"isnad_raw_{lang}") != "").select("source_id", "source_corpus", F.inline(cut(F.col(f"isnad_raw_{lang}"))))
        key = F.concat_ws(":", "source_id", F.lit(lang), "position")
        made.append(rows.select(key.alias("mention_id"), F.col("source_id").alias("source_hadith_id"), "source_corpus", F.col("position").alias("position_in_chain"), F.lit(i).alias("chain_index"), F.when(F.lit(lang == "ar"), F.col("name")).alias("name_ar"), F.when(F.lit(lang == "en"), F.col("name")).alias("name_en"), F.when(F.lit(lang == "ar"), A.normalize_arabic(F.col("name"))).alias("name_ar_normalized"), F.col("method").alias("transmission_method")))
    return made[0].unionByName(made[1])


def _collections(hadiths: DataFrame, corpus: str, sect: str, names: DataFrame | None = None) -> DataFrame:
    """One row per collection with its number of hadiths; display names from (collection_name, name_en, name_ar, compiler_name) where given."""
    n = hadiths.groupBy("collection_name").agg(F.count(F.lit(1)).cast("int").alias("total_hadiths"))
    n = n.join(names, "collection_name", "left") if names is not None else n
    got = {c: F.col(c) if c in n.columns else F.lit(None).cast("string") for c in ("name_en", "name_ar", "compiler_name")}
    return conform(n.select(_id(corpus, F.col("collection_name")).alias("collection_id"), F.coalesce(got["name_en"], F.col("collection_name")).alias("name_en"), got["name_ar"].alias("name_ar"), got["compiler_name"].alias("compiler_name"), F.lit(sect).alias("sect"), "total_hadiths", F.lit(corpus).alias("source_corpus")), "collections")


def _hadiths(df: DataFrame, corpus: str, sect: str) -> DataFrame:
    return conform(df.withColumn("source_corpus", F.lit(corpus)).withColumn("sect", F.lit(sect)), "hadiths")


def _strip(c: Column) -> Column:
    """Tags off, common references read, white space collapsed."""
    text = F.regexp_replace(c, "<[^>]*>", " ")
    for ref, ch in (("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(ref), F.lit(ch))
    return S.safe_str(A.clean_whitespace(text))


# The sixteen columns of the bilingual files, by place.
BILINGUAL = "Chapter_Number Chapter_English Chapter_Arabic Section_Number Section_English Section_Arabic Hadith_number English_Hadith English_Isnad English_Matn Arabic_Hadith Arabic_Isnad Arabic_Matn Arabic_Comment English_Grade Arabic_Grade".split()


def bilingual_csv(spark: SparkSession, path: str) -> Staged:
    """Sixteen columns by place; the folder names the collection."""
    r = R.csv(spark, path, columns=BILINGUAL).withColumn("collection_name", F.lower(F.regexp_extract("_path", r"([^/]+)/[^/]+$", 1)))
    book, number = S.safe_int(F.col("Chapter_Number")), S.safe_int(F.col("Hadith_number"))
    h = r.select(
        _id("lk", F.col("collection_name"), book, number).alias("source_id"), "collection_name", book.alias("book_number"), S.safe_int(F.col("Section_Number")).alias("chapter_number"), number.alias("hadith_number"),
        _strip(F.col("Arabic_Matn")).alias("matn_ar"), _strip(F.col("English_Matn")).alias("matn_en"), _strip(F.col("Arabic_Isnad")).alias("isnad_raw_ar"), _strip(F.col("English_Isnad")).alias("isnad_raw_en"),
        _strip(F.col("Arabic_Hadith")).alias("full_text_ar"), _strip(F.col("English_Hadith")).alias("full_text_en"), F.coalesce(S.safe_str(F.col("English_Grade")), S.safe_str(F.col("Arabic_Grade"))).alias("grade"),
        _strip(F.col("Chapter_Arabic")).alias("chapter_name_ar"), _strip(F.col("Chapter_English")).alias("chapter_name_en"),
    )
    h = _hadiths(h, "lk", "sunni")
    return {"hadiths": h, "narrator_mentions": conform(_mentions(h), "narrator_mentions"), "collections": _collections(h, "lk", "sunni")}


def tagged_csv(spark: SparkSession, path: str) -> Staged:
    """Texts with tagged chain, names and text; the chain comes from the tags, else from a column that lists names, else from the text itself."""
    r = R.csv(spark, path)
    have = {c.lower(): c for c in r.columns}

    def col(*names: str) -> Column:
        return F.coalesce(*[F.col(have[n]) for n in names if n in have], F.lit(None).cast("string"))

    text = col("hadith", "text")
    tag = lambda t: F.nullif(F.regexp_extract(text, f"(?s)<{t}>(.*?)</{t}>", 1), F.lit(""))
    names = F.transform(F.regexp_extract_all(text, F.lit("(?s)<NAR>(.*?)</NAR>"), 1), _strip)
    listed = F.transform(F.regexp_extract_all(F.coalesce(col("sanad"), F.lit("")), F.lit("'([^']+)'"), 1), A.clean_whitespace)
    book = F.lower(F.regexp_replace(F.trim(F.coalesce(col("book"), F.lit("unknown"))), r"\s+", "_"))
    r = r.select(text.alias("t"), book.alias("collection_name"), S.safe_int(col("num_hadith", "number")).alias("hadith_number"), S.safe_str(col("grade")).alias("grade"), names.alias("names"), listed.alias("listed"), _strip(tag("SANAD")).alias("sanad"), _strip(tag("MATN")).alias("matn"), _strip(text).alias("full"))
    r = r.withColumn("cut", F.when(F.col("sanad").isNull(), split_udf("full")))
    h = r.select(_id("sanadset", F.col("collection_name"), F.col("hadith_number")).alias("source_id"), "collection_name", "hadith_number", F.coalesce("matn", "cut.text", "full").alias("matn_ar"), F.coalesce("sanad", "cut.chain").alias("isnad_raw_ar"), F.col("full").alias("full_text_ar"), "grade", "names", "listed")
    tagged = F.when(F.size("names") > 0, F.col("names")).when(F.size("listed") > 0, F.col("listed"))
    direct = h.where(tagged.isNotNull()).select("source_id", F.posexplode(tagged).alias("position_in_chain", "name_ar")).where("name_ar <> ''").select(F.concat_ws(":", "source_id", F.lit("ar"), "position_in_chain").alias("mention_id"), F.col("source_id").alias("source_hadith_id"), F.lit("sanadset").alias("source_corpus"), "position_in_chain", F.lit(0).alias("chain_index"), "name_ar", A.normalize_arabic(F.col("name_ar")).alias("name_ar_normalized"))
    cut = _mentions(_hadiths(h.where(tagged.isNull()).drop("names", "listed"), "sanadset", "sunni"))
    out = _hadiths(h, "sanadset", "sunni")
    return {"hadiths": out, "narrator_mentions": conform(direct, "narrator_mentions").unionByName(conform(cut, "narrator_mentions")), "collections": _collections(out, "sanadset", "sunni")}


def api_json(spark: SparkSession, path: str) -> Staged:
    """Records whose texts are listed by language; one grade as it is, several as JSON."""
    r = R.json(spark, path, "hadithNumber string, bookNumber string, chapterNumber string, chapterTitle string, body string, hadith array<struct<lang string, body string>>, grades array<map<string,string>>", "*_hadiths.json")
    text = lambda lang: F.get(F.filter(F.coalesce("hadith", F.array().cast("array<struct<lang:string,body:string>>")), lambda x: x["lang"] == lang), F.lit(0))["body"]
    grade = F.when(F.size("grades") == 1, F.get("grades", F.lit(0))["grade"]).when(F.size("grades") > 1, F.to_json("grades"))
    name, book, number = F.regexp_replace("_name", "_hadiths$", ""), S.safe_int(F.col("bookNumber")), S.safe_int(F.col("hadithNumber"))
    ar, en = S.safe_str(text("ar")), F.coalesce(S.safe_str(text("en")), S.safe_str(F.col("body")))
    h = r.select(_id("sunnah", name, book, number).alias("source_id"), name.alias("collection_name"), book.alias("book_number"), S.safe_int(F.col("chapterNumber")).alias("chapter_number"), number.alias("hadith_number"), ar.alias("matn_ar"), en.alias("matn_en"), ar.alias("full_text_ar"), en.alias("full_text_en"), grade.alias("grade"), S.safe_str(F.col("chapterTitle")).alias("chapter_name_en"))
    h = _hadiths(h, "sunnah", "sunni")
    return {"hadiths": h, "collections": _collections(h, "sunnah", "sunni")}


def scraped_json(spark: SparkSession, path: str) -> Staged:
    """One file per collection; numbers within a book are filled from the order of the records where a book has none."""
    r = R.texts(spark, path, "*.json").where("name not like 'manifest%'").select(F.col("name").alias("collection_name"), F.posexplode(F.from_json("text", "array<struct<hadith_number string, book_number string, chapter_number string, text_ar string, text_en string, grade string, chapter_name_ar string, chapter_name_en string>>")).alias("seq", "r")).select("collection_name", "seq", "r.*")
    r = r.select("collection_name", "seq", *[S.safe_int(F.col(c)).alias(c) for c in ("hadith_number", "book_number", "chapter_number")], *[S.safe_str(F.col(c)).alias(c) for c in ("text_ar", "text_en", "grade", "chapter_name_ar", "chapter_name_en")])
    r = r.withColumn("source_id", _id("sunnah", F.col("collection_name"), F.col("book_number"), F.col("chapter_number"), F.col("hadith_number")))
    r = Q.ordinals(r, ["collection_name", "book_number"], ["seq"], "hadith_number", F.lit(True))
    h = _hadiths(r.withColumn("matn_ar", F.col("text_ar")).withColumn("matn_en", F.col("text_en")).withColumn("full_text_ar", F.col("text_ar")).withColumn("full_text_en", F.col("text_en")), "sunnah", "sunni")
    return {"hadiths": h, "collections": _collections(h, "sunnah", "sunni")}


def edition_pair(spark: SparkSession, path: str) -> Staged:
    """An Arabic and an English edition of each book (ara-<book>, eng-<book>), joined in full on the number."""
    rec = "struct<hadithnumber:string,text:string,grades:array<map<string,string>>,reference:struct<book:string,hadith:string>>"
    raw = R.texts(spark, path, "*.json").select("name", F.explode(F.from_json("text", f"struct<hadiths:array<{rec}>>")["hadiths"]).alias("r"))
    side = lambda lang: raw.where(F.col("name").startswith(lang + "-")).select(F.substring("name", 5, 200).alias("collection_name"), S.safe_int(F.col("r.hadithnumber")).alias("hadith_number"), S.safe_str(F.col("r.text")).alias(f"t_{lang}"), F.col("r.grades").alias(f"g_{lang}"), S.safe_int(F.col("r.reference.book")).alias(f"b_{lang}")).where("hadith_number is not null")
    r = side("ara").join(side("eng"), ["collection_name", "hadith_number"], "full")
    g = F.coalesce(F.when(F.size("g_eng") > 0, F.col("g_eng")), F.when(F.size("g_ara") > 0, F.col("g_ara")))
    h = r.select(_id("fawaz", F.col("collection_name"), F.col("hadith_number")).alias("source_id"), "collection_name", F.coalesce("b_eng", "b_ara").alias("book_number"), "hadith_number", F.col("t_ara").alias("matn_ar"), F.col("t_eng").alias("matn_en"), F.col("t_ara").alias("full_text_ar"), F.col("t_eng").alias("full_text_en"), F.when(F.size(g) == 1, F.get(g, F.lit(0))["grade"]).otherwise(F.to_json(g)).alias("grade"))
    h = _hadiths(h, "fawaz", "sunni")
    return {"hadiths": h, "collections": _collections(h, "fawaz", "sunni")}


def book_json(spark: SparkSession, path: str) -> Staged:
    """One file per book, graded by several; the first grader that says something counts, the first record of an id stands."""
    f = "bookId string, id string, book string, volume string, author string, categoryId string, chapterInCategoryId string, chapter string, arabicText string, englishText string, thaqalaynSanad string, thaqalaynMatn string, majlisiGrading string, behbudiGrading string, behdudiGrading string, mohseniGrading string"
    r = R.texts(spark, path, "*.json").where("name rlike '^[0-9]+$'").select(F.col("name").cast("int").alias("file"), F.posexplode(F.from_json("text", f"array<struct<{f}>>")).alias("seq", "r")).select("file", "seq", "r.*")
    r = r.withColumn("book_id", S.safe_str(F.col("bookId"))).withColumn("number", S.safe_int(F.col("id"))).where("book_id is not null and number is not null").withColumn("source_id", _id("thaqalayn", F.col("book_id"), F.col("number")))
    r = r.withColumn("_i", F.row_number().over(Window.partitionBy("source_id").orderBy("file", "seq"))).where("_i = 1")
    grade = F.coalesce(*[S.safe_str(F.col(c)) for c in ("majlisiGrading", "behbudiGrading", "behdudiGrading", "mohseniGrading")])
    ar, en = S.safe_str(F.col("arabicText")), S.safe_str(F.col("englishText"))
    h = r.select("source_id", F.col("book_id").alias("collection_name"), S.safe_int(F.col("categoryId")).alias("book_number"), S.safe_int(F.col("chapterInCategoryId")).alias("chapter_number"), F.col("number").alias("hadith_number"), ar.alias("matn_ar"), F.coalesce(S.safe_str(F.col("thaqalaynMatn")), en).alias("matn_en"), S.safe_str(F.col("thaqalaynSanad")).alias("isnad_raw_en"), ar.alias("full_text_ar"), en.alias("full_text_en"), grade.alias("grade"), S.safe_str(F.col("chapter")).alias("chapter_name_en"))
    title, volume = S.safe_str(F.col("book")), S.safe_int(F.col("volume"))
    shown = F.when((volume > 0) & ~F.lower(title).contains("volume"), F.concat(title, F.lit(" (Volume "), volume, F.lit(")"))).otherwise(title)
    names = r.groupBy(F.col("book_id").alias("collection_name")).agg(F.min_by(shown, F.struct("file", "seq")).alias("name_en"), F.min_by(S.safe_str(F.col("author")), F.struct("file", "seq")).alias("compiler_name"))
    h = _hadiths(h, "thaqalayn", "shia")
    return {"hadiths": h, "narrator_mentions": conform(_mentions(h), "narrator_mentions"), "collections": _collections(h, "thaqalayn", "shia", names)}


def verse_json(spark: SparkSession, path: str) -> Staged:
    """One document per hadith, its place in its path; other documents of the folder are passed over."""
    f = "kind string, data struct<verse:struct<path:string,text:array<string>,narrator_chain:struct<parts:array<struct<text:string>>>>,chapter_title:struct<ar:string>>"
    r = R.json(spark, path, f, many=False).where("kind = 'verse_detail'")
    place = lambda i: F.regexp_extract("data.verse.path", r"^/books/([^:]+):(\d+):(\d+):(\d+)$", i)
    join = lambda c: F.nullif(F.array_join(F.filter(F.transform(c, lambda t: F.trim(t)), lambda t: t != ""), " "), F.lit(""))
    r = r.where(place(1) != "").select(place(1).alias("collection_name"), *[place(i + 2).cast("int").alias(c) for i, c in enumerate(("book_number", "chapter_number", "hadith_number"))], join(F.col("data.verse.narrator_chain.parts.text")).alias("isnad_raw_ar"), join(F.col("data.verse.text")).alias("body"), S.safe_str(F.col("data.chapter_title.ar")).alias("chapter_name_ar"))
    full = F.nullif(F.concat_ws(" ", "isnad_raw_ar", "body"), F.lit(""))
    h = _hadiths(r.withColumn("source_id", _id("tusi", F.col("collection_name"), F.col("book_number"), F.col("chapter_number"), F.col("hadith_number"))).withColumn("matn_ar", full).withColumn("full_text_ar", full), "tusi", "shia")
    return {"hadiths": h, "narrator_mentions": conform(_mentions(h), "narrator_mentions"), "collections": _collections(h, "tusi", "shia")}


def html_volumes(spark: SparkSession, path: str) -> Staged:
    """Paragraphs of a volume's page: chapter headings, numbered openings of hadiths, then their Arabic and English paragraphs until the next opening."""
    p = R.html(spark, path, ["p"])
    p = p.withColumn("text", A.clean_whitespace(A.strip_format_marks(F.col("text")))).where("text <> ''")
    chapter, number = F.regexp_extract("text", r"^\s*باب\s*(\d+)", 1).try_cast("int"), F.regexp_extract("text", r"^\s*(\d+)\s*[-–—]\s*", 1)
    opens = A.is_arabic(F.col("text")) & (number != "")
    w = Window.partitionBy("name").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn("n", F.sum(opens.cast("int")).over(w)).withColumn("chapter_number", F.last(chapter, True).over(w)).withColumn("hadith_number", F.last(F.when(opens, number.try_cast("int")), True).over(w))
    p = p.where((F.col("n") > 0) & chapter.isNull())
    body = F.regexp_replace("text", r"^\s*\d+\s*[-–—]\s*", "")
    side = lambda yes: F.nullif(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(A.is_arabic(F.col("text")) == F.lit(yes), F.struct("position", body.alias("b"))))), lambda x: x["b"]), " "), F.lit(""))
    r = p.groupBy("name", "n", "hadith_number").agg(F.min("chapter_number").alias("chapter_number"), side(True).alias("matn_ar"), side(False).alias("matn_en"))
    volume = F.regexp_extract("name", r"(?i)volume-(\d+)", 1).try_cast("int")
    h = r.withColumn("collection_name", F.lit("bihar-al-anwar")).withColumn("book_number", volume).withColumn("source_id", _id("bihar", "bihar-al-anwar", F.col("name"), F.col("n"), F.col("hadith_number"))).withColumn("full_text_ar", F.col("matn_ar")).withColumn("full_text_en", F.col("matn_en"))
    h = _hadiths(h, "bihar", "shia")
    return {"hadiths": h, "collections": _collections(h, "bihar", "shia")}


def plain_csv(corpus: str) -> Callable[[SparkSession, str], Staged]:
    def parse(spark: SparkSession, path: str) -> Staged:
        """Two columns without heading: number and marked text; the file names the collection."""
        r = R.csv(spark, path, header=False, columns=["number", "text"])
        stem, n = F.lower(F.regexp_extract("_path", r"([^/]+)\.csv$", 1)), S.safe_int(A.strip_format_marks(F.col("number")))
        text = S.safe_str(A.clean_whitespace(A.strip_format_marks(F.col("text"))))
        h = _hadiths(r.where(text.isNotNull()).select(_id(corpus, stem, n).alias("source_id"), stem.alias("collection_name"), n.alias("hadith_number"), text.alias("full_text_ar")), corpus, "sunni")
        return {"hadiths": h, "collections": _collections(h, corpus, "sunni")}

    return parse


def spreadsheet_pair(spark: SparkSession, path: str) -> Staged:
    """Sheets of chains: either one row per edge (from, to) or one per narrator of a chain with its place; no edge joins two chains."""
    r = R.xlsx(spark, path)
    pick = lambda *names: S.safe_str(F.coalesce(*[F.col("cells")[n] for n in names]))
    r = r.select("row", pick("hadith_no", "hadith_number", "hadith_id", "hadith").alias("hadith"), pick("isnad_no", "sanad_no", "isnad", "sanad").alias("sanad"), S.safe_int(pick("position", "order", "level")).alias("pos"), pick("narrator_name", "narrator", "name").alias("name"), pick("narrator_id").alias("nid"), pick("from", "from_narrator", "from_name").alias("a"), pick("to", "to_narrator", "to_name").alias("b"), pick("from_id").alias("aid"), pick("to_id").alias("bid"), pick("matn", "text", "hadith_text").alias("text"))
    hid = _id("mis", "mis", F.col("hadith"))
    w = Window.partitionBy("hadith", "sanad").orderBy(F.coalesce("pos", "row"), "row")
    seq = r.where("name is not null and hadith is not null and sanad is not null and a is null").select("hadith", "name", "nid", F.lead("name").over(w).alias("b"), F.lead("nid").over(w).alias("bid")).where("b is not null").select(F.col("name").alias("from_narrator_name"), F.col("b").alias("to_narrator_name"), hid.alias("hadith_id"), F.col("nid").alias("from_external_id"), F.col("bid").alias("to_external_id"))
    flat = r.where("a is not null and b is not null").select(F.col("a").alias("from_narrator_name"), F.col("b").alias("to_narrator_name"), hid.alias("hadith_id"), F.col("aid").alias("from_external_id"), F.col("bid").alias("to_external_id"))
    edges = seq.unionByName(flat).withColumn("source", F.lit("mis")).withColumn("relation", F.lit("TRANSMITTED_TO"))
    h = _hadiths(r.where("text is not null and hadith is not null").groupBy("hadith").agg(F.min_by("text", "row").alias("matn_ar")).withColumn("source_id", hid).withColumn("collection_name", F.lit("mis")).withColumn("hadith_number", S.safe_int(F.col("hadith"))), "mis", "sunni")
    return {"hadiths": h, "network_edges": conform(edges, "network_edges"), "collections": _collections(h, "mis", "sunni")}


# Verdicts on narrators, and words of the classes that tell a generation, in their order.
TRUST = {"reliable": "thiqa", "mostly_reliable": "saduq", "weak": "daif", "abandoned": "matruk", "fabricator": "kadhdhab", "companion": "thiqa", "unknown": "unknown"}
CLASSES = (("صحاب", "sahabi"), ("الأولى", "sahabi"), ("الثانية", "tabii"), ("الثالثة", "tabii"), ("الرابعة", "tabii"), ("الخامسة", "taba_tabii"), ("السادسة", "taba_tabii"), ("السابعة", "taba_tabii"), ("الثامنة", "taba_tabii"), ("التاسعة", "atba_taba_tabiin"), ("العاشرة", "atba_taba_tabiin"), ("الحادية", "later"), ("الثانية عشرة", "later"))


def profile_json(spark: SparkSession, path: str) -> Staged:
    """Keyed profiles of narrators: biographies, study relations told from either side once, and other spellings of the name."""
    f = "id string, full_name string, kunya string, nasab string, laqab string, death string, city string, tabaqat string, grade_en string, grade_ar string, teachers array<string>, students array<string>, namings array<string>"
    r = R.json_map(spark, path, f)
    clean = lambda c: F.nullif(S.safe_str(F.col(c)), F.lit("-"))
    r = r.withColumn("pid", F.coalesce(S.safe_str(F.col("id")), S.safe_str(F.col("_key")))).where("pid is not null").withColumn("_i", F.row_number().over(Window.partitionBy("pid").orderBy("_key"))).where("_i = 1")
    trust, generation = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, v in TRUST.items():
        trust = F.when(clean("grade_en") == k, v).otherwise(trust)
    for needle, g in reversed(CLASSES):
        generation = F.when(clean("tabaqat").contains(needle), g).otherwise(generation)
    name, died = clean("full_name"), S.parse_year(F.col("death"))
    bios = r.select(F.concat(F.lit("itqan:"), "pid").alias("bio_id"), F.lit("itqan").alias("source"), name.alias("name_ar"), A.normalize_arabic(name).alias("name_ar_normalized"), clean("kunya").alias("kunya"), clean("nasab").alias("nisba"), clean("laqab").alias("laqab"), F.lit("unknown").alias("birth_date_precision"), died["point"].alias("death_year_ah"), died["earliest"].alias("death_year_ah_earliest"), died["latest"].alias("death_year_ah_latest"), F.coalesce(died["precision"], F.lit("unknown")).alias("death_date_precision"), clean("city").alias("birth_location"), F.when(clean("grade_en") == "companion", "sahabi").otherwise(generation).alias("generation"), trust.alias("trustworthiness"), clean("grade_ar").alias("bio_text"), F.col("pid").alias("external_id"))
    pairs = r.select(F.col("pid").alias("s"), F.explode("teachers").alias("t")).unionByName(r.select(F.explode("students").alias("s"), F.col("pid").alias("t"))).where("trim(s) <> '' and trim(t) <> '' and s <> t").distinct()
    named = bios.select(F.col("external_id").alias("k"), F.col("name_ar").alias("n"))
    edges = pairs.join(named.select(F.col("k").alias("s"), F.col("n").alias("sn")), "s", "left").join(named.select(F.col("k").alias("t"), F.col("n").alias("tn")), "t", "left").select(F.coalesce("sn", "s").alias("from_narrator_name"), F.coalesce("tn", "t").alias("to_narrator_name"), F.lit("itqan").alias("source"), F.col("s").alias("from_external_id"), F.col("t").alias("to_external_id"), F.lit("STUDIED_UNDER").alias("relation"))
    aka = r.where(name.isNotNull()).select(F.concat(F.lit("itqan:"), "pid").alias("bio_id"), F.lit("itqan").alias("source"), A.normalize_arabic(name).alias("canonical_name_ar_normalized"), F.posexplode("namings").alias("i", "alias")).withColumn("alias", F.nullif(F.trim("alias"), F.lit("-"))).withColumn("alias_normalized", A.normalize_arabic(F.col("alias"))).where("alias_normalized <> '' and alias_normalized <> canonical_name_ar_normalized")
    aka = aka.withColumn("_i", F.row_number().over(Window.partitionBy("bio_id", "alias_normalized").orderBy("i"))).where("_i = 1")
    return {"narrators_bio": conform(bios, "narrators_bio"), "network_edges": conform(edges, "network_edges"), "narrator_aliases": conform(aka, "narrator_aliases")}


def list_csv(spark: SparkSession, path: str) -> Staged:
    """Narrators by id, and hadiths whose chains are lists of ids: biographies and edges between neighbours."""
    def pick(df: DataFrame, *names: str) -> Column:
        have = {c.lower().replace(" ", ""): c for c in df.columns}
        return S.safe_str(F.coalesce(*[F.col(f"`{have[n]}`") for n in names if n in have], F.lit(None).cast("string")))

    n, c = R.csv(spark, path, "*narrators*.csv"), R.csv(spark, path, "*hadiths*.csv")
    bios = n.select(pick(n, "id", "narrator_id").alias("external_id"), pick(n, "name", "displayname", "display_name", "fullname").alias("name_en"), pick(n, "arabicname", "arabic_name").alias("name_ar"), F.lower(pick(n, "gender")).alias("gender"), pick(n, "bio", "biography").alias("bio_text")).where("external_id is not null")
    bios = bios.withColumn("bio_id", F.concat(F.lit("muhaddithat:"), "external_id")).withColumn("source", F.lit("muhaddithat")).withColumn("name_ar_normalized", A.normalize_arabic(F.col("name_ar")))
    ids = F.filter(F.transform(F.split(pick(c, "narrator_ids", "narrators", "chain", "isnad"), ","), lambda t: F.trim(t)), lambda x: x != "")
    pairs = c.select(_id("muhaddithat", "muhaddithat", pick(c, "id", "hadith_id")).alias("hadith_id"), F.inline(Q.pairs_in_list(ids)))
    named = bios.select(F.col("external_id").alias("k"), F.coalesce("name_en", "name_ar").alias("n"))
    edges = pairs.join(named.select(F.col("k").alias("from_item"), F.col("n").alias("a")), "from_item", "left").join(named.select(F.col("k").alias("to_item"), F.col("n").alias("b")), "to_item", "left").select(F.coalesce("a", "from_item").alias("from_narrator_name"), F.coalesce("b", "to_item").alias("to_narrator_name"), "hadith_id", F.lit("muhaddithat").alias("source"), F.col("from_item").alias("from_external_id"), F.col("to_item").alias("to_external_id"), F.lit("TRANSMITTED_TO").alias("relation"))
    return {"narrators_bio": conform(bios, "narrators_bio"), "network_edges": conform(edges, "network_edges")}


ADAPTERS = {
    a.slug: a
    for a in (
        Adapter("lk", "lk", "sunni", bilingual_csv), Adapter("sanadset", "sanadset", "sunni", tagged_csv), Adapter("sunnah_api", "sunnah", "sunni", api_json), Adapter("sunnah_scraped", "sunnah", "sunni", scraped_json),
        Adapter("fawaz", "fawaz", "sunni", edition_pair), Adapter("thaqalayn", "thaqalayn", "shia", book_json), Adapter("tusi", "tusi", "shia", verse_json), Adapter("bihar", "bihar", "shia", html_volumes),
        Adapter("open_hadith", "open_hadith", "sunni", plain_csv("open_hadith"), active=False), Adapter("halimbahae", "halimbahae", "sunni", plain_csv("halimbahae")), Adapter("mis", "mis", "sunni", spreadsheet_pair),
        Adapter("itqan", "itqan", "mixed", profile_json), Adapter("muhaddithat", "muhaddithat", "mixed", list_csv),
    )
}


def parse_all(spark: SparkSession, raw_dir: str, slugs: list[str] | None = None) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """(table -> rows of all sources, source -> what went wrong). A source that fails, in analysis or as it runs, leaves no rows and stops no other; each is parsed once, into stored tables."""
    out: dict[str, DataFrame] = {}
    failed: dict[str, str] = {}
    for a in ADAPTERS.values():
        if not a.active or (slugs and a.slug not in slugs):
            continue
        try:
            got = {name: stored(df, f"parsed-{a.slug}") for name, df in a.parse(spark, f"{raw_dir}/{a.slug}").items()}
        except Exception as e:  # noqa: BLE001
            failed[a.slug] = str(e)[:200]
            continue
        for name, df in got.items():
            df = df.withColumn("_source", F.lit(a.slug))
            out[name] = out[name].unionByName(df) if name in out else df
    return out, failed


def enrich(hadiths: DataFrame, extra: DataFrame, columns: tuple[str, ...] = ("grade", "chapter_name_ar", "chapter_name_en")) -> DataFrame:
    """Nulls of hadiths filled from another edition with the same collection and number (its first row, if there are several)."""
    e = extra.where("hadith_number is not null").groupBy("collection_name", "hadith_number").agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("source_id"))).alias(f"_{c}") for c in columns])
    met = hadiths.join(e, ["collection_name", "hadith_number"], "left")
    return met.select(*[F.coalesce(c, f"_{c}").alias(c) if c in columns else F.col(c) for c in hadiths.columns])
