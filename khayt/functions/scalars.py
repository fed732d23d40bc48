"""Scalar rules of the data model: grades, dates, calendars, generations, traditions, identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from khayt.functions.arabic import is_arabic, normalize_arabic, strip_to_letters

# Known corpora, names that stand for one, and the traditions of those that have one.
CORPORA = ("lk", "sanadset", "thaqalayn", "sunnah", "fawaz", "open_hadith", "muhaddithat", "itqan", "halimbahae", "mis", "bihar", "tusi")
CORPUS_ALIASES = {"kaggle_narrators": "sanadset"}
SECT_BY_CORPUS = {"sunnah": "sunni", "open_hadith": "sunni", "lk": "sunni", "sanadset": "sunni", "thaqalayn": "shia"}
CROSS_TRADITION = ("muhaddithat",)
# Death windows of the generations, years of the Hijra.
GENERATIONS = {"sahabi": (11, 110), "tabii": (90, 180), "taba_tabii": (150, 250), "atba_taba_tabiin": (220, 300), "later": (280, 400)}
MARGIN, DEATH_MIN, DEATH_MAX = 50, 11, 450
# What a grade contains, in the order of the rules.
GRADES = (
    ("sahih_li_ghayrihi", ("صحيح لغيره", "sahih li ghayrihi", "sahih li-ghayrihi")),
    ("hasan_li_ghayrihi", ("حسن لغيره", "hasan li ghayrihi", "hasan li-ghayrihi")),
    ("mawdu", ("موضوع", "mawdu", "fabricat")),
    ("daif", ("ضعيف", "daif", "da'if", "weak")),
    ("sahih", ("صحيح", "sahih", "authentic")),
    ("hasan", ("حسن", "hasan", "good")),
)
# Collections that are kept of the corpora that are not kept whole; corpora without Hadith nodes have none.
COMPOSITION = {"halimbahae": ("musnad_ahmad_ibn-hanbal", "sunan_al-darimi", "maliks_muwataa"), "fawaz": ("nawawi", "dehlawi", "qudsi"), "mis": (), "open_hadith": ()}
DEDUP_CORPORA = ("sanadset",)
NAMESPACE = "a1b2c3d4e5f67890abcdef1234567890"
#: Epoch of the tabular Islamic calendar, in days from 1970-01-01.
HIJRA_EPOCH = -492148


def safe_str(c: Column) -> Column:
    """Trimmed; null for blank, "nan" and "none"."""
    t = F.trim(c.cast("string"))
    return F.when(~F.lower(t).isin("", "nan", "none"), t)


def safe_int(c: Column) -> Column:
    """Whole part of a number in text; null if it is none or too large."""
    return F.trim(c.cast("string")).try_cast("double").try_cast("int")


def normalize_grade(c: Column) -> Column:
    """A grade of the fixed list for any wording, Arabic or Latin; ``unknown`` for null and other words."""
    text = F.lower(normalize_arabic(c))
    out = F.lit("unknown")
    for grade, needles in reversed(GRADES):
        hit = F.lit(False)
        for n in needles:
            hit = hit | text.contains(n)
        out = F.when(hit, F.lit(grade)).otherwise(out)
    return out


def hijri_day(year: Column, month: Column | int = 1, day: Column | int = 1) -> Column:
    """Days from 1970-01-01 of a date of the tabular Islamic calendar."""
    m, d = (x if isinstance(x, Column) else F.lit(x) for x in (month, day))
    return (d - 1 + F.ceil(F.lit(29.5) * (m - 1)) + (year - 1) * 354 + F.floor((year * 11 + 3) / 30) + HIJRA_EPOCH).cast("int")


def hijri_date(year: Column, month: Column | int = 1, day: Column | int = 1) -> Column:
    return F.date_add(F.to_date(F.lit("1970-01-01")), hijri_day(year, month, day))


def is_hijri_leap(year: Column) -> Column:
    return (year * 11 + 14) % 30 < 11


def ah_to_ce(year: Column) -> Column:
    """The common year in which a year of the Hijra begins; null below 1."""
    return F.when(year >= 1, F.year(hijri_date(year)))


def ah_to_ce_end(year: Column) -> Column:
    """The common year in which it ends."""
    return F.when(year >= 1, F.year(F.date_add(hijri_date(year + 1), -1)))


def ce_to_ah(year: Column) -> Column:
    """The year of the Hijra on 1 January of a common year, at least 1."""
    day = F.unix_date(F.make_date(year, F.lit(1), F.lit(1)))
    return F.greatest(F.lit(1), F.floor((F.lit(30) * (day - HIJRA_EPOCH) + 10646) / 10631).cast("int"))


def parse_year(c: Column) -> Column:
    """struct(point, earliest, latest, precision) of a date's wording (years of the Hijra); null if it names no year from 1 to 1500.

    A range, "after", "before", "about", one year, or several years, in this order.
    """
    text = F.trim(F.translate(c.cast("string"), "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "01234567890123456789"))

    def year(x: Column) -> Column:
        n = F.when(x != "", x).try_cast("int")
        return F.when(n.between(1, 1500), n)

    years = F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)"), 1), lambda x: year(x)), lambda x: x.isNotNull())
    spoken = r"^\s*(?:بين|between)\s*(\d+)\D*?(?:إلى|الى|الي|و|to|-|–|—)\s*(\d+)"
    dashed = r"^\s*(\d+)\s*[-–—]\s*(\d+)\s*$"
    a = F.coalesce(year(F.regexp_extract(text, spoken, 1)), year(F.regexp_extract(text, dashed, 1)))
    b = F.coalesce(year(F.regexp_extract(text, spoken, 2)), year(F.regexp_extract(text, dashed, 2)))
    after, before = year(F.regexp_extract(text, r"^\s*(?:بعد|after)\s*(\d+)", 1)), year(F.regexp_extract(text, r"^\s*(?:قبل|before)\s*(\d+)", 1))
    circa = text.rlike(r"تقريبا|نحو|حوالي|قرابة|زهاء|circa|\bca?\.|~|approx")
    first, low, high, none = F.get(years, F.lit(0)), F.array_min(years), F.array_max(years), F.lit(None).cast("int")

    def made(point: Column, lo: Column, hi: Column, precision: str) -> Column:
        return F.struct(point.alias("point"), lo.alias("earliest"), hi.alias("latest"), F.lit(precision).alias("precision"))

    out = (
        F.when(a.isNotNull() & b.isNotNull(), made(a, F.least(a, b), F.greatest(a, b), "range"))
        .when(after.isNotNull(), made(after, after, none, "after"))
        .when(before.isNotNull(), made(before, none, before, "before"))
        .when(circa, made(first, first, first, "circa"))
        .when(low == high, made(first, first, first, "exact"))
        .otherwise(made(first, low, high, "range"))
    )
    return F.when((F.size(years) > 0) & ~text.isin("", "-", "—", "–", "?"), out)


def plausible_death(year: Column, generation: Column) -> Column:
    """Whether a death year can be a narrator's: within the whole span, and within the generation's window and a margin if it is known."""
    ok = year.between(DEATH_MIN, DEATH_MAX)
    for name, (lo, hi) in GENERATIONS.items():
        ok = ok & ((generation != name) | year.between(lo - MARGIN, hi + MARGIN) | generation.isNull())
    return ok


def clamp_death(year: Column) -> Column:
    return F.greatest(F.lit(DEATH_MIN), F.least(F.lit(DEATH_MAX), year))


def generation_window(generation: Column) -> Column:
    """struct(earliest, latest, point) of a known generation, else null."""
    out = F.lit(None).cast("struct<earliest:int,latest:int,point:int>")
    for name, (lo, hi) in GENERATIONS.items():
        out = F.when(generation == name, F.struct(F.lit(lo).alias("earliest"), F.lit(hi).alias("latest"), F.lit((lo + hi) // 2).alias("point"))).otherwise(out)
    return out


def normalize_corpus(c: Column) -> Column:
    out = c
    for alias, name in CORPUS_ALIASES.items():
        out = F.when(out == alias, F.lit(name)).otherwise(out)
    return F.when(out.isin(*CORPORA), out)


def primary_corpus(corpora: Column) -> Column:
    return F.array_min(F.filter(corpora, lambda x: x.isNotNull() & (x != "")))


def sect_affiliation(corpora: Column) -> Column:
    """Tradition of a narrator from all corpora it is seen in; corpora across traditions count for both."""
    seen = F.transform(F.coalesce(corpora, F.array().cast("array<string>")), normalize_corpus)
    both = F.exists(seen, lambda x: F.coalesce(x.isin(*CROSS_TRADITION), F.lit(False)))

    def has(sect: str) -> Column:
        return both | F.exists(seen, lambda x: F.coalesce(x.isin(*[c for c, s in SECT_BY_CORPUS.items() if s == sect]), F.lit(False)))

    return F.when(has("sunni") & has("shia"), "neutral").when(has("sunni"), "sunni").when(has("shia"), "shia").otherwise("unknown")


def attestation(mention_count: Column) -> Column:
    return F.when(mention_count > 0, "isnad_attested").otherwise("biographical_only")


def in_composition(corpus: Column, collection: Column) -> Column:
    """Whether a collection of a corpus belongs to the composed graph."""
    out = F.lit(True)
    for name, kept in COMPOSITION.items():
        out = F.when(corpus == name, F.coalesce(collection.isin(*kept), F.lit(False)) if kept else F.lit(False)).otherwise(out)
    return out


def in_composition_by_id(hadith_id: Column) -> Column:
    parts = F.split(F.regexp_replace(hadith_id, "^hdt:", ""), ":")
    return in_composition(F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit("")))


def is_doubled(source_id: Column) -> Column:
    parts = F.split(F.regexp_replace(source_id, "^hdt:", ""), ":")
    return F.coalesce((F.get(parts, F.lit(0)) == F.get(parts, F.lit(1))) & F.get(parts, F.lit(0)).isin(*CORPORA), F.lit(False))


def with_prefix(c: Column, prefix: str) -> Column:
    return F.when(c.startswith(prefix), c).otherwise(F.concat(F.lit(prefix), c))


def matn_identity(matn_ar: Column, matn_en: Column) -> Column:
    """Digest of the letters of a text, for finding it in another edition; null below three words."""
    text = F.when(is_arabic(matn_ar), strip_to_letters(normalize_arabic(matn_ar))).when(F.trim(matn_en) != "", strip_to_letters(F.lower(matn_en)))
    return F.when(F.size(F.split(text, " ")) >= 3, F.sha2(text, 256))


def uuid5(name: Column, namespace: str = NAMESPACE) -> Column:
    """Version 5 UUID of a name, as text."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 8))
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12)
    )


def canonical_id(surface: Column, discriminator: Column | None = None) -> Column:
    """Narrator id minted from the identifying spelling of a name, and from a discriminator where same-named persons are told apart."""
    key = surface if discriminator is None else F.when(F.coalesce(discriminator, F.lit("")) == "", surface).otherwise(F.concat(surface, F.lit("\x1f"), discriminator))
    return F.concat(F.lit("nar:"), uuid5(key))


def variant_type(score: Column) -> Column:
    return F.when(score >= 0.90, "verbatim").when(score >= 0.80, "close_paraphrase").otherwise("thematic")


def cross_sect(a: Column, b: Column) -> Column:
    return F.coalesce((a != "") & (b != "") & (a != b), F.lit(False))
