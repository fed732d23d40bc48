"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from khayt.functions import arabic as A
from khayt.functions import scalars as S
from khayt.runtime import table


def c_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "mentions_resolved").select("name_raw").distinct()
    return names.select("name_raw", A.normalize_arabic(F.col("name_raw")).alias("normalized"), A.strip_to_letters(F.col("name_raw")).alias("letters"), A.is_arabic(F.col("name_raw")).alias("arabic"))


def c_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The identifying spelling of each narrator name and the id minted from it."""
    names = table(spark, sf_dir, "narrators_canonical").where("name_ar is not null").select("name_ar").distinct()
    return names.withColumn("surface", A.canonical_surface(F.col("name_ar"))).select("name_ar", "surface", S.canonical_id(F.col("surface")).alias("minted_id"))


def c_transliterate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "narrators_canonical").select("name_ar").distinct().select("name_ar", A.transliterate(F.col("name_ar")).alias("latin"))


def c_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hadiths whose Arabic chain holds a term of transmission, per corpus."""
    h = table(spark, sf_dir, "hadiths").where("isnad_raw_ar is not null")
    return h.groupBy("source_corpus").agg(F.count_if(A.has_transmission_term(F.col("isnad_raw_ar"))).alias("with_term"), F.count(F.lit(1)).alias("chains"))


def c_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gradings, each of a JSON list for itself, in one vocabulary."""
    g = F.coalesce(F.from_json("grade", "array<string>"), F.array("grade"))
    rows = table(spark, sf_dir, "hadiths").select("source_id", F.explode(g).alias("raw"))
    return rows.select("source_id", "raw", S.normalize_grade(F.col("raw")).alias("grade"))


def c_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Common years of the death years on record."""
    y = table(spark, sf_dir, "narrators_canonical").where("death_year_ah between 1 and 1500").select("death_year_ah").distinct()
    d = F.col("death_year_ah")
    return y.select("death_year_ah", S.ah_to_ce(d).alias("ce_start"), S.ah_to_ce_end(d).alias("ce_end"), S.ce_to_ah(S.ah_to_ce_end(d)).alias("back"))


def c_year_notation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates put into words and read again: their point, bounds and precision."""
    c = table(spark, sf_dir, "narrators_canonical").select("death_year_ah", "birth_year_ah").distinct()
    d, b = F.col("death_year_ah").cast("string"), F.col("birth_year_ah").cast("string")
    words = c.select(F.explode(F.array(d, F.concat(F.lit("after "), d), F.concat(F.lit("before "), d), F.concat(F.lit("circa "), d), F.concat(b, F.lit("-"), d), F.concat(b, F.lit(" or "), d))).alias("said"))
    return words.where("said is not null").distinct().withColumn("p", S.parse_year(F.col("said"))).select("said", F.col("p.point").alias("point"), F.col("p.earliest").alias("earliest"), F.col("p.latest").alias("latest"), F.col("p.precision").alias("precision"))


def c_sects(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "narrators_canonical").select("source_corpora", "mention_count").distinct()
    k = F.array_join(F.array_sort("source_corpora"), ",")
    return c.select(k.alias("corpora"), S.sect_affiliation(F.col("source_corpora")).alias("sect"), S.primary_corpus(F.col("source_corpora")).alias("main"), S.attestation(F.col("mention_count")).alias("attestation")).distinct()


def c_plausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Death years that cannot be a narrator's, by generation."""
    c = table(spark, sf_dir, "narrators_canonical").where("death_year_ah is not null").withColumn("generation", F.lower(F.trim("generation")))
    ok = S.plausible_death(F.col("death_year_ah"), F.col("generation"))
    return c.groupBy("generation").agg(F.count_if(ok).alias("plausible"), F.count_if(~ok).alias("not_plausible"), F.sum(S.clamp_death(F.col("death_year_ah"))).alias("clamped"))


def c_compose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept and left out by the composition, and ids with a doubled corpus, per corpus."""
    h = table(spark, sf_dir, "hadiths").dropDuplicates(["source_id"])
    keep = S.in_composition(F.col("source_corpus"), F.col("collection_name"))
    return h.groupBy("source_corpus").agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("left_out"), F.count_if(S.is_doubled(F.col("source_id"))).alias("doubled"))


def c_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and numbers in text made safe."""
    h = table(spark, sf_dir, "hadiths").select("grade", F.concat(F.col("book_number"), F.lit(".0")).alias("book")).distinct()
    return h.select("grade", "book", S.safe_str(F.col("grade")).alias("grade_safe"), S.safe_int(F.col("book")).alias("book_safe"))


_N = A.sql_normalize
_YEARS = "list_filter(list_transform(regexp_extract_all(s, '[0-9]+'), lambda x: try_cast(x as integer)), lambda x: x between 1 and 1500)"
_SECT = "list_contains(source_corpora, 'muhaddithat') or "
_SUNNI = "(" + _SECT + "list_has_any(source_corpora, ['sunnah', 'open_hadith', 'lk', 'sanadset', 'kaggle_narrators']))"
_SHIA = "(" + _SECT + "list_contains(source_corpora, 'thaqalayn'))"
_SURFACE = f"""with n as (select distinct name_ar, list_filter(string_split(translate({_N('name_ar')}, 'ىء', 'ي'), ' '), lambda t: t <> '') ts from narrators_canonical where name_ar is not null),
s as (select name_ar, array_to_string(list_transform(ts, lambda t: case when t in ('ابا', 'ابي') then 'ابو' when starts_with(t, 'عبدال') and length(t) > 5 then 'عبد ' || t[4:]
 when ends_with(t, 'ا') and t[:length(t) - 1] in ({', '.join(f"'{x}'" for x in A.ACCUSATIVE)}) then t[:length(t) - 1] else t end), ' ') surface from n),
h as (select *, sha1(unhex('{S.NAMESPACE}') || encode(surface)) h from s)
select name_ar, surface, 'nar:' || h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab', ((('0x' || h[17:17])::int) % 4 + 1)::int, 1) || h[18:20] || '-' || h[21:32] as minted_id from h"""
_DAY = "((y - 1) * 354 + floor((y * 11 + 3) / 30.0)::int + (-492148))"
QUERIES = {f.__name__: f for f in (c_normalize, c_surface, c_transliterate, c_terms, c_grade, c_calendar, c_year_notation, c_sects, c_plausible, c_compose, c_fields)}
SQL = {
    "c_normalize": f"select distinct name_raw, {_N('name_raw')} as normalized, trim(regexp_replace(name_raw, '[^\\p{{L}}]+', ' ', 'g')) as letters, regexp_matches(name_raw, '[\\x{{0600}}-\\x{{06FF}}]') as arabic from mentions_resolved",
    "c_surface": _SURFACE,
    "c_grade": f"""with r as (select source_id, unnest(case when starts_with(grade, '[') then from_json(grade, '["varchar"]') else [grade] end) raw from hadiths),
t as (select *, lower({_N('raw')}) t from r)
select source_id, raw, case {' '.join('when ' + ' or '.join(f"contains(t, '{n.replace(chr(39), chr(39) * 2)}')" for n in needles) + f" then '{g}'" for g, needles in S.GRADES)} else 'unknown' end as grade from t""",
    "c_terms": f"""select source_corpus, count(*) filter (where regexp_matches(' ' || {_N('isnad_raw_ar')} || ' ', '[^\\x{{0621}}-\\x{{063A}}\\x{{0640}}-\\x{{065F}}\\x{{0670}}-\\x{{06D3}}]({'|'.join(t.translate(str.maketrans('أإ', 'اا')) for t in A.TRANSMISSION)})[^\\x{{0621}}-\\x{{063A}}\\x{{0640}}-\\x{{065F}}\\x{{0670}}-\\x{{06D3}}]')) as with_term,
 count(*) as chains from hadiths where isnad_raw_ar is not null group by 1""",
    "c_calendar": f"""with d as (select distinct death_year_ah y from narrators_canonical where death_year_ah between 1 and 1500),
e as (select y, year(date '1970-01-01' + {_DAY}) a, year(date '1970-01-01' + ({_DAY.replace('y', '(y + 1)')} - 1)) b from d)
select y as death_year_ah, a as ce_start, b as ce_end, greatest(1, floor((30 * ((make_date(b, 1, 1) - date '1970-01-01') + 492148) + 10646) / 10631.0))::int as back from e""",
    "c_year_notation": f"""with w as (select distinct unnest([d, 'after ' || d, 'before ' || d, 'circa ' || d, b || '-' || d, b || ' or ' || d]) s from (select distinct death_year_ah::varchar d, birth_year_ah::varchar b from narrators_canonical)),
y as (select s, {_YEARS} ys, try_cast(regexp_extract(s, '^\\s*(\\d+)\\s*-\\s*(\\d+)\\s*$', 1) as int) a, try_cast(regexp_extract(s, '^\\s*(\\d+)\\s*-\\s*(\\d+)\\s*$', 2) as int) b,
 try_cast(regexp_extract(s, '^after\\s*(\\d+)', 1) as int) f, try_cast(regexp_extract(s, '^before\\s*(\\d+)', 1) as int) e from w where s is not null),
k as (select *, case when len(ys) = 0 then null when a between 1 and 1500 and b between 1 and 1500 then 'span' when f between 1 and 1500 then 'after' when e between 1 and 1500 then 'before' when contains(s, 'circa') then 'circa' when list_min(ys) = list_max(ys) then 'exact' else 'range' end k from y)
select s as said, case k when 'span' then a when 'after' then f when 'before' then e else case when k is not null then ys[1] end end as point,
 case k when 'span' then least(a, b) when 'after' then f when 'before' then null when 'range' then list_min(ys) else case when k is not null then ys[1] end end as earliest,
 case k when 'span' then greatest(a, b) when 'after' then null when 'before' then e when 'range' then list_max(ys) else case when k is not null then ys[1] end end as latest,
 case k when 'span' then 'range' else k end as precision from k""",
    "c_sects": f"""select distinct array_to_string(list_sort(source_corpora), ',') as corpora, case when {_SUNNI} and {_SHIA} then 'neutral' when {_SUNNI} then 'sunni' when {_SHIA} then 'shia' else 'unknown' end as sect,
 list_min(list_filter(source_corpora, lambda x: x is not null and x <> '')) as main, case when mention_count > 0 then 'isnad_attested' else 'biographical_only' end as attestation from narrators_canonical""",
    "c_plausible": f"""with c as (select lower(trim(generation)) generation, death_year_ah y from narrators_canonical where death_year_ah is not null),
p as (select *, y between 11 and 450 and coalesce(case generation {' '.join(f"when '{g}' then y between {a - 50} and {b + 50}" for g, (a, b) in S.GENERATIONS.items())} end, true) ok from c)
select generation, count(*) filter (where ok) as plausible, count(*) filter (where not ok) as not_plausible, sum(greatest(11, least(450, y)))::bigint as clamped from p group by 1""",
    "c_compose": f"""with h as (select distinct source_id, source_corpus, first(collection_name) over (partition by source_id) c from hadiths),
k as (select source_corpus, source_id, case source_corpus {' '.join(f"when '{g}' then " + (f"c in {v}" if v else "false") for g, v in S.COMPOSITION.items())} else true end keep from h)
select source_corpus, count(*) filter (where keep) as kept, count(*) filter (where not keep) as left_out,
 count(*) filter (where split_part(source_id, ':', 1) = split_part(source_id, ':', 2) and split_part(source_id, ':', 1) in {S.CORPORA}) as doubled from k group by 1""",
    "c_fields": """select distinct grade, (book_number || '.0') as book, case when lower(trim(grade)) not in ('', 'nan', 'none') then trim(grade) end as grade_safe, trunc(try_cast(book_number || '.0' as double))::int as book_safe from hadiths""",
}
