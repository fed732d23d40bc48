"""p1_*, p3_* to p5_*, p7_* to p10_*: the queries of this package and their SQL, over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from khayt.llm import bpe, components, lookalike, markup, names, packing, repetition, survivor
from khayt.runtime import stored, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = components.narrator_links(table(spark, sf_dir, "narrators_canonical"), table(spark, sf_dir, "narrator_matches"), table(spark, sf_dir, "mentions_resolved"))
    return components.connected(links).select(F.col("id").alias("canonical_id"), "group_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivor.narrator_survivors(table(spark, sf_dir, "narrators_canonical"))


MARKED_FIELDS = ("full_text_ar", "matn_en")


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "hadiths").select("source_id", F.inline(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in MARKED_FIELDS])))
    return rows.where(F.col("source_id").isNotNull() & F.col("text").isNotNull())


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _marked(spark, sf_dir).where(F.col("text").rlike(markup.MAY_HOLD))
    return markup.read_markup(rows, "text", ["source_id", "field_name"], want=False).where("found").select("source_id", "field_name").distinct()


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of the two fields without its markup, and that of its content regions."""
    return markup.read_markup(_marked(spark, sf_dir), "text", ["source_id", "field_name"]).select("source_id", "field_name", "clean", "content")


#: table, record, field of the texts that p5 brings to one form
PLAIN_FIELDS = (("hadiths", "source_id", "matn_ar"), ("hadiths", "source_id", "isnad_raw_ar"), ("mentions_resolved", "mention_id", "name_raw"))


def _plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = [
        table(spark, sf_dir, t).select(F.lit(t).alias("table_name"), F.col(record).alias("record_id"), F.lit(field).alias("field_name"), F.col(field).alias("text"))
        for t, record, field in PLAIN_FIELDS
    ]
    return lookalike.plain_text(reduce(DataFrame.unionByName, texts).where(F.col("text").isNotNull()), "text", ["table_name", "record_id", "field_name"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(spark, sf_dir).where("odd").select("table_name", "record_id", "field_name").where(F.col("record_id").isNotNull()).distinct()


def p5_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one consistent form of every value."""
    return _plain(spark, sf_dir).select("table_name", "record_id", "field_name", "plain", "odd")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    mentions = table(spark, sf_dir, "mentions_resolved").select("mention_id", "name_raw", "canonical_narrator_id").where(F.col("mention_id").isNotNull())
    meant = mentions.where(F.col("canonical_narrator_id").isNotNull()).select("mention_id")
    open_ = mentions.where(F.col("canonical_narrator_id").isNull()).select("mention_id", "name_raw").dropna().distinct().join(meant, "mention_id", "left_anti")
    canonical = table(spark, sf_dir, "narrators_canonical")
    said = canonical.select("canonical_id", F.explode(F.concat(F.array("name_ar", "name_en"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name")).dropna().distinct()
    spelt = lookalike.plain_text(open_, "name_raw", ["mention_id"]).select(F.col("mention_id").alias("id"), F.col("plain").alias("name"))
    persons = lookalike.plain_text(said, "name", ["canonical_id"]).select(F.col("canonical_id").alias("person"), F.col("plain").alias("name"))
    got = names.same_person(stored(spelt, "spelt"), persons)
    return got.select(F.col("id").alias("mention_id"), F.col("person").alias("canonical_id"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text, or piece of a text longer than a container, with its container of 4,096 tokens; chains of transmission are context and bear no loss."""
    return packing.pack_texts(table(spark, sf_dir, "documents"), "doc_id", "text", F.col("kind") == "isnad")


def p9_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many texts the containers hold, and how many pieces or containers break a rule."""
    return packing.packing_facts(stored(p9_packed(spark, sf_dir), "placed"), "doc_id")


def _cleaned(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    return repetition.repetition(table(spark, sf_dir, "documents"), "doc_id", "text", clean=clean)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that line-first cleaning rejects, of which the share lost to repetition alone is checked."""
    return _cleaned(spark, sf_dir).where("rejected").where(F.col("share") >= repetition.REJECT_SHARE).select("doc_id")


def p10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and repeated words of every document."""
    return _cleaned(spark, sf_dir).select("doc_id", "words", "repeated", F.round("share", 6).alias("share"))


def p10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, lines that fail, words lost with what fails and whether the document is rejected for it, of every document."""
    return _cleaned(spark, sf_dir).select("doc_id", "lines", "failed_lines", "lost", "rejected")


def p10_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line-first cleaning leaves of every document."""
    return _cleaned(spark, sf_dir, clean=True).select("doc_id", "rejected", "kept")


QUERIES = {
    "p1_found": p1_found, "p3_found": p3_found, "p4_found": p4_found, "p4_clean": p4_clean, "p5_found": p5_found, "p5_plain": p5_plain, "p7_found": p7_found, "p8_ids": p8_ids, "p9_packed": p9_packed, "p9_facts": p9_facts, "p10_found": p10_found, "p10_shares": p10_shares,
    "p10_lines": p10_lines, "p10_cleaned": p10_cleaned,
}

_P10 = r"""with w as (select doc_id, regexp_extract_all(regexp_replace(lower(coalesce(text, '')), '\p{M}', '', 'g'), '\p{L}+') ws from documents),
g as (select doc_id, i, row_number() over (partition by doc_id, array_to_string(ws[i:i + 4], ' ') order by i) > 1 again
 from (select doc_id, ws, unnest(range(1, len(ws) - 3)) i from w)),
m as (select doc_id, count(distinct i + k) repeated from g, range(5) r(k) where again group by 1),
s as (select w.doc_id, len(ws)::bigint as words, coalesce(repeated, 0) as repeated, case when len(ws) = 0 then 0.0 else coalesce(repeated, 0)::double / len(ws) end as share from w left join m using (doc_id))
"""

_ENDS, _GONE = r"[\n\r\x0b\x0c\x{85}\x{2028}\x{2029}]", r"\x00-\x20\x{85}\x{a0}\x{2028}\x{2029}"
_P10_LINES = rf"""with t as (select doc_id, string_split_regex(regexp_replace(coalesce(text, ''), '([{repetition.STOPS}][\t \x{{a0}}])', '\1' || chr(10), 'g'), '{_ENDS}') ls from documents),
l as (select doc_id, n, ls[n] line, regexp_extract_all(regexp_replace(lower(ls[n]), '\p{{M}}', '', 'g'), '\p{{L}}+') ws from (select doc_id, ls, unnest(range(1, len(ls) + 1)) n from t)),
c as (select doc_id, n, ws, coalesce(sum(len(ws)) over (partition by doc_id order by n rows between unbounded preceding and 1 preceding), 0)::bigint before,
 length(regexp_replace(line, '[{_GONE}]', '', 'g')) shown, length(regexp_replace(line, '[{_GONE}\p{{L}}\p{{M}}\p{{N}}]', '', 'g')) signs, length(regexp_replace(line, '[^{repetition.SEPARATORS}]', '', 'g')) bars from l),
d as (select doc_id, flatten(list(ws order by n)) ws from l group by 1),
g as (select doc_id, i, row_number() over (partition by doc_id, array_to_string(ws[i:i + 4], ' ') order by i) > 1 again from (select doc_id, ws, unnest(range(1, len(ws) - 3)) i from d)),
m as (select distinct doc_id, i + k p from g, range(5) r(k) where again),
a as (select c.doc_id, n, count(*) again from c join m on c.doc_id = m.doc_id and p > before and p <= before + len(ws) group by 1, 2),
f as (select c.doc_id, len(ws) said, coalesce(again, 0) again, shown > 0 as is_line, shown > 0 and (len(ws) = 0 or signs > 0.5 * shown or (bars >= 2 and len(ws) <= 3 * (bars + 1))
 or regexp_matches(' ' || array_to_string(ws, ' ') || ' ', ' ({"|".join(repetition.BOILERPLATE)}) ') or again = len(ws)) as fails from c left join a on c.doc_id = a.doc_id and c.n = a.n),
s as (select doc_id, count(*) filter (is_line) as lines, count(*) filter (is_line and coalesce(fails, false)) as failed_lines,
 sum(case when coalesce(fails, false) then said else again end)::bigint as lost, sum(said) words from f group by 1)
select doc_id, lines, failed_lines, lost, words > 0 and lost >= 0.25 * words as rejected from s"""

SQL = {
    "p1_found": """with recursive known as (select distinct canonical_id id from narrators_canonical),
m as (select case when left_id like 'nar:%' then left_id else 'nar:' || left_id end a, case when right_id like 'nar:%' then right_id else 'nar:' || right_id end b
 from narrator_matches where lower(decision) = 'accepted'),
e as (select distinct canonical_id id, lower(trim(x)) e from (select canonical_id, unnest(source_ids) x from narrators_canonical) where lower(trim(x)) not in ('', 'n/a', 'unknown')),
t as (select distinct mention_id, canonical_narrator_id id from mentions_resolved where canonical_narrator_id is not null),
hub as (select a.id a, b.m b from e a join (select e, min(id) m from e group by 1) b using (e) union select a.id, b.m from t a join (select mention_id, min(id) m from t group by 1) b using (mention_id)),
l as (select a, b from m union select b, a from m union select a, b from hub union select b, a from hub),
links as materialized (select a, b from l where a <> b and a in (select id from known) and b in (select id from known)),
reach as (select a, a r from (select distinct a from links) union select l.b, c.r from reach c join links l on c.a = l.a)
select a as canonical_id, min(r) as group_id from reach group by 1""",
    "p3_found": """with c as (select canonical_id, loaded_at, case when death_year_ah between 1 and 1500 then death_year_ah end y,
 nullif(nullif(lower(trim(death_year_provenance)), ''), 'unknown') p, nullif(nullif(lower(trim(generation)), ''), 'unknown') g, nullif(nullif(lower(trim(gender)), ''), 'unknown') s from narrators_canonical),
k as (select canonical_id from c group by 1 having count(*) >= 2),
y as (select * from c where y is not null qualify row_number() over (partition by canonical_id order by case p when 'corroborated' then 2 when 'uncorroborated' then 1 else 0 end desc, loaded_at desc, y desc, p desc nulls last) = 1),
g as (select * from c where g is not null qualify row_number() over (partition by canonical_id order by loaded_at desc, g desc) = 1),
s as (select * from c where s is not null qualify row_number() over (partition by canonical_id order by loaded_at desc, s desc) = 1)
select canonical_id, field_name, field_value from (select canonical_id, 'death_year_ah' as field_name, y::varchar as field_value from y
 union all select canonical_id, 'death_year_provenance', p from y where p is not null union all select canonical_id, 'generation', g from g
 union all select canonical_id, 'gender', s from s) where canonical_id in (select canonical_id from k)""",
    "p10_found": _P10 + "select doc_id from s where words > 0 and share >= 0.25",
    "p9_facts": """select 'texts placed' as fact, count(*) as value from documents
union all select unnest(['split though they fit', 'beyond capacity', 'beyond segments', 'beyond loss', 'use misstated']), 0""",
    "p10_lines": _P10_LINES,
    "p10_shares": _P10 + "select doc_id, words, repeated, round(share, 6) as share from s",
}
