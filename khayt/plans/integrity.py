"""p2_* and p6_*: orphan references and per-key results under skew, over the whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from khayt.operators.references import orphan_references, parent_states
from khayt.operators.skew import eager_join_aggregate, heavy_keys, member_profile
from khayt.runtime import table

#: child table, its record, the field that refers, the key it refers to, parent table, its key
REFERENCES = (
    ("mentions_resolved", "mention_id", "hadith_id", F.col, "hadiths", "source_id"),
    ("mentions_resolved", "mention_id", "canonical_narrator_id", F.col, "narrators_canonical", "canonical_id"),
    ("hadiths", "source_id", "collection_name", lambda c: F.concat("source_corpus", F.lit(":"), F.col(c)), "collections", "collection_id"),
)
HEAVY_ONE_IN = 40


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = table(spark, sf_dir, "deletions")
    found = []
    for child, record, field, key, parent, parent_key in REFERENCES:
        named = gone.where(F.col("table_name") == parent).select(F.col("record_key").alias("key"), "deleted_at")
        states = parent_states(table(spark, sf_dir, parent), F.col(parent_key), F.col("loaded_at"), named)
        rows = orphan_references(table(spark, sf_dir, child), F.col(record), key(field), F.col("loaded_at"), states)
        found.append(rows.select(F.lit(child).alias("table_name"), F.lit(field).alias("field_name"), "record_id", "missing_key", "period", "state"))
    return reduce(DataFrame.unionByName, found)


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records refer to a key that is not there, per table, field, month and state."""
    return p2_found(spark, sf_dir).groupBy("table_name", "field_name", "period", "state").agg(F.count(F.lit(1)).alias("records"), F.countDistinct("missing_key").alias("keys"))


def _narrators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per narrator, from the eager join of mentions and hadiths."""
    return member_profile(table(spark, sf_dir, "mentions_resolved"), "canonical_narrator_id", "hadith_id", "confidence", table(spark, sf_dir, "hadiths"), "source_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy_keys(_narrators(spark, sf_dir), "canonical_narrator_id", HEAVY_ONE_IN).select("canonical_narrator_id")


def p6_narrators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per narrator: mentions as delivered, distinct hadiths, mean confidence."""
    got = _narrators(spark, sf_dir).where(F.col("canonical_narrator_id").isNotNull())
    return got.select("canonical_narrator_id", "rows", F.col("members").alias("hadiths"), F.round(F.try_divide("total", "valued"), 4).alias("mean_confidence"))


def p6_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per narrator: mentions as delivered, and those whose hadith was delivered."""
    return _narrators(spark, sf_dir).where(F.col("canonical_narrator_id").isNotNull()).select("canonical_narrator_id", "rows", "on_record")


def p6_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per narrator and collection: joined rows of mentions and hadiths as delivered, and the confidence summed over them."""
    got = eager_join_aggregate(
        table(spark, sf_dir, "mentions_resolved").where(F.col("canonical_narrator_id").isNotNull()), table(spark, sf_dir, "hadiths"), [("hadith_id", "source_id")],
        by_left=["canonical_narrator_id"], by_right=["collection_name"], left_sums={"confidence": F.col("confidence").cast("double")},
    )
    return got.select("canonical_narrator_id", "collection_name", "rows", F.round("sum_confidence", 3).alias("confidence"))


_GONE = """gone_{n} as (select c.k from (select {pk} k, max(loaded_at) last_at from {p} group by 1) c
 join (select record_key k, max(deleted_at) gone_at from deletions where table_name = '{p}' group by 1) d on c.k = d.k where c.last_at <= d.gone_at),
first_{n} as (select {pk} k, min(loaded_at) first_at from {p} group by 1),
refs_{n} as (select {r} as record_id, {key} as k, loaded_at as ref_at from {c} where {key} is not null)"""
_FOUND = """select distinct '{c}' as table_name, '{f}' as field_name, record_id, r.k as missing_key, strftime(ref_at, '%Y-%m') as period,
 case when first_at is null then 'missing' when g.k is not null then 'deleted' else 'late' end as state
from refs_{n} r left join first_{n} f on r.k = f.k left join gone_{n} g on r.k = g.k where first_at is null or g.k is not null or first_at > ref_at"""
_PARTS = [
    {"n": 0, "c": "mentions_resolved", "r": "mention_id", "f": "hadith_id", "key": "hadith_id", "p": "hadiths", "pk": "source_id"},
    {"n": 1, "c": "mentions_resolved", "r": "mention_id", "f": "canonical_narrator_id", "key": "canonical_narrator_id", "p": "narrators_canonical", "pk": "canonical_id"},
    {"n": 2, "c": "hadiths", "r": "source_id", "f": "collection_name", "key": "(source_corpus || ':' || collection_name)", "p": "collections", "pk": "collection_id"},
]
_P2 = "with " + ",\n".join(_GONE.format(**x) for x in _PARTS) + ",\nfound as (" + "\nunion all\n".join(_FOUND.format(**x) for x in _PARTS) + ")\n"

QUERIES = {"p2_found": p2_found, "p2_report": p2_report, "p6_found": p6_found, "p6_narrators": p6_narrators, "p6_delivered": p6_delivered, "p6_books": p6_books}
SQL = {
    "p2_found": _P2 + "select * from found",
    "p2_report": _P2 + "select table_name, field_name, period, state, count(*) as records, count(distinct missing_key) as keys from found group by all",
    "p6_found": "select canonical_narrator_id from mentions_resolved where canonical_narrator_id is not null group by 1 having count(*) * 40 >= (select count(*) from mentions_resolved)",
    "p6_narrators": """select canonical_narrator_id, count(*) as rows, count(distinct hadith_id) as hadiths, round(avg(confidence::double), 4) as mean_confidence
 from mentions_resolved where canonical_narrator_id is not null group by 1""",
    "p6_delivered": """select canonical_narrator_id, count(*) as rows, count(*) filter (hadith_id in (select source_id from hadiths where source_id is not null)) as on_record
 from mentions_resolved where canonical_narrator_id is not null group by 1""",
    "p6_books": """select canonical_narrator_id, collection_name, count(*) as rows, round(sum(confidence::double), 3) as confidence
 from mentions_resolved join hadiths on hadith_id = source_id where canonical_narrator_id is not null group by 1, 2""",
}
