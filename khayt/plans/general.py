"""Checks of tables, chains cut from texts, general SQL, and streams."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from khayt.functions import scalars as S
from khayt.functions.names import clean_name_udf
from khayt.functions.segment import segment_ar, split_udf
from khayt.operators import quality as K
from khayt.operators import sequence as Q
from khayt.runtime import shared_dir, table
from khayt.streaming import flows

CHECKED = ("hadiths", "mentions_resolved", "narrators_canonical", "collections", "deletions", "narrator_matches")


def k_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [K.null_shares(table(spark, sf_dir, t), t) for t in CHECKED])


def k_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = K.table_checks(table(spark, sf_dir, "hadiths"), "hadiths", "source_id", ["matn_ar"], ["matn_ar", "matn_en"], ["book_number", "chapter_number", "hadith_number"])
    n = K.table_checks(table(spark, sf_dir, "narrators_canonical"), "narrators_canonical", "canonical_id", ["name_ar"])
    return h.unionByName(n).unionByName(K.table_checks(table(spark, sf_dir, "mentions_resolved"), "mentions_resolved", "mention_id"))


def k_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.out_of_domain(table(spark, sf_dir, "narrators_canonical"), {"gender": ("male", "female", "unknown"), "generation": (*S.GENERATIONS, "unknown"), "attestation": ("isnad_attested", "biographical_only", "unknown")})


def k_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per corpus now against those of the first half of the deliveries."""
    h = table(spark, sf_dir, "hadiths")
    now = h.groupBy(F.col("source_corpus").alias("metric")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    base = h.where("loaded_at < timestamp_ntz'2024-07-01'").groupBy(F.col("source_corpus").alias("metric")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return K.drift(now, base)


def k_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.provenance_violations(table(spark, sf_dir, "hadiths"), ("source_id", "source_corpus", "collection_name", "sect"), S.CORPORA)


def s_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrators cut from the Arabic chains of hadiths, cleaned."""
    h = table(spark, sf_dir, "hadiths").where("isnad_raw_ar is not null").select("source_id", "isnad_raw_ar").distinct()
    return h.select("source_id", F.inline(segment_ar("isnad_raw_ar"))).select("source_id", "position", "method", clean_name_udf("name").alias("name"))


def s_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains found before their texts in the full Arabic."""
    h = table(spark, sf_dir, "hadiths").where("full_text_ar is not null").select("source_id", "full_text_ar").distinct()
    return h.withColumn("x", split_udf("full_text_ar")).where("x.chain is not null").select("source_id", "x.chain", "x.text", "x.convention")


def w_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bursts of a user's events: a new band after a pause of more than six hours."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.unix_timestamp("ts").alias("at"))
    b = Q.bands(e, ["user_id"], "at", ["event_id"], 21600)
    return b.groupBy("user_id", "band").agg(F.count(F.lit(1)).alias("events"))


def w_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of hadiths in books that have none, for the corpus whose order is reliable."""
    h = table(spark, sf_dir, "hadiths").where("source_corpus = 'sunnah'").groupBy("source_id", "collection_name", "book_number").agg(F.max("hadith_number").alias("hadith_number"))
    return Q.ordinals(h, ["collection_name", "book_number"], ["source_id"], "hadith_number", F.lit(True))


def w_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the type of the nearest one before and after of the same user."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return Q.neighbours(e, ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "previous", "following")


def j_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrators of one generation whose lives overlap by interval with another's: counts per narrator."""
    n = table(spark, sf_dir, "narrators_canonical").where("birth_year_ah between 1 and 1500 and death_year_ah between birth_year_ah and birth_year_ah + 120").groupBy("canonical_id").agg(F.min("birth_year_ah").alias("b"), F.max("death_year_ah").alias("d")).where("d >= b")
    spans = n.groupBy("b", "d").agg(F.count(F.lit(1)).alias("n"))
    met = Q.overlaps(spans.select(F.col("b").alias("b1"), F.col("d").alias("d1")), spans.select(F.col("b").alias("b2"), F.col("d").alias("d2"), "n"), ("b1", "d1"), ("b2", "d2"))
    return met.groupBy("b1", "d1").agg(F.sum("n").alias("contemporaries"))


SQL_TEXTS = {
    "q_bucket": """select case when l_quantity < 10 then 'small' when l_quantity < 30 then 'middle' else 'large' end as size, count(*) as lines, round(sum(l_extendedprice), 2) as price from lineitem group by 1""",
    "q_pricing": """select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, round(avg(l_discount), 6) as avg_disc, count(*) as n from lineitem where l_shipdate <= timestamp '1998-09-02 00:00:00' group by l_returnflag, l_linestatus""",
    "q_rollup": """select coalesce(r_name, 'all') as region, coalesce(n_name, 'all') as nation, count(*) as customers, round(sum(c_acctbal), 2) as balance from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by rollup (r_name, n_name)""",
    "q_cube": """select coalesce(l_returnflag, '*') as flag, coalesce(l_linestatus, '*') as status, count(*) as n from lineitem group by cube (l_returnflag, l_linestatus)""",
    "q_sets": """select coalesce(o_orderstatus, '*') as status, coalesce(o_orderpriority, '*') as priority, count(*) as n from orders group by grouping sets ((o_orderstatus), (o_orderpriority), ())""",
    "q_windows": """select o_orderkey, row_number() over w as place, rank() over (partition by o_custkey order by o_orderdate) as rnk, lag(o_orderkey) over w as before, round(sum(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey rows between 2 preceding and current row), 2) as moving from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)""",
    "q_top": """select c_custkey, total from (select o_custkey as c_custkey, round(sum(o_totalprice), 2) as total from orders group by o_custkey) order by total desc, c_custkey limit 20""",
    "q_intersect": """select n_nationkey from nation where n_nationkey in (select c_nationkey from customer) intersect select s_nationkey from supplier""",
    "q_except": """select c_custkey from customer except select o_custkey from orders""",
    "q_semi": """select c_custkey, c_name from customer c where exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_totalprice > 400000)""",
    "q_anti": """select p_partkey from part p where not exists (select 1 from lineitem l where l.l_partkey = p.p_partkey)""",
    "q_asof": """select event_id, order_key from (select e.event_id, o.o_orderkey as order_key, row_number() over (partition by e.event_id order by o.o_orderdate desc, o.o_orderkey desc) as i from (select event_id, user_id, ts from events) e left join orders o on o.o_custkey = e.user_id and o.o_orderdate <= e.ts) where i = 1""",
    "q_subquery": """select s_suppkey, s_name from supplier where s_acctbal > (select avg(s_acctbal) from supplier)""",
    "q_lateral": """select n_name, c_custkey, round(c_acctbal, 2) as balance from nation, lateral (select c_custkey, c_acctbal from customer where c_nationkey = n_nationkey order by c_acctbal desc, c_custkey limit 3) t""",
    "q_natural": """select n_name, r_name from (select n_name, n_regionkey as regionkey from nation) natural join (select r_name, r_regionkey as regionkey from region)""",
    "q_cross": """select r_name, segment, customers from region cross join (select c_mktsegment as segment, count(*) as customers from customer group by 1)""",
    "q_having": """select event_type, count(*) as n, count(distinct user_id) as users, round(avg(value), 4) as mean_value, max(event_id) as last_id from events where value is not null group by event_type having count(*) > 1""",
}
NEEDS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _sql(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = SQL_TEXTS[name]
        for t in NEEDS:
            if t in text:
                table(spark, sf_dir, t).createOrReplaceTempView(t)
        return spark.sql(text)

    run.__name__ = name
    return run


#: Files in which the streaming queries find the events, one read at each trigger.
EVENT_FILES = 3


def _land(spark: SparkSession, rows: DataFrame, folder: str, files: int = EVENT_FILES) -> None:
    rows.repartition(files, "event_id").write.mode("append").parquet(f"{folder}/in")


def _stream(spark: SparkSession, sf_dir: str, make, mode: str = "append", keys: Sequence[str] = ()) -> DataFrame:
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    _land(spark, table(spark, sf_dir, "events"), folder)
    return flows.drain(spark, make(flows.events(spark, f"{folder}/in", "*.parquet")), folder, mode, keys)


def t_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by hour and type as a stream that keeps every window."""
    got = _stream(spark, sf_dir, lambda s: flows.tumbling(s, late="3650 days"), "complete")
    return got.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events", F.round("total", 4).alias("total"))


def t_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by hour and type, where half of them arrive after the others: rows of windows that the watermark has passed fall out."""
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "events")
    for part in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 != 0):
        _land(spark, rows.where(part), folder, 1)
        got = flows.drain(spark, flows.tumbling(flows.events(spark, f"{folder}/in", "*.parquet")), folder, "update", ["window_start", "event_type"])
    return got.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events")


def t_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a user's events without a pause of more than half an hour."""
    got = _stream(spark, sf_dir, lambda s: flows.sessions(s, late="3650 days"), "complete")
    return got.select("user_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")], "events")


def t_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users, each at the first of their events that arrives."""
    return _stream(spark, sf_dir, lambda s: flows.first_seen(s, "user_id", "3650 days")).select("user_id")


def t_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream(spark, sf_dir, lambda s: flows.sliding(s, late="3650 days"), "complete").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "events")


def t_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals per user, from kept state."""
    return _stream(spark, sf_dir, flows.running_totals, "update", ["user_id"]).select("user_id", "events", F.round("total", 4).alias("total"))


QUERIES = {f.__name__: f for f in (k_nulls, k_checks, k_domains, k_drift, k_provenance, s_segments, s_split, w_bands, w_ordinals, w_neighbours, j_interval, t_tumbling, t_late, t_sessions, t_first_seen, t_sliding, t_totals)} | {n: _sql(n) for n in SQL_TEXTS}
_AR = "regexp_matches({}, '[\\x{{0600}}-\\x{{06FF}}]')"
SQL = {
    **SQL_TEXTS,
    "k_checks": f"""select 'hadiths' as table_name, unnest(['duplicate_ids', 'arabic_pct_matn_ar', 'empty_matn_ar', 'empty_matn_en', 'coverage_pct_book_number', 'coverage_pct_chapter_number', 'coverage_pct_hadith_number']) as "check",
 unnest([(count(*) - count(distinct source_id))::double, round(100.0::double * count(*) filter (where {_AR.format('matn_ar')}) / count(matn_ar), 2), (count(*) filter (where coalesce(trim(matn_ar, ' \\t\\n\\r') = '', true)))::double, (count(*) filter (where coalesce(trim(matn_en, ' \\t\\n\\r') = '', true)))::double,
 round(100.0::double * count(book_number) / count(*), 2), round(100.0::double * count(chapter_number) / count(*), 2), round(100.0::double * count(hadith_number) / count(*), 2)]) as value from hadiths
 union all select 'narrators_canonical', unnest(['duplicate_ids', 'arabic_pct_name_ar']), unnest([(count(*) - count(distinct canonical_id))::double, round(100.0::double * count(*) filter (where {_AR.format('name_ar')}) / count(name_ar), 2)]) from narrators_canonical
 union all select 'mentions_resolved', 'duplicate_ids', (count(*) - count(distinct mention_id))::double from mentions_resolved""",
    "k_domains": f"""select 'gender' as column_name, gender as value, count(*) as rows from narrators_canonical where gender not in ('male', 'female', 'unknown') group by 2
 union all select 'generation', generation, count(*) from narrators_canonical where generation not in {(*S.GENERATIONS, 'unknown')} group by 2 union all select 'attestation', attestation, count(*) from narrators_canonical where attestation not in ('isnad_attested', 'biographical_only', 'unknown') group by 2""",
    "k_drift": """with n as (select source_corpus metric, count(*)::double as value, (count(*) filter (where loaded_at < timestamp '2024-07-01'))::double baseline from hadiths group by 1)
select metric, baseline, value, round(100.0 * abs(value - baseline) / baseline, 2) as drift_pct, round(100.0 * abs(value - baseline) / baseline, 2) <= 30 as within from n where baseline > 0""",
    "k_provenance": f"""select unnest(['null_source_id', 'null_source_corpus', 'null_collection_name', 'null_sect', 'unknown_corpus']) as violation, unnest([count(*) filter (where coalesce(trim(source_id), '') = ''), count(*) filter (where coalesce(trim(source_corpus), '') = ''),
 count(*) filter (where coalesce(trim(collection_name), '') = ''), count(*) filter (where coalesce(trim(sect), '') = ''), count(*) filter (where source_corpus not in {S.CORPORA})]) as rows from hadiths""",
    "w_bands": """with e as (select user_id, event_id, epoch(date_trunc('second', ts))::bigint a from events), o as (select *, case when a - lag(a) over (partition by user_id order by a, event_id) > 21600 then 1 else 0 end op from e)
select user_id, band::int as band, count(*) as events from (select user_id, sum(op) over (partition by user_id order by a, event_id) band from o) group by all""",
    "w_ordinals": """with h as (select source_id, collection_name, book_number, max(hadith_number) n from hadiths where source_corpus = 'sunnah' group by all)
select source_id, collection_name, book_number, case when max(n) over (partition by collection_name, book_number) is null then row_number() over (partition by collection_name, book_number order by source_id)::int else n end as hadith_number from h""",
    "w_neighbours": """with e as (select event_id, event_type, lag(event_type ignore nulls) over w p, lead(event_type ignore nulls) over w f from events window w as (partition by user_id order by ts, event_id))
select event_id, nullif(p, event_type) as previous, nullif(f, event_type) as following from e""",
    "j_interval": """with n as (select canonical_id, min(birth_year_ah) b, max(death_year_ah) d from narrators_canonical where birth_year_ah between 1 and 1500 and death_year_ah between birth_year_ah and birth_year_ah + 120 group by 1),
s as (select b, d, count(*) n from n where d >= b group by all) select x.b as b1, x.d as d1, sum(y.n)::bigint as contemporaries from s x join s y on x.b <= y.d and y.b <= x.d group by all""",
    "t_tumbling": "select date_trunc('hour', ts) as window_start, event_type, count(*) as events, round(sum(value), 4) as total from events group by all",
    "t_sliding": "select w as window_start, count(*) as events from (select unnest([date_trunc('hour', ts), date_trunc('hour', ts) - interval 1 hour]) w from events) group by 1",
    "t_late": """with e as (select *, event_id % 2 = 0 as early from events), w as (select max(ts) - interval 10 minutes passed from e where early)
select date_trunc('hour', ts) as window_start, event_type, count(*) as events from e, w where early or date_trunc('hour', ts) + interval 1 hour > passed group by all""",
    "t_sessions": """with e as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) > interval 30 minutes then 1 else 0 end opens from events),
s as (select *, sum(opens) over (partition by user_id order by ts) n from e) select user_id, min(ts) as session_start, max(ts) + interval 30 minutes as session_end, count(*) as events from s group by user_id, n""",
    "t_first_seen": "select distinct user_id from events",
    "t_totals": "select user_id, count(*) as events, round(sum(coalesce(value, 0)), 4) as total from events group by 1",
}
#: Columns of the checked tables, for the comparison query.
COLUMNS = {
    "hadiths": "source_id source_corpus collection_name book_number chapter_number hadith_number matn_ar matn_en isnad_raw_ar isnad_raw_en full_text_ar full_text_en grade chapter_name_ar chapter_name_en sect loaded_at",
    "mentions_resolved": "mention_id hadith_id source_corpus position_in_chain chain_index name_raw name_normalized canonical_narrator_id transmission_method confidence loaded_at",
    "narrators_canonical": "canonical_id name_ar name_en name_ar_normalized aliases birth_year_ah death_year_ah birth_year_ah_earliest birth_year_ah_latest birth_date_precision death_year_ah_earliest death_year_ah_latest death_date_precision generation gender trustworthiness source_ids external_id death_year_provenance mention_count attestation source_corpus source_corpora sect_affiliation over_merged over_merge_note loaded_at",
    "collections": "collection_id name_ar name_en compiler_name compilation_year_ah sect total_hadiths expected_count source_corpus loaded_at",
    "deletions": "table_name record_key deleted_at",
    "narrator_matches": "match_id left_id right_id score stage decision matched_at",
}
SQL["k_nulls"] = "\nunion all ".join(
    f"select '{t}' as table_name, unnest({c.split()}) as column_name, count(*) as rows, unnest([{', '.join(f'round(100.0::double * (count(*) - count({x})) / count(*), 2)' for x in c.split())}]) as null_pct from {t}" for t, c in COLUMNS.items()
)
