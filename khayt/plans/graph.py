"""The graph of hadiths, narrators and collections: nodes, edges, checks and measures."""

from __future__ import annotations

from collections.abc import Callable


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from khayt.functions import arabic as A
from khayt.functions import scalars as S
from khayt.operators import graph as G
from khayt.operators import sequence as Q
from khayt.runtime import one_row, stored, table

#: Periods that the overlay relates narrators to.
PERIODS = (("evt:1", "first century", 1, 100), ("evt:2", "second civil strife", 60, 73), ("evt:3", "change of dynasty", 129, 132), ("evt:4", "inquisition", 218, 234), ("evt:5", "compilers", 200, 310), ("evt:6", "later age", 300, 450))


class Tables:
    """Nodes and mentions of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, keep: bool = False) -> None:
        """keep: tables that several results of one query read are stored once."""
        self.spark, self.dir, self.keep, self.made = spark, sf_dir, keep, {}

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if not self.keep:
            return make()
        if name not in self.made:
            self.made[name] = stored(make(), name)
        return self.made[name]

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.dir, name)

    def hadiths(self) -> DataFrame:
        return self._once("hadiths", lambda: G.hadith_nodes(self.raw("hadiths")))

    def narrators(self) -> DataFrame:
        return self._once("narrators", lambda: G.narrator_nodes(self.raw("narrators_canonical")))

    def collections(self) -> DataFrame:
        return G.collection_nodes(self.raw("collections"))

    def mentions(self) -> DataFrame:
        return self._once("mentions", lambda: G.surviving_mentions(self.raw("mentions_resolved"), self.hadiths()))

    def transmitted(self) -> DataFrame:
        return self._once("transmitted", lambda: G.transmitted_to(self.mentions(), self.narrators()))

    def narrated(self) -> DataFrame:
        return self._once("narrated", lambda: G.narrated(self.mentions(), self.narrators()))

    def appears(self) -> DataFrame:
        return self._once("appears", lambda: G.appears_in(self.hadiths(), self.collections()))


def g_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why hadiths are kept or left out, per corpus."""
    return G.hadith_outcomes(table(spark, sf_dir, "hadiths")).groupBy("source_corpus", "outcome").agg(F.count(F.lit(1)).alias("rows"))


def g_hadiths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).hadiths().select("id", "source_corpus", "collection_name", "book_number", "chapter_number", "hadith_number", "sect", "grade", "grade_normalized")


def g_narrators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).narrators()


def g_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).collections()


def g_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = G.chain_nodes(Tables(spark, sf_dir).mentions())
    return c.select("id", "hadith_id", F.array_join("narrator_ids", " ").alias("narrators"), "chain_length")


def g_gradings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.grading_nodes(table(spark, sf_dir, "hadiths"))


def g_transmitted_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).transmitted()


def g_narrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).narrated()


def g_appears_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).appears().drop("source_corpus")


def g_missing_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrators that chains lead to and that are not on record, with the edges lost."""
    t = Tables(spark, sf_dir, keep=True)
    pairs = Q.consecutive_pairs(t.mentions(), ["hadith_id", "chain_index"], ["position_in_chain", "mention_id"], "canonical_narrator_id", ["position_in_chain"])
    edges = pairs.select(F.col("from_item").alias("from_id"), F.col("to_item").alias("to_id"), F.col("position_in_chain").alias("position"), "hadith_id").distinct()
    return G.missing_endpoints(stored(edges, "edges"), t.narrators(), t.narrators())


def g_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrators with the periods they lived in; a life has at most 120 years."""
    n = Tables(spark, sf_dir).narrators().where("birth_year_ah between 1 and 1500 and death_year_ah between birth_year_ah and birth_year_ah + 120")
    p = spark.createDataFrame(PERIODS, "event_id string, event_name string, start_ah int, end_ah int")
    return Q.overlaps(n.select("id", "birth_year_ah", "death_year_ah"), p, ("birth_year_ah", "death_year_ah"), ("start_ah", "end_ah")).select("id", "event_id", "birth_year_ah", "death_year_ah")


def v1_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Self-loops and pairs of narrators that transmit in both directions."""
    e = stored(Tables(spark, sf_dir).transmitted().select("from_id", "to_id").distinct(), "pairs")
    back = e.select(F.col("from_id").alias("to_id"), F.col("to_id").alias("from_id"))
    both = e.where("from_id < to_id").join(back, ["from_id", "to_id"], "left_semi").agg(F.count(F.lit(1)).alias("reciprocal_pairs"))
    return one_row(e.agg(F.count_if(F.expr("from_id = to_id")).alias("self_loops")), both)


def v2_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hadiths of each collection against what was expected."""
    t = Tables(spark, sf_dir)
    n = t.appears().groupBy(F.col("to_id").alias("id")).agg(F.count(F.lit(1)).alias("actual"))
    c = t.collections().join(n, "id", "left").select("id", "expected_count", F.coalesce("actual", F.lit(0)).alias("actual"))
    off = F.try_divide(F.abs(F.col("actual") - F.col("expected_count")) * 100.0, F.col("expected_count"))
    return c.select(F.col("id").alias("collection_id"), F.col("expected_count").alias("expected"), "actual", F.round(off.cast("double"), 6).alias("deviation_pct"))


def v3_orphans(spark: SparkSession, sf_dir: str, known: Tables | None = None) -> DataFrame:
    """Narrators without any edge, those known from biographies only left out."""
    t = known or Tables(spark, sf_dir, keep=True)
    e = t.transmitted()
    ends = e.select(F.col("from_id").alias("id")).unionByName(e.select(F.col("to_id").alias("id"))).unionByName(t.narrated().select(F.col("from_id").alias("id")))
    return t.narrators().where("coalesce(attestation, '') <> 'biographical_only'").join(ends, "id", "left_anti").select(F.col("id").alias("narrator_id"), F.col("name_en").alias("name"))


def v4_dangling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hadiths named by mentions that have no node."""
    m = table(spark, sf_dir, "mentions_resolved").where("hadith_id <> ''").select(S.with_prefix(F.col("hadith_id"), "hdt:").alias("id")).distinct()
    return m.join(Tables(spark, sf_dir).hadiths(), "id", "left_anti").select(F.col("id").alias("hadith_id"))


def v5_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per corpus: edges to collections, those without a number in their book, hadiths without a first narrator, orphan narrators."""
    t = Tables(spark, sf_dir, keep=True)
    h = t.hadiths()
    a = t.appears().groupBy(F.col("source_corpus").alias("source")).agg(F.count(F.lit(1)).alias("appears_in_edges"), F.count_if(F.expr("hadith_number_in_book is null")).alias("null_in_book_ordinal"))
    w = h.join(t.narrated().select(F.col("to_id").alias("id")), "id", "left_anti").groupBy(F.col("source_corpus").alias("source")).agg(F.count(F.lit(1)).alias("hadiths_without_narrated"))
    o = v3_orphans(spark, sf_dir, t).join(t.narrators().select(F.col("id").alias("narrator_id"), "source_corpus"), "narrator_id").groupBy(F.coalesce("source_corpus", F.lit("unknown")).alias("source")).agg(F.count(F.lit(1)).alias("orphan_narrators"))
    out = a.join(w, "source", "full").join(o, "source", "full")
    return out.select("source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("appears_in_edges", "null_in_book_ordinal", "hadiths_without_narrated", "orphan_narrators")])


def v5_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).collections().where("name_ar is null or trim(name_ar) = '' or expected_count is null").select(F.col("id").alias("collection_id"), "name_en", "name_ar", "expected_count", F.col("source_corpus").alias("source"))


def v6_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hadiths, their edges to collections, and collections, per corpus."""
    t = Tables(spark, sf_dir, keep=True)
    h = t.hadiths().groupBy(F.col("source_corpus").alias("source")).agg(F.count(F.lit(1)).alias("hadiths"))
    a = t.appears().groupBy(F.col("source_corpus").alias("source")).agg(F.count(F.lit(1)).alias("appears_in_edges"))
    c = t.collections().groupBy(F.col("source_corpus").alias("source")).agg(F.count(F.lit(1)).alias("collections"))
    j = h.join(a, "source", "full").join(c, "source", "full")
    n = {x: F.coalesce(x, F.lit(0)) for x in ("hadiths", "appears_in_edges", "collections")}
    return j.select("source", *[v.alias(k) for k, v in n.items()], (n["hadiths"] - n["appears_in_edges"]).alias("orphan_hadiths"))


def v6_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First narrators all of whose hadiths are of one corpus, and edges that start at them."""
    t = Tables(spark, sf_dir, keep=True)
    per = t.narrated().join(t.hadiths().select(F.col("id").alias("to_id"), "source_corpus"), "to_id").groupBy("from_id").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.expr("source_corpus = 'sanadset'")).alias("own"))
    only = per.where("all = own").select("from_id")
    return one_row(only.agg(F.count(F.lit(1)).alias("exclusive_narrators")), t.transmitted().join(only, "from_id", "left_semi").agg(F.count(F.lit(1)).alias("edges_from_them")))


def v7_reciprocal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrators by how many others they both taught and studied with; the first 200."""
    e = stored(Tables(spark, sf_dir).transmitted().select("from_id", "to_id").distinct(), "pairs")
    back = e.select(F.col("from_id").alias("to_id"), F.col("to_id").alias("from_id"))
    n = e.join(back, ["from_id", "to_id"], "left_semi").groupBy(F.col("from_id").alias("narrator_id")).agg(F.countDistinct("to_id").alias("partners"))
    return n.orderBy(F.desc("partners"), "narrator_id").limit(200)


def g_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.degrees(Tables(spark, sf_dir).transmitted())


def g_pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return G.pagerank(t.narrators(), stored(t.transmitted().select("from_id", "to_id"), "edges")).select("id", F.round("rank", 6).alias("rank"))


def g_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.components(Tables(spark, sf_dir).transmitted())


def g_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.communities(stored(Tables(spark, sf_dir).transmitted().select("from_id", "to_id"), "edges"))


def g_betweenness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From every source."""
    t = Tables(spark, sf_dir)
    return G.betweenness(t.narrators(), stored(t.transmitted().select("from_id", "to_id"), "edges")).select("id", F.round("score", 4).alias("score"))


def g_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrators of the first deliveries, with those of the later ones merged in."""
    c = table(spark, sf_dir, "narrators_canonical")
    cut = F.lit("2024-01-01").cast("timestamp_ntz")
    old, new = (G.narrator_nodes(c.where(x)).select("id", "name_ar", "name_en", "death_year_ah", "gender") for x in (F.col("loaded_at") < cut, F.col("loaded_at") >= cut))
    return G.upsert(old, new, ["id"])


def g_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between narrators that have not been deleted."""
    t = Tables(spark, sf_dir, keep=True)
    n = stored(t.narrators().select("id"), "nodes")
    gone = t.raw("deletions").where("table_name = 'narrators_canonical'").select(F.col("record_key").alias("id"))
    return G.prune(n, n.join(gone, "id", "left_anti"), t.transmitted())[1].groupBy("from_id").agg(F.count(F.lit(1)).alias("edges"))


def _latest(name: str, key: str, cols: tuple[str, ...], where: str = "true") -> str:
    order = ", ".join(f"{c} desc nulls last" for c in ("loaded_at", *cols))
    return f"(select * from {name} where {where} qualify row_number() over (partition by {key} order by {order}) = 1)"


def _pre(x: str, p: str) -> str:
    return f"case when starts_with({x}, '{p}') then {x} else '{p}' || {x} end"


_COMPOSED = "case source_corpus " + " ".join(f"when '{k}' then " + (f"collection_name in {v}" if v else "false") for k, v in S.COMPOSITION.items()) + " else true end"
_TEXT = "case when trim(matn_ar) <> '' then matn_ar else coalesce(full_text_ar, '') end"
_LETTERS = "trim(regexp_replace({x}, '[^\\p{{L}}]+', ' ', 'g'))"
_BASE = f"""with recursive lh as {_latest('hadiths', 'source_id', G.HADITH_COLUMNS)},
ih as (select *, {_COMPOSED} composed, case when regexp_matches({_TEXT}, '[\\x{{0600}}-\\x{{06FF}}]') then {_LETTERS.format(x=A.sql_normalize(_TEXT))} when trim(matn_en) <> '' then {_LETTERS.format(x='lower(matn_en)')} end words from lh),
jh as (select *, case when len(string_split(words, ' ')) >= 3 then words end ident from ih),
oh as (select *, case when not composed then 'noncanonical' when source_corpus = 'sanadset' and ident in (select ident from jh where source_corpus <> 'sanadset' and composed and ident is not null) then 'cross_edition_dedup'
 when split_part(source_id, ':', 1) = split_part(source_id, ':', 2) and split_part(source_id, ':', 1) in {S.CORPORA} then 'malformed' else 'keep' end outcome from jh),
h as (select 'hdt:' || source_id as id, * from oh where outcome = 'keep'),
n as (select {_pre('canonical_id', 'nar:')} as id, * from {_latest('narrators_canonical', 'canonical_id', ("name_ar", "name_en", "generation", "gender", "birth_year_ah", "death_year_ah", "mention_count", "attestation", "source_corpus"))}),
c as (select {_pre('collection_id', 'col:')} as id, * from {_latest('collections', 'collection_id', ("name_ar", "name_en", "compiler_name", "compilation_year_ah", "sect", "total_hadiths", "expected_count", "source_corpus"))}),
m as (select mention_id, {_pre('canonical_narrator_id', 'nar:')} nid, {_pre('hadith_id', 'hdt:')} hid, coalesce(chain_index, 0) chain, position_in_chain pos
 from {_latest('mentions_resolved', 'mention_id', G.MENTION_COLUMNS)} where {_pre('hadith_id', 'hdt:')} in (select id from h)),
p as (select distinct nid from_id, nxt to_id, pos as position, hid as hadith_id from (select *, lead(nid) over (partition by hid, chain order by pos, mention_id) nxt from m where nid is not null) where nxt <> nid),
t as (select * from p where from_id in (select id from n) and to_id in (select id from n)),
r as (select distinct nid from_id, hid to_id from (select * from m where nid is not null qualify row_number() over (partition by hid, chain order by pos, mention_id) = 1) where nid in (select id from n)),
a as (select id from_id, 'col:' || source_corpus || ':' || collection_name to_id, book_number, chapter_number, hadith_number as hadith_number_in_book, source_corpus from h where 'col:' || source_corpus || ':' || collection_name in (select id from c))
"""
_GRADE = f"case {' '.join('when ' + ' or '.join(f'''contains(lower({A.sql_normalize('grade')}), '{n.replace(chr(39), chr(39) * 2)}')''' for n in needles) + f''' then '{g}' ''' for g, needles in S.GRADES)} else 'unknown' end"
_ORPHAN = "(select id, name_en, source_corpus from n where coalesce(attestation, '') <> 'biographical_only' and id not in (select from_id from t union select to_id from t union select from_id from r))"

QUERIES = {f.__name__: f for f in (g_outcomes, g_hadiths, g_narrators, g_collections, g_chains, g_gradings, g_transmitted_to, g_narrated, g_appears_in, g_missing_ends, g_overlay, g_degrees, g_pagerank, g_components, g_communities, g_betweenness, g_upsert, g_prune,
    v1_cycles, v2_coverage, v3_orphans, v4_dangling, v5_inventory, v5_collections, v6_sources, v6_exclusive, v7_reciprocal)}
_UP = ", ".join(f"coalesce(b.{x}, a.{x}) as {x}" for x in ("name_ar", "name_en", "death_year_ah", "gender"))
_NCOLS = ("name_ar", "name_en", "generation", "gender", "birth_year_ah", "death_year_ah", "mention_count", "attestation", "source_corpus")
SQL = {
    "g_outcomes": _BASE + "select source_corpus, outcome, count(*) as rows from oh group by all",
    "g_hadiths": _BASE + f"select id, source_corpus, collection_name, book_number, chapter_number, hadith_number, sect, grade, {_GRADE} as grade_normalized from h",
    "g_narrators": _BASE + "select id, name_ar, name_en, generation, gender, birth_year_ah, death_year_ah, mention_count, attestation, source_corpus from n",
    "g_collections": _BASE + "select id, name_ar, name_en, compiler_name, compilation_year_ah, sect, total_hadiths, expected_count, source_corpus from c",
    "g_chains": _BASE + "select 'chn:' || hid[5:] || '-' || chain as id, hid as hadith_id, string_agg(nid, ' ' order by pos, mention_id) as narrators, count(*)::int as chain_length from m where nid is not null group by hid, chain",
    "g_gradings": _BASE + f"select 'grd:' || id[5:] as id, id as hadith_id, grade, {_GRADE} as grade_normalized from h where trim(grade) <> ''",
    "g_transmitted_to": _BASE + "select * from t",
    "g_narrated": _BASE + "select * from r",
    "g_appears_in": _BASE + "select from_id, to_id, book_number, chapter_number, hadith_number_in_book from a",
    "g_missing_ends": _BASE + "select 'from' as side, from_id as id, count(*) as edges from p where from_id not in (select id from n) group by 2 union all select 'to', to_id, count(*) from p where to_id not in (select id from n) group by 2",
    "g_overlay": _BASE + f"select id, e as event_id, birth_year_ah, death_year_ah from n join (values {', '.join(f'''('{e}', {a}, {b})''' for e, _, a, b in PERIODS)}) v(e, a, b) on birth_year_ah <= b and death_year_ah >= a where birth_year_ah between 1 and 1500 and death_year_ah between birth_year_ah and birth_year_ah + 120",
    "g_degrees": _BASE + "select id, sum(i)::bigint as in_degree, sum(o)::bigint as out_degree from (select from_id id, 0 i, 1 o from t union all select to_id, 1, 0 from t) group by 1",
    "g_components": _BASE + ", l as materialized (select distinct from_id a, to_id b from t union select distinct to_id, from_id from t), reach as (select a, a r from (select distinct a from l) union select l.b, reach.r from reach join l on reach.a = l.a) select a as id, min(r) as component from reach group by 1",
    "g_pagerank": _BASE + """, o as (select from_id, count(*) n from t group by 1), fl as materialized (select t.from_id, t.to_id, count(*)::double / any_value(o.n) w from t join o on t.from_id = o.from_id group by all),
pr(i, id, rank) as (select 0, id, 0.15::double from n union all (with cur as (select * from pr), g as (select fl.to_id, sum(cur.rank * fl.w) s from cur join fl on fl.from_id = cur.id group by 1)
 select cur.i + 1, cur.id, 0.15 + 0.85 * coalesce(g.s, 0) from cur left join g on g.to_id = cur.id where cur.i < 20)) select id, round(rank, 6) as rank from pr where i = 20""",
    "g_upsert": f"""with a as (select canonical_id id, * from {_latest('narrators_canonical', 'canonical_id', _NCOLS, "loaded_at < timestamp '2024-01-01'")}), b as (select canonical_id id, * from {_latest('narrators_canonical', 'canonical_id', _NCOLS, "loaded_at >= timestamp '2024-01-01'")})
 select coalesce(a.id, b.id) as id, {_UP}, case when a.id is null then 'created' when b.id is not null then 'merged' else 'kept' end as merge from a full join b on a.id = b.id""",
    "g_prune": _BASE + ", k as (select id from n where id not in (select record_key from deletions where table_name = 'narrators_canonical')) select from_id, count(*) as edges from t where from_id in (select id from k) and to_id in (select id from k) group by 1",
    "v1_cycles": _BASE + ", d as (select distinct from_id, to_id from t) select (select count(*) from d where from_id = to_id) as self_loops, (select count(*) from d x where from_id < to_id and exists (select 1 from d y where y.from_id = x.to_id and y.to_id = x.from_id)) as reciprocal_pairs",
    "v2_coverage": _BASE + "select c.id as collection_id, expected_count as expected, coalesce(k, 0) as actual, round(abs(coalesce(k, 0) - expected_count) * 100.0::double / nullif(expected_count, 0), 6) as deviation_pct from c left join (select to_id, count(*) k from a group by 1) x on c.id = x.to_id",
    "v3_orphans": _BASE + f"select id as narrator_id, name_en as name from {_ORPHAN}",
    "v4_dangling": _BASE + f"select distinct {_pre('hadith_id', 'hdt:')} as hadith_id from mentions_resolved where hadith_id <> '' and {_pre('hadith_id', 'hdt:')} not in (select id from h)",
    "v5_inventory": _BASE + f"""select coalesce(x.s, y.s, z.s) as source, coalesce(e, 0) as appears_in_edges, coalesce(u, 0) as null_in_book_ordinal, coalesce(w, 0) as hadiths_without_narrated, coalesce(o, 0) as orphan_narrators
 from (select source_corpus s, count(*) e, count(*) filter (where hadith_number_in_book is null) u from a group by 1) x full join (select source_corpus s, count(*) w from h where id not in (select to_id from r) group by 1) y on x.s = y.s
 full join (select coalesce(source_corpus, 'unknown') s, count(*) o from {_ORPHAN} group by 1) z on coalesce(x.s, y.s) = z.s""",
    "v5_collections": _BASE + "select id as collection_id, name_en, name_ar, expected_count, source_corpus as source from c where name_ar is null or trim(name_ar) = '' or expected_count is null",
    "v6_sources": _BASE + """select coalesce(x.s, y.s, z.s) as source, coalesce(hn, 0) as hadiths, coalesce(an, 0) as appears_in_edges, coalesce(cn, 0) as collections, coalesce(hn, 0) - coalesce(an, 0) as orphan_hadiths
 from (select source_corpus s, count(*) hn from h group by 1) x full join (select source_corpus s, count(*) an from a group by 1) y on x.s = y.s full join (select source_corpus s, count(*) cn from c group by 1) z on coalesce(x.s, y.s) = z.s""",
    "v6_exclusive": _BASE + ", o as (select from_id from r join h on r.to_id = h.id group by 1 having count(*) = count(*) filter (where source_corpus = 'sanadset')) select (select count(*) from o) as exclusive_narrators, (select count(*) from t where from_id in (select from_id from o)) as edges_from_them",
    "v7_reciprocal": _BASE + ", d as (select distinct from_id, to_id from t) select from_id as narrator_id, count(*) as partners from d x where exists (select 1 from d y where y.from_id = x.to_id and y.to_id = x.from_id) group by 1 order by 2 desc, 1 limit 200",
}
