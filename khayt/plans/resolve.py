"""Entity resolution and near-duplicates over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from khayt.functions import arabic as A
from khayt.functions import scalars as S
from khayt.operators import parallels as P
from khayt.operators import resolution as N
from khayt.operators import resolve as R
from khayt.operators import sequence as Q
from khayt.plans.graph import _BASE, Tables, _latest
from khayt.runtime import stored, table

BIO = ("name_ar", "name_en", "aliases", "death_year_ah", "death_year_provenance", "gender", "generation", "mention_count", "external_id")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(table(spark, sf_dir, "narrators_canonical"))


def _records(canonical: DataFrame) -> DataFrame:
    """The latest row of each narrator: id, name, keys (name, then other Arabic names, normalised), years, gender."""
    r = Q.latest(canonical.where("canonical_id is not null"), ["canonical_id"], ["loaded_at"], BIO)
    empty = F.array().cast("array<string>")
    names = F.filter(F.concat(F.array("name_ar"), F.coalesce("aliases", empty)), lambda n: n.isNotNull() & A.is_arabic(n))
    keys = F.array_distinct(F.filter(F.transform(names, A.normalize_arabic), lambda n: n != ""))
    return r.select(F.col("canonical_id").alias("id"), A.normalize_arabic(F.col("name_ar")).alias("name"), A.clean_whitespace(F.col("name_en")).alias("name_en"), keys.alias("keys"), F.col("death_year_ah").alias("death_year"),
        F.lower(F.trim("death_year_provenance")).alias("provenance"), F.nullif(F.lower(F.trim("gender")), F.lit("unknown")).alias("gender"), F.lower(F.trim("generation")).alias("generation"), "mention_count", "external_id")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select(F.col("id").alias("candidate"), F.col("name").alias("name_ar"), "name_en", F.col("id").alias("seq"), "external_id", "death_year")


def open_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct spellings of the mentions nobody resolved, as mentions of their own."""
    m = table(spark, sf_dir, "mentions_resolved").where("canonical_narrator_id is null and name_raw is not null").select("name_raw").distinct()
    arabic = A.is_arabic(F.col("name_raw"))
    return m.select(F.col("name_raw").alias("mention"), F.when(arabic, A.normalize_arabic(F.col("name_raw"))).alias("name_ar"), F.when(~arabic, A.clean_whitespace(F.col("name_raw"))).alias("name_en"))


def r_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.exact_matches(open_names(spark, sf_dir), candidates(spark, sf_dir)).select("mention", "candidate", "stage")


def r_near_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.near_names(open_names(spark, sf_dir).select(F.col("name_ar").alias("a")), candidates(spark, sf_dir).select(F.col("name_ar").alias("b")))


def r_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three stages and the one accepted."""
    m, c = stored(open_names(spark, sf_dir), "names"), stored(candidates(spark, sf_dir), "candidates")
    every = R.exact_matches(m, c).unionByName(R.fuzzy_matches(m, c)).unionByName(R.crossref_matches(m, c))
    return R.accepted(every, F.lit(True)).select("mention", "candidate", F.round("score", 6).alias("score"), "stage")


def mention_rows(mentions: DataFrame) -> DataFrame:
    """One row a mention, its latest, as resolution takes them; stage is ``given`` where the person was there already."""
    m = Q.latest(mentions.where("mention_id is not null"), ["mention_id"], ["loaded_at"], ["hadith_id", "chain_index", "position_in_chain", "name_raw", "canonical_narrator_id"])
    arabic, raw = A.is_arabic(F.col("name_raw")), F.col("name_raw")
    return m.select(
        F.col("mention_id").alias("mention"), "hadith_id", F.coalesce("chain_index", F.lit(0)).alias("chain_index"), F.col("position_in_chain").alias("position"), F.when(arabic, A.normalize_arabic(raw)).alias("name_ar"),
        F.when(~arabic, A.clean_whitespace(raw)).alias("name_en"), S.with_prefix(F.col("canonical_narrator_id"), "nar:").alias("person"), F.when(F.col("canonical_narrator_id").isNotNull(), "given").alias("stage"),
    )


def person_records(canonical: DataFrame) -> DataFrame:
    return _records(canonical).withColumn("id", S.with_prefix(F.col("id"), "nar:"))


def death_observations(canonical: DataFrame) -> DataFrame:
    seen = canonical.where(F.col("death_year_ah").between(1, 1500) | F.col("death_year_ah").isNull())
    return seen.select(S.with_prefix(F.col("canonical_id"), "nar:").alias("person"), F.col("death_year_ah").alias("point"), F.col("death_year_ah_earliest").alias("earliest"), F.col("death_year_ah_latest").alias("latest"), F.lower(F.trim("death_date_precision")).alias("precision"))


def accepted_pairs(matches: DataFrame) -> DataFrame:
    m = matches.where("lower(trim(decision)) = 'accepted'")
    return m.select(S.with_prefix(F.col("left_id"), "nar:").alias("a"), S.with_prefix(F.col("right_id"), "nar:").alias("b"))


def _resolved(spark: SparkSession, sf_dir: str, stop_after: str | None = None) -> dict[str, DataFrame]:
    from khayt.pipeline import resolve_stages, run_stages

    tables = {n: table(spark, sf_dir, n) for n in ("mentions_resolved", "narrators_canonical", "narrator_matches")}
    got = run_stages(resolve_stages(), tables, stop_after=stop_after)
    if got.failed:
        raise RuntimeError(str(got.failed))
    return tables


def r_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open mentions with a record of exactly their name, and whether the years of their neighbours in the chain speak against it."""
    m, r = stored(mention_rows(table(spark, sf_dir, "mentions_resolved")), "mentions"), stored(person_records(table(spark, sf_dir, "narrators_canonical")), "records")
    near = N.with_context(m, r).where("person is null").withColumn("name", F.coalesce("name_ar", "name_en"))
    names = near.select(F.col("name").alias("mention"), "name_ar", "name_en").dropna(subset=["mention"]).distinct()
    exact = R.exact_matches(names, r.select(F.col("id").alias("candidate"), F.col("name").alias("name_ar"), "name_en", F.col("id").alias("seq"))).select(F.col("mention").alias("name"), "candidate")
    met = near.join(exact, "name").join(r.select(F.col("id").alias("candidate"), "death_year"), "candidate")
    return met.select("mention", "candidate", R.temporal_ok(F.col("death_year"), F.col("adjacent")).alias("fits"))


def r_resolved_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mention under the person it stands for after all steps, and what resolved it."""
    return _resolved(spark, sf_dir)["mentions"].select("mention", "person", "stage")


def r_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The persons on record after all steps."""
    return _resolved(spark, sf_dir)["records"].select("id", "name", "death_year", "gender", "generation", "mention_count")


def r_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir)["measures"]


def r_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "narrators_canonical")
    got = R.first_wins(c, "canonical_id", ["loaded_at", "name_ar", "name_en", "gender", "death_year_ah"], ["name_ar", "name_en", "gender", "death_year_ah"], ["source_ids"])
    return got.select("canonical_id", "name_ar", "name_en", "gender", "death_year_ah", F.array_join(F.array_sort(F.array_compact("source_ids")), "|").alias("source_ids"), "records")


def r_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "mentions_resolved").select(A.normalize_arabic(F.col("name_raw")).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("mentions"))
    return n.where(R.is_generic(F.col("name"), F.col("mentions")))


def r_candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.candidate_pairs(records(spark, sf_dir).select("id", "keys"))


def r_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of narrators that may be one, with their representative."""
    r = stored(records(spark, sf_dir), "records")
    g = stored(R.safe_groups(r, R.mergeable(r, R.candidate_pairs(r.select("id", "keys")))), "groups")
    best = R.representatives(r, g, ["name", "name_en", "death_year", "gender", "external_id"])
    return g.join(best, "group_id").select("id", "group_id", "representative")


def r_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records merged by identical normalised name: values of the representative first, mentions summed."""
    r = stored(records(spark, sf_dir).where("name <> ''"), "records")
    g = r.select("id", F.min("id").over(Window.partitionBy("name")).alias("group_id"))
    best = R.representatives(r, g, ["name_en", "death_year", "gender", "external_id"])
    return R.merge_groups(r, g, best, ["name", "name_en", "death_year", "gender"], ["keys"]).select("id", "name", "name_en", "death_year", "gender", "mention_count", F.size("keys").alias("n_keys"))


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    m = t.mentions().where("canonical_narrator_id is not null")
    n = Q.neighbours(m, ["hadith_id", "chain_index"], ["position_in_chain", "mention_id"], "canonical_narrator_id")
    return n.select(F.col("mention_id").alias("mention"), F.col("canonical_narrator_id").alias("person"), "previous", "following")


def r_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain(spark, sf_dir)


def _years(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir)
    return r.where(S.plausible_death(F.col("death_year"), F.col("generation"))).select(S.with_prefix(F.col("id"), "nar:").alias("person"), F.col("death_year").alias("year"))


def r_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.death_estimates(chain(spark, sf_dir), _years(spark, sf_dir))


def r_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.split_plan(R.death_estimates(chain(spark, sf_dir), _years(spark, sf_dir)))


def r_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deaths of narrators delivered several times, reconciled."""
    c = table(spark, sf_dir, "narrators_canonical")
    ok = F.col("death_year_ah").between(1, 1500)
    seen = c.where(ok | F.col("death_year_ah").isNull()).select(F.col("canonical_id").alias("person"), F.col("death_year_ah").alias("point"), F.col("death_year_ah_earliest").alias("earliest"), F.col("death_year_ah_latest").alias("latest"), F.lower(F.trim("death_date_precision")).alias("precision"))
    return R.reconcile_dates(seen)


def r_generation_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "narrators_canonical").withColumn("generation", F.lower(F.trim("generation")))
    return R.fill_generation_dates(c).groupBy("death_date_precision").agg(F.count(F.lit(1)).alias("rows"), F.sum("death_year_ah").alias("points"), F.sum("death_year_ah_earliest").alias("earliest"), F.sum("death_year_ah_latest").alias("latest"))


def r_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the companions of two narrators matched to each other are the same."""
    m = table(spark, sf_dir, "narrator_matches").where("lower(trim(decision)) = 'accepted'")
    a, b = S.with_prefix(F.col("left_id"), "nar:"), S.with_prefix(F.col("right_id"), "nar:")
    pairs = m.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct()
    return R.neighbour_overlap(chain(spark, sf_dir), pairs).select("a", "b", F.round("overlap", 6).alias("overlap"))


def r_unify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which accepted matches pass the gates of unification."""
    r = records(spark, sf_dir).withColumn("id", S.with_prefix(F.col("id"), "nar:"))
    o = stored(r_overlap(spark, sf_dir), "overlap")
    seeds = o.select(F.concat_ws("+", "a", "b").alias("seed"), F.explode(F.array("a", "b")).alias("member"))
    flagged = table(spark, sf_dir, "narrators_canonical").where("over_merged").select(S.with_prefix(F.col("canonical_id"), "nar:").alias("id")).distinct()
    return R.unify(seeds, r.select("id", "death_year", "provenance", "gender"), flagged, o)


def r_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised spelling as a clustering of mentions, against the narrators they were resolved to."""
    m = Q.latest(table(spark, sf_dir, "mentions_resolved").where("mention_id is not null"), ["mention_id"], ["loaded_at"], ["canonical_narrator_id", "name_raw"]).where("canonical_narrator_id is not null and name_raw is not null")
    q = R.pair_quality(m.select(F.col("mention_id").alias("id"), F.col("canonical_narrator_id").alias("label")), m.select(F.col("mention_id").alias("id"), A.normalize_arabic(F.col("name_raw")).alias("label")))
    return q.select("true_pairs", "found_pairs", "both", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


def _classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.token_classes(table(spark, sf_dir, "hadiths"), "source_id", P.tokens(F.col("matn_ar"), F.col("matn_en")), F.col("sect"))


def x_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of equal texts (as sets of words) of each hadith."""
    return _classes(spark, sf_dir).select(F.col("key").alias("source_id"), "class_id")


def x_parallels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of classes of parallel texts, with tier, and whether they cross traditions."""
    c = stored(_classes(spark, sf_dir), "classes")
    pairs = P.similar_classes(c)
    sects = c.groupBy("class_id").agg(F.min(F.nullif("mark", F.lit(""))).alias("lo"), F.max(F.nullif("mark", F.lit(""))).alias("hi"))
    met = pairs.join(sects.select(F.col("class_id").alias("class_a"), F.col("lo").alias("la"), F.col("hi").alias("ha")), "class_a").join(sects.select(F.col("class_id").alias("class_b"), F.col("lo").alias("lb"), F.col("hi").alias("hb")), "class_b")
    crosses = F.coalesce(~((F.col("la") == F.col("ha")) & (F.col("lb") == F.col("hb")) & (F.col("la") == F.col("lb"))), F.lit(False))
    return met.select("class_a", "class_b", F.round("score", 6).alias("score"), S.variant_type(F.col("score")).alias("variant_type"), crosses.alias("cross_sect"))


def x_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most similar vectors of every vector whose id is divisible by 50."""
    v = table(spark, sf_dir, "embeddings")
    return P.cosine_search(v, v.where("vec_id % 50 = 0"), "vec_id", "embedding", k=10, least=0.3).select("query", "key", F.round("score", 5).alias("score"))


def x_inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    return P.inverted_search(v, v.where("vec_id % 50 = 0"), "vec_id", "embedding", k=10, least=0.3, lists=32, probes=24).select("query", "key", F.round("score", 5).alias("score"))


def x_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the pairs that the exact search finds the inverted file finds too, and whether that is at least nine in ten."""
    exact, found = x_search(spark, sf_dir).select("query", "key"), x_inverted(spark, sf_dir).select("query", "key", F.lit(True).alias("hit"))
    got = exact.join(found, ["query", "key"], "left").agg(F.count(F.lit(1)).alias("exact"), F.count("hit").alias("found"))
    return got.select("exact", "found", F.round(F.coalesce(F.try_divide("found", "exact"), F.lit(1.0)), 4).alias("recall"), (F.col("found") >= F.col("exact") * 0.9).alias("enough"))


def x_compose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of two detectors in one, the first's rows standing."""
    v = table(spark, sf_dir, "narrator_matches").select(F.col("left_id").alias("hadith_id_a"), F.col("right_id").alias("hadith_id_b"), F.col("score").alias("similarity_score"), S.variant_type(F.col("score")).alias("variant_type"), F.lit(False).alias("cross_sect"), "stage")
    return P.compose(v.where("stage = 'crossref'").drop("stage"), v.where("stage <> 'crossref'").drop("stage"))


_N = A.sql_normalize
_REC = f"""with recursive r0 as {_latest('narrators_canonical', 'canonical_id', BIO)},
r as (select canonical_id id, {_N('name_ar')} as name, trim(regexp_replace(name_en, '[\\s\\p{{Z}}]+', ' ', 'g')) name_en, death_year_ah death_year, lower(trim(death_year_provenance)) provenance, nullif(lower(trim(gender)), 'unknown') gender, lower(trim(generation)) generation, mention_count, external_id,
 list_distinct(list_filter(list_transform(list_filter([name_ar] || coalesce(aliases, []), lambda n: n is not null and regexp_matches(n, '[\\x{{0600}}-\\x{{06FF}}]')), lambda n: {_N('n')}), lambda n: n <> '')) as keys from r0),
o as (select distinct name_raw mention, case when regexp_matches(name_raw, '[\\x{{0600}}-\\x{{06FF}}]') then {_N('name_raw')} end name_ar, case when not regexp_matches(name_raw, '[\\x{{0600}}-\\x{{06FF}}]') then trim(regexp_replace(name_raw, '[\\s\\x{{0B}}\\x{{85}}\\p{{Z}}]+', ' ', 'g')) end name_en
 from mentions_resolved where canonical_narrator_id is null and name_raw is not null),
"""
#: DuckDB counts edits in bytes, so each Arabic letter becomes one byte.
_BYTES = "'ءابتثجحخدذرزسشصضطظعغفقكلمنهويپچژگ،', 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJ'"
_CON = "(" + ", ".join(f"'{c}'" for c in R.CONNECTORS) + ")"
_CHAIN = _BASE + """, q as (select mention_id, nid, lag(nid) over w prv, lead(nid) over w nxt from m where nid is not null window w as (partition by hid, chain order by pos, mention_id)),
ch as (select mention_id as mention, nid as person, nullif(prv, nid) as previous, nullif(nxt, nid) as following from q)
"""
_YEAR = f""", rec as {_latest('narrators_canonical', 'canonical_id', BIO)}, yr as (select case when starts_with(canonical_id, 'nar:') then canonical_id else 'nar:' || canonical_id end person, min(death_year_ah) y from rec where death_year_ah between 11 and 450
 and coalesce(case lower(trim(generation)) {' '.join(f"when '{g}' then death_year_ah between {a - 50} and {b + 50}" for g, (a, b) in S.GENERATIONS.items())} end, true) group by 1),
es as (select mention, ch.person, list_filter([a.y + 47, b.y - 47], lambda v: v is not null) v from ch left join yr a on ch.previous = a.person left join yr b on ch.following = b.person),
est as (select mention, person, greatest(11, least(450, round_even(list_avg(v), 0)::int)) as estimate from es where len(v) > 0)
"""
_WIN = " + ".join(f"(midpoint between {a} and {b})::int" for a, b in S.GENERATIONS.values())
QUERIES = {f.__name__: f for f in (r_exact, r_near_names, r_matches, r_gated, r_resolved_mentions, r_canonical, r_measures, r_first_wins, r_generic, r_candidate_pairs, r_clusters, r_merged, r_neighbours, r_estimates, r_split, r_dates, r_generation_dates, r_overlap, r_unify, r_quality, x_classes, x_parallels, x_search, x_inverted, x_recall, x_compose)}
_DATES = f"""with o as (select canonical_id person, lower(trim(death_date_precision)) pr, death_year_ah p0, death_year_ah_earliest e0, death_year_ah_latest l0 from narrators_canonical
 where canonical_id is not null and coalesce(death_year_ah between 1 and 1500, true) and coalesce(death_year_ah, death_year_ah_earliest, death_year_ah_latest) is not null),
k as (select *, case when pr = 'after' and coalesce(e0, p0) is not null then 'after' when pr = 'before' and coalesce(l0, p0) is not null then 'before' else 'closed' end kind from o),
s as (select person, kind, pr, case when kind = 'closed' then coalesce(p0, e0, l0) end p, case when kind <> 'before' then coalesce(e0, p0) end lo, case when kind <> 'after' then coalesce(l0, p0) end hi from k),
mid as (select person, quantile_cont(p, 0.5) med, count(p) n, min(p) p_min, max(p) p_max from s where p is not null group by 1),
near as (select person, n, p_min, p_max, min(p) filter (abs(p - med) <= {R.OUTLIER_GAP}) c_lo, max(p) filter (abs(p - med) <= {R.OUTLIER_GAP}) c_hi, count(*) filter (abs(p - med) <= {R.OUTLIER_GAP}) c from s join mid using (person) where p is not null group by all),
core as (select person, p_min, p_max, case when n > 2 and c >= 2 then c_lo else p_min end b_lo, case when n > 2 and c >= 2 then c_hi else p_max end b_hi from near),
band as (select s.*, b_lo, b_hi, p_min, p_max from s join core using (person) where kind = 'closed' and p between b_lo - {R.AGREEMENT} and b_hi + {R.AGREEMENT}),
env as (select person, p_min, p_max, bool_and(pr = 'circa') circa,
 least(b_lo, case when count(distinct p) > 1 then min(lo) filter (b_lo - lo <= {R.NOISE_GAP}) else min(lo) end) lo0, greatest(b_hi, case when count(distinct p) > 1 then max(hi) filter (hi - b_hi <= {R.NOISE_GAP}) else max(hi) end) hi0
 from band group by person, p_min, p_max, b_lo, b_hi),
after as (select env.*, coalesce((select max(s.lo) from s where s.person = env.person and kind = 'after' and s.lo between lo0 and hi0), lo0) lo from env),
done as (select after.*, coalesce((select min(s.hi) from s where s.person = after.person and kind = 'before' and s.hi between after.lo and hi0), hi0) hi from after),
votes as (select person, p, count(*) v from band join done using (person) where p between done.lo and done.hi group by all),
mode as (select person, arg_min(p, (-v, p)) point from votes group by 1),
t as (select person, count(*) as sources, max(lo) filter (kind <> 'closed') a, min(hi) filter (kind <> 'closed') b from s group by 1)
select person, case when lo is not null then coalesce(point, ((lo + hi) // 2)::int) else coalesce(a, b) end as point, case when lo is not null then lo else a end as earliest,
 case when lo is not null then hi when a > b then null else b end as latest,
 case when lo is not null then case when circa then 'circa' when lo = hi then 'exact' else 'range' end when a = b then 'exact' when a < b then 'range' when a is not null then 'after' when b is not null then 'before' else 'unknown' end as precision,
 sources, case when lo is not null then p_max - p_min > {R.AGREEMENT} else coalesce(a > b, false) end as conflict
from t left join done using (person) left join mode using (person)"""

_GATED = _REC + f"""lm as {_latest('mentions_resolved', 'mention_id', ('hadith_id', 'chain_index', 'position_in_chain', 'name_raw', 'canonical_narrator_id'))},
am as (select mention_id mention, hadith_id, coalesce(chain_index, 0) ci, position_in_chain pos, case when regexp_matches(name_raw, '[\\x{{0600}}-\\x{{06FF}}]') then {_N('name_raw')} end name_ar,
 case when not regexp_matches(name_raw, '[\\x{{0600}}-\\x{{06FF}}]') then trim(regexp_replace(name_raw, '[\\s\\x{{0B}}\\x{{85}}\\p{{Z}}]+', ' ', 'g')) end name_en,
 case when canonical_narrator_id like 'nar:%' then canonical_narrator_id else 'nar:' || canonical_narrator_id end person from lm),
rr as (select case when id like 'nar:%' then id else 'nar:' || id end id, name, name_en, death_year from r),
k as (select 0 lang, name, id from rr where name <> '' union all select 1, lower(name_en), id from rr where name_en <> ''),
nm as (select distinct name_ar, name_en from am where person is null and coalesce(name_ar, name_en) is not null),
x as (select name_ar, null name_en, min(k.id) candidate from nm join k on lang = 0 and k.name = name_ar where name_ar is not null group by 1 union all select null, name_en, min(k.id) from nm join k on lang = 1 and k.name = lower(name_en) where name_ar is null group by 2),
near as (select a.mention, b.y from am a join (select am.*, death_year y from am join rr on person = rr.id where death_year is not null) b on a.hadith_id = b.hadith_id and a.ci = b.ci and abs(a.pos - b.pos) = 1 where a.person is null)
select a.mention, candidate, d.death_year is null or not exists (select 1 from near n where n.mention = a.mention) or exists (select 1 from near n where n.mention = a.mention and abs(n.y - d.death_year) between 15 and 80) as fits
from am a join x on coalesce(a.name_ar, a.name_en) = coalesce(x.name_ar, x.name_en) join rr d on d.id = candidate where a.person is null"""

SQL = {
    "r_dates": _DATES,
    "r_gated": _GATED,
    "r_exact": _REC + """k as (select 0 lang, name, id from r where name <> '' union all select 1, lower(name_en), id from r where name_en <> ''),
mm as (select mention, 0 lang, name_ar name from o where name_ar <> '' union all select mention, 1, lower(name_en) from o where name_en <> '')
select mention, candidate, 'exact' as stage from (select mention, k.id candidate, row_number() over (partition by mention order by mm.lang, k.id) i from mm join k on mm.lang = k.lang and mm.name = k.name) where i = 1""",
    "r_first_wins": """with c as (select *, row_number() over (partition by canonical_id order by loaded_at, name_ar nulls first, name_en nulls first, gender nulls first, death_year_ah nulls first) i from narrators_canonical),
e as (select canonical_id, array_to_string(list_sort(list(distinct x)), '|') source_ids from (select canonical_id, unnest(source_ids) x from c) where x is not null group by 1)
select c.canonical_id, arg_min(name_ar, i) filter (where name_ar is not null) as name_ar, arg_min(name_en, i) filter (where name_en is not null) as name_en, arg_min(gender, i) filter (where gender is not null) as gender,
 arg_min(death_year_ah, i) filter (where death_year_ah is not null) as death_year_ah, coalesce(any_value(e.source_ids), '') as source_ids, count(*) as records from c left join e using (canonical_id) group by 1""",
    "r_generic": f"""with n as (select {_N('name_raw')} as name, count(*) as mentions from mentions_resolved group by 1), w as (select *, string_split(name, ' ') ws from n where name <> '' and mentions >= 50)
select name, mentions from w where len(list_filter(list_distinct(ws), lambda t: length(t) >= 2 and t not in {_CON})) <= 2 and (len(ws) <= 2 or (ws[1] in {R.KUNYA_MARKS} and not list_has_any(ws, {list(R.NASAB_MARKS)})))""",
    "r_candidate_pairs": _REC + f"""w as (select distinct id, t from (select id, unnest(string_split(k, ' ')) t from (select id, unnest(keys) k from r)) where length(t) >= 2 and t not in {_CON}),
b as (select x.id, x.t x, y.t y from w x join w y on x.id = y.id and x.t < y.t), s as (select x, y from b group by all having count(*) between 2 and 250)
select distinct l.id as a, m.id as b from b l join s using (x, y) join b m on m.x = l.x and m.y = l.y and l.id < m.id""",
    "r_merged": _REC + """g as (select *, (name_en is not null)::int + (death_year is not null)::int + (gender is not null)::int + (external_id is not null)::int f from r where name <> ''),
p as (select *, row_number() over (partition by name order by coalesce(mention_count, 0) desc, f desc, length(name) desc, id) i from g), q as (select *, first_value(id) over (partition by name order by i) rep from p),
z as (select *, row_number() over (partition by name order by (id <> rep)::int, id) j from q)
select any_value(rep) as id, name, arg_min(name_en, j) filter (where name_en is not null) as name_en, arg_min(death_year, j) filter (where death_year is not null) as death_year, arg_min(gender, j) filter (where gender is not null) as gender,
 sum(coalesce(mention_count, 0))::bigint as mention_count, len(list_distinct(flatten(list(keys))))::int as n_keys from z group by name""",
    "r_near_names": (_REC + """a as (select distinct name_ar a from o where name_ar is not null), b as (select distinct name b from r where length(name) > 2),
p as (select a, b, levenshtein(translate(a, {L}), translate(b, {L})) d from a join b on substr(a, 1, 2) = substr(b, 1, 2) and abs(length(a) - length(b)) <= 2) select a, b, d::int as distance from p where d <= 2""").replace("{L}", _BYTES),
    "r_neighbours": _CHAIN + "select * from ch",
    "r_estimates": _CHAIN + _YEAR + "select mention, person, estimate from est",
    "r_split": _CHAIN + _YEAR + f""", cu as (select *, case when estimate - lag(estimate) over (partition by person order by estimate, mention) > 80 then 1 else 0 end op from est),
bd as (select *, sum(op) over (partition by person order by estimate, mention) band from cu), ba as (select person, band::int as band, count(*) as mentions, round_even(avg(estimate), 0)::int as midpoint, min(estimate) as earliest, max(estimate) as latest from bd group by all having count(*) >= 10),
bb as (select *, count(*) over (partition by person) kk, {_WIN} ww from ba), bc as (select *, count(*) over (partition by person) k2 from bb where kk <= 6 and ww > 0)
select person, band, mentions, midpoint, earliest, latest, case when ww = 1 then case {' '.join(f"when midpoint between {a} and {b} then 'd:{a}-{b}'" for a, b in S.GENERATIONS.values())} end else 'd:' || (midpoint // 25 * 25) end as label,
 case when row_number() over (partition by person order by mentions desc, midpoint) = 1 then 'stays' else 'peels' end as role from bc where k2 >= 2""",
    "r_generation_dates": f"""with c as (select *, lower(trim(generation)) g, coalesce(death_year_ah, death_year_ah_earliest, death_year_ah_latest) is null and coalesce(death_date_precision, '') in ('', 'unknown') and lower(trim(generation)) in {tuple(S.GENERATIONS)} f from narrators_canonical)
select case when f then 'tabaqa_estimate' else death_date_precision end as death_date_precision, count(*) as rows, sum(case when f then case g {' '.join(f"when '{g}' then {(a + b) // 2}" for g, (a, b) in S.GENERATIONS.items())} end else death_year_ah end)::bigint as points,
 sum(case when f then case g {' '.join(f"when '{g}' then {a}" for g, (a, b) in S.GENERATIONS.items())} end else death_year_ah_earliest end)::bigint as earliest, sum(case when f then case g {' '.join(f"when '{g}' then {b}" for g, (a, b) in S.GENERATIONS.items())} end else death_year_ah_latest end)::bigint as latest from c group by 1""",
    "r_overlap": _CHAIN + """, nb as (select person, x, count(*) n from (select person, unnest([previous, following]) x from ch) where x is not null group by all), tp as (select * from nb qualify row_number() over (partition by person order by n desc, x) <= 20),
pr as (select distinct least(l, r) a, greatest(l, r) b from (select case when starts_with(left_id, 'nar:') then left_id else 'nar:' || left_id end l, case when starts_with(right_id, 'nar:') then right_id else 'nar:' || right_id end r from narrator_matches where lower(trim(decision)) = 'accepted') where l <> r),
ct as (select person, count(*) k from tp group by 1)
select a, b, round(coalesce((select count(*) from tp x join tp y on x.x = y.x where x.person = a and y.person = b)::double / nullif(least(coalesce(ca.k, 0), coalesce(cb.k, 0)), 0), 0.0), 6) as overlap from pr left join ct ca on ca.person = a left join ct cb on cb.person = b""",
    "r_unify": (_CHAIN + """, nb as (select person, x, count(*) n from (select person, unnest([previous, following]) x from ch) where x is not null group by all), tp as (select * from nb qualify row_number() over (partition by person order by n desc, x) <= 20),
pr as (select distinct least(l, r) a, greatest(l, r) b from (select case when starts_with(left_id, 'nar:') then left_id else 'nar:' || left_id end l, case when starts_with(right_id, 'nar:') then right_id else 'nar:' || right_id end r from narrator_matches where lower(trim(decision)) = 'accepted') where l <> r),
ct as (select person, count(*) k from tp group by 1),
ov as (select a, b, round(coalesce((select count(*) from tp x join tp y on x.x = y.x where x.person = a and y.person = b)::double / nullif(least(coalesce(ca.k, 0), coalesce(cb.k, 0)), 0), 0.0), 6) v from pr left join ct ca on ca.person = a left join ct cb on cb.person = b),
rr as (select case when starts_with(canonical_id, 'nar:') then canonical_id else 'nar:' || canonical_id end id, death_year_ah y, lower(trim(death_year_provenance)) p, nullif(lower(trim(gender)), 'unknown') g from {REC}),
fg as (select distinct case when starts_with(canonical_id, 'nar:') then canonical_id else 'nar:' || canonical_id end id from narrators_canonical where over_merged),
mm as (select a || '+' || b seed, v, unnest([a, b]) m from ov), gg as (select seed, any_value(v) v, count(rr.id) n, count(fg.id) f, max(y) filter (where p = 'corroborated') - min(y) filter (where p = 'corroborated') sure, max(y) - min(y) spread, count(distinct g) filter (where g in ('male', 'female')) k
 from mm left join rr on rr.id = m left join fg on fg.id = rr.id group by seed)
select seed, case when n < 2 then 'too_few' when f > 0 then 'flagged' when sure > 2 then 'years' when spread > 50 then 'spread' when k > 1 then 'gender' when v < 0.3 then 'context' else 'unify' end as verdict from gg""").replace("{REC}", _latest("narrators_canonical", "canonical_id", BIO)),
    "r_quality": f"""with m as (select canonical_narrator_id t, {_N('name_raw')} f from {_latest('mentions_resolved', 'mention_id', ('canonical_narrator_id', 'name_raw'))} where canonical_narrator_id is not null and name_raw is not null),
a as (select sum(n * (n - 1) / 2)::double p from (select count(*) n from m group by t)), b as (select sum(n * (n - 1) / 2)::double p from (select count(*) n from m group by f)), c as (select sum(n * (n - 1) / 2)::double p from (select count(*) n from m group by t, f))
select a.p as true_pairs, b.p as found_pairs, c.p as both, round(c.p / b.p, 6) as precision, round(c.p / a.p, 6) as recall, round(2 * (c.p / b.p) * (c.p / a.p) / (c.p / b.p + c.p / a.p), 6) as f1 from a, b, c""",
}
_TOK = f"""with t0 as (select source_id, max(sect) sect, any_value(case when regexp_matches(matn_ar, '[\\x{{0600}}-\\x{{06FF}}]') then {_N('matn_ar')} when trim(matn_en) <> '' then lower(matn_en) end) x from hadiths group by 1),
t1 as (select source_id, sect, list_sort(list_distinct(list_filter(string_split_regex(x, '[\\s\\p{{Z}}]+'), lambda w: w <> ''))) ws from t0), t2 as (select *, min(source_id) over (partition by ws) class_id from t1 where len(ws) > 0)
"""
SQL["x_classes"] = _TOK + "select source_id, class_id from t2"
SQL["x_parallels"] = _TOK + """, k as materialized (select class_id, any_value(ws) ws, min(nullif(sect, '')) lo, max(nullif(sect, '')) hi from t2 group by 1), d as (select w, count(*) df from (select unnest(ws) w from t2) group by 1),
e as materialized (select class_id, w from (select class_id, unnest(ws) w from k) join d using (w) where df <= 500), c as (select distinct x.class_id a, y.class_id b from e x join e y on x.w = y.w and x.class_id < y.class_id),
j as (select a, b, p.lo la, p.hi ha, q.lo lb, q.hi hb, len(list_intersect(p.ws, q.ws)) i, len(p.ws) n, len(q.ws) m from c join k p on p.class_id = a join k q on q.class_id = b), s as (select *, i::double / (n + m - i) score from j)
select a as class_a, b as class_b, round(score, 6) as score, case when score >= 0.9 then 'verbatim' when score >= 0.8 then 'close_paraphrase' else 'thematic' end as variant_type, coalesce(not (la = ha and lb = hb and la = lb), false) as cross_sect from s where score >= 0.5"""
SQL["x_search"] = """with v as (select vec_id, embedding::double[64] e from embeddings), s as (select q.vec_id query, v.vec_id as key, array_cosine_similarity(q.e, v.e) score from v q join v on q.vec_id <> v.vec_id where q.vec_id % 50 = 0)
select query, key, round(score, 5) as score from s where score >= 0.3 qualify row_number() over (partition by query order by score desc, key) <= 10"""
SQL["x_compose"] = """with v as (select least(left_id, right_id) hadith_id_a, greatest(left_id, right_id) hadith_id_b, score similarity_score, case when score >= 0.9 then 'verbatim' when score >= 0.8 then 'close_paraphrase' else 'thematic' end variant_type, (stage <> 'crossref')::int p from narrator_matches where left_id <> right_id and stage is not null)
select hadith_id_a, hadith_id_b, similarity_score, variant_type, false as cross_sect from v qualify row_number() over (partition by hadith_id_a, hadith_id_b order by p, similarity_score desc) = 1"""
