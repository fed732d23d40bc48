"""Resolution from end to end: open mentions to persons on record, records merged, split, dated and unified, and every mention under the id that stands at the end.

Each step takes and gives two tables. mentions: (mention, hadith_id, chain_index, position, name_ar, name_en, person, stage), one row a mention. records: (id, name, name_en, keys, death_year,
provenance, gender, generation, mention_count, external_id), one row a person. An id that a step does away with is rewritten in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khayt.functions import places
from khayt.operators import resolve as R
from khayt.operators import sequence as Q
from khayt.operators.graph import components
from khayt.runtime import stored

RECORD = ("name", "name_en", "death_year", "provenance", "gender", "generation", "external_id")


def with_context(mentions: DataFrame, records: DataFrame) -> DataFrame:
    """Mentions with ``adjacent``: the death years of the persons before and after in the same chain, as far as they are resolved; with ``regions`` of these if records have ``place``.

    Mentions without a text have no neighbours.
    """
    about = records.select(F.col("id").alias("person"), "death_year", *([places.region(F.col("place")).alias("_region")] if "place" in records.columns else []))
    rows = mentions.join(about, "person", "left")
    chained = R.adjacent_years(rows.where("hadith_id is not null"), ["hadith_id", "chain_index"], "position", "death_year")
    loose = rows.where("hadith_id is null").withColumn("adjacent", F.array().cast("array<int>"))
    out = chained.unionByName(loose)
    if "_region" in rows.columns:
        regions = lambda df: R.adjacent_years(df, ["hadith_id", "chain_index"], "position", "_region").withColumnRenamed("adjacent", "regions")
        where = regions(rows.where("hadith_id is not null")).select("mention", "regions")
        out = out.join(where, "mention", "left")
    return out.drop("death_year", "_region")


def name_matches(names: DataFrame, records: DataFrame) -> DataFrame:
    """(name, candidate, score, stage) of distinct names (mention, name_ar, name_en) by all three stages; at most one of each stage."""
    c = stored(records.select(F.col("id").alias("candidate"), F.col("name").alias("name_ar"), "name_en", F.col("id").alias("seq"), "external_id"), "candidates")
    n = stored(names, "names")
    return R.exact_matches(n, c).unionByName(R.fuzzy_matches(n, c)).unionByName(R.crossref_matches(n, c)).withColumnRenamed("mention", "name")


def disambiguate(mentions: DataFrame, records: DataFrame, matches: DataFrame) -> DataFrame:
    """(mention, candidate, score, stage) of open mentions: the first stage's candidate that neither the years nor the places of its neighbours in the chain speak against.

    matches: (name, candidate, score, stage) per distinct name; a name has at most one of each stage, so that a frequent name costs no more than its mentions.
    """
    open_ = with_context(mentions, records).where(F.col("person").isNull()).withColumn("name", F.coalesce("name_ar", "name_en"))
    placed = "place" in records.columns
    about = records.select(F.col("id").alias("candidate"), "death_year", *([places.region(F.col("place")).alias("region")] if placed else []))
    offers = matches.join(about, "candidate").groupBy("name").agg(F.collect_list(F.struct("candidate", "score", "stage", *about.columns[1:])).alias("offers"))
    met = open_.join(offers, "name").select("mention", "adjacent", *(["regions"] if placed else []), F.inline("offers"))
    ok = R.temporal_ok(F.col("death_year"), F.col("adjacent"))
    return R.accepted(met, ok & places.travel_ok_with_any(F.col("region"), F.col("regions")) if placed else ok)


def back_fill(mentions: DataFrame, found: DataFrame) -> DataFrame:
    """Mentions with the person found for those that had none, and by which stage; a person that was there stays."""
    new = found.select("mention", F.col("candidate").alias("_p"), F.col("stage").alias("_s"))
    met = mentions.join(new, "mention", "left")
    return met.withColumn("stage", F.when(F.col("person").isNull(), F.col("_s")).otherwise(F.col("stage"))).withColumn("person", F.coalesce("person", "_p")).drop("_p", "_s")


def merge_records(mentions: DataFrame, records: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mentions, records) after each group (id, group_id) became one record under its representative's id."""
    best = stored(R.representatives(records, groups, RECORD), "representatives")
    ids = groups.join(best, "group_id").where("id <> representative").select(F.col("id").alias("old_id"), F.col("representative").alias("new_id"))
    merged = R.merge_groups(records, groups, best, RECORD, ["keys"]).select(*records.columns)
    return R.remap(mentions, stored(ids, "merged_ids"), "person"), merged


def cluster(mentions: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that may be one person become one."""
    groups = stored(R.safe_groups(records, R.mergeable(records, R.candidate_pairs(records.select("id", "keys")))), "groups")
    return merge_records(mentions, records, groups)


def chain_of(mentions: DataFrame) -> DataFrame:
    """(mention, person, previous, following) of resolved mentions within their chains."""
    rows = mentions.where("person is not null and hadith_id is not null").withColumn("canonical", F.col("person"))
    return Q.neighbours(rows, ["hadith_id", "chain_index"], ["position", "mention"], "canonical").select("mention", "person", "previous", "following")


def split(mentions: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Persons whose mentions fall into bands of years far apart: the mentions of bands that peel go to new records, dated by their band."""
    years = records.where("death_year is not null").select(F.col("id").alias("person"), F.col("death_year").alias("year"))
    estimates = stored(R.death_estimates(chain_of(mentions), years), "estimates")
    peels = stored(R.split_plan(estimates).where("role = 'peels'").withColumn("new_id", F.concat_ws("~", "person", "label")), "peels")
    bands = peels.select("person", "earliest", "latest", "new_id")
    moved = estimates.join(bands, "person").where(F.col("estimate").between(F.col("earliest"), F.col("latest"))).groupBy("mention").agg(F.min("new_id").alias("_new"))
    out = mentions.join(moved, "mention", "left").withColumn("person", F.coalesce("_new", "person")).drop("_new")
    made = peels.groupBy(F.col("person").alias("id"), "new_id").agg(F.min("midpoint").alias("_year"), F.sum("mentions").alias("_n")).join(records, "id")
    made = made.withColumn("id", F.col("new_id")).withColumn("death_year", F.col("_year")).withColumn("mention_count", F.col("_n").cast(records.schema["mention_count"].dataType)).withColumn("provenance", F.lit("uncorroborated"))
    return out, records.unionByName(made.select(*records.columns))


def unify(mentions: DataFrame, records: DataFrame, pairs: DataFrame, flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of records that pass the gates of unification become one, with all that are tied to them so."""
    on = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    overlap = stored(R.neighbour_overlap(chain_of(mentions), on), "overlap")
    seeds = stored(overlap.select(F.concat_ws("+", "a", "b").alias("seed"), "a", "b"), "seeds")
    passed = R.unify(seeds.select("seed", F.explode(F.array("a", "b")).alias("member")), records.select("id", "death_year", "provenance", "gender"), flagged, overlap).where("verdict = 'unify'")
    tied = stored(seeds.join(passed, "seed").select(F.col("a").alias("from_id"), F.col("b").alias("to_id")), "tied")
    groups = components(tied).select("id", F.col("component").alias("group_id"))
    alone = records.select("id").join(groups, "id", "left_anti").select("id", F.col("id").alias("group_id"))
    return merge_records(mentions, records, stored(groups.join(records.select("id"), "id", "left_semi").unionByName(alone), "unified"))


def contextual(mentions: DataFrame, signatures: DataFrame) -> DataFrame:
    """Mentions of a bare name that is still open, or of a record that stands for one, take the person whose signature (signature, name, teacher, student) alone fits their neighbours' names."""
    named = mentions.withColumn("name", F.coalesce("name_ar", "name_en"))
    met = Q.neighbours(named.where("hadith_id is not null"), ["hadith_id", "chain_index"], ["position", "mention"], "name")
    hit = R.contextual_matches(met.select("mention", "name", F.col("previous").alias("previous_name"), F.col("following").alias("following_name")), signatures)
    out = mentions.join(hit.withColumnRenamed("signature", "_p"), "mention", "left")
    return out.withColumn("stage", F.when(F.col("_p").isNotNull(), "contextual").otherwise(F.col("stage"))).withColumn("person", F.coalesce("_p", "person")).drop("_p")


def dated(records: DataFrame, seen: DataFrame) -> DataFrame:
    """Records with their years reconciled from observations (person, point, earliest, latest, precision)."""
    years = R.reconcile_dates(seen).select(F.col("person").alias("id"), F.col("point").alias("_y"))
    return records.join(years, "id", "left").withColumn("death_year", F.coalesce("_y", "death_year")).drop("_y").select(*records.columns)


def dated_by_generation(records: DataFrame) -> DataFrame:
    """Undated records with the middle of their generation's window."""
    none = F.lit(None).cast("int")
    wide = records.withColumns({"death_year_ah": F.col("death_year"), "death_year_ah_earliest": none, "death_year_ah_latest": none, "death_date_precision": F.lit(None).cast("string")})
    return R.fill_generation_dates(wide).withColumn("death_year", F.col("death_year_ah").cast(records.schema["death_year"].dataType)).select(*records.columns)


def measures(mentions: DataFrame, records: DataFrame, matches: DataFrame) -> DataFrame:
    """(measure, value): mentions, those resolved and by which stage, records, and names that several records fit equally well."""
    one = mentions.agg(
        F.count(F.lit(1)).alias("mentions"), F.count("person").alias("resolved"), *[F.count_if(F.col("stage") == s).alias(f"by_{s}") for s in ("given", "exact", "fuzzy", "crossref", "contextual")]
    )
    top = R.top_candidates(matches.withColumnRenamed("name", "mention"), 2).groupBy("mention").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
    rows = [one, records.agg(F.count(F.lit(1)).alias("records")), top.agg(F.count_if((F.col("n") > 1) & (F.col("low") == F.col("high"))).alias("ambiguous_names"))]
    cells = [d.select(F.inline(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("bigint").alias("value")) for c in d.columns]))) for d in rows]
    return cells[0].unionByName(cells[1]).unionByName(cells[2])
