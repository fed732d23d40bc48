"""Entity resolution: matching mentions to candidates, folding records into entities, clustering, splitting, dating and flagging them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from khayt.functions import scalars as S
from khayt.functions.similarity import ratio_udf, ratios, sifted, token_set_ratio
from khayt.operators.graph import components
from khayt.runtime import one_row, stored

# Words that join names and tell nobody apart.
CONNECTORS = ("بن", "ابن", "ابو", "ابي", "ام", "ال", "بنت", "عن")
KUNYA_MARKS, NASAB_MARKS = ("ابو", "ابي", "ام"), ("ابن", "بن")
DEATH_TOLERANCE, GROSS_SPREAD = 2, 50
GENERIC_MENTIONS, THIN_TOKENS = 50, 2
SPLIT_GAP, SPLIT_SUPPORT, SPLIT_MOST, MID_GAP = 80, 10, 6, 47
OUTLIER_GAP, AGREEMENT, NOISE_GAP = 25, 2, 10


# ---- matching

def exact_matches(mentions: DataFrame, candidates: DataFrame) -> DataFrame:
    """(mention, candidate, score, stage): the first candidate, by its place, with the mention's Arabic name, else with its English one in lower case.

    mentions: (mention, name_ar, name_en); candidates: (candidate, name_ar, name_en, seq). Two equi-joins, no order of rows relied on.
    """
    c = candidates.select("candidate", "seq", F.explode(F.array(F.struct(F.lit(0).alias("lang"), F.col("name_ar").alias("name")), F.struct(F.lit(1).alias("lang"), F.lower("name_en").alias("name")))).alias("x")).select("candidate", "seq", "x.*").where("name <> ''")
    c = c.groupBy("lang", "name").agg(F.min(F.struct("seq", "candidate")).alias("c"))
    m = mentions.select("mention", F.explode(F.array(F.struct(F.lit(0).alias("lang"), F.col("name_ar").alias("name")), F.struct(F.lit(1).alias("lang"), F.lower("name_en").alias("name")))).alias("x")).select("mention", "x.*").where("name <> ''")
    best = m.join(c, ["lang", "name"]).groupBy("mention").agg(F.min(F.struct("lang", "c.seq", "c.candidate")).alias("b"))
    return best.select("mention", F.col("b.candidate").alias("candidate"), F.lit(1.0).alias("score"), F.lit("exact").alias("stage"))


def _segments(name: Column, parts: int) -> Column:
    """struct(i, start, text) of a name cut into equal parts."""
    n = F.length(name)
    return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.struct(i.alias("i"), F.floor(n * i / parts).cast("int").alias("at"), F.substring(name, (F.floor(n * i / parts) + 1).cast("int"), (F.floor(n * (i + 1) / parts) - F.floor(n * i / parts)).cast("int")).alias("text")))


def near_names(left: DataFrame, right: DataFrame, most: int = 2, prefix: int = 2) -> DataFrame:
    """(a, b, distance): pairs of distinct names (columns ``a`` and ``b``) that begin alike and lie within ``most`` edits.

    Exact without comparing all names of a beginning: a name cut into most + 1 parts keeps one of them whole under so few edits, within as many places of where it was, so names
    are joined on such a part. A frequent beginning is no hot block. Names too short to be cut (at most ``most`` letters) are joined on their beginning with those of up to ``most``
    letters more; of so few letters there is only a bounded number.
    """
    begin = lambda c, letters=prefix: F.substring(c, 1, letters).alias("_p")
    near = F.levenshtein("a", "b", most) >= 0
    b = right.select("b").dropna().distinct().where(F.length("b") > most).select("b", begin("b"), F.length("b").alias("n"), F.inline(_segments(F.col("b"), most + 1)))
    lens = F.sequence(F.greatest(F.length("a") - most, F.lit(most + 1)), F.length("a") + most)
    # So many tasks whatever the bytes, as each name becomes many rows.
    tasks = max(2 * left.sparkSession.sparkContext.defaultParallelism, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    a = left.select("a").dropna().repartition(tasks, "a").distinct().where(F.length("a") >= 1)
    a = a.select("a", F.explode(lens).alias("n")).select("a", "n", F.explode(F.sequence(F.lit(0), F.lit(most))).alias("i"))
    start, stop = F.floor(F.col("n") * F.col("i") / (most + 1)), F.floor(F.col("n") * (F.col("i") + 1) / (most + 1))
    a = a.select("a", "n", "i", start.cast("int").alias("start"), (stop - start).cast("int").alias("size"), F.explode(F.sequence(F.lit(-most), F.lit(most))).alias("shift")).where("start + shift >= 0")
    a = a.select("a", begin("a"), "n", "i", F.expr("substring(a, start + shift + 1, size)").alias("text")).where(F.length("text") > 0)
    # Pairs are compared before they are made distinct: those that are too far apart, most of them, are never written.
    met = a.join(b.select("b", "_p", "n", "i", "text"), ["_p", "n", "i", "text"]).select("a", "b").where(near).distinct()
    short = right.select("b").dropna().distinct().where(F.length("b").between(1, most)).select("b", begin("b", min(prefix, 1)))
    few = left.select("a").dropna().distinct().where(F.length("a").between(1, 2 * most)).select("a", begin("a", min(prefix, 1))).join(short, "_p").select("a", "b").where(near)
    if prefix:
        few = few.where(F.substring("a", 1, prefix) == F.substring("b", 1, prefix))
    return met.unionByName(few).withColumn("distance", F.levenshtein("a", "b", most))


def fuzzy_matches(mentions: DataFrame, candidates: DataFrame, least: float = 80.0) -> DataFrame:
    """(mention, candidate, score, stage): the candidate with the best ratio among names within two edits and alike in their first two letters; the first among equals."""
    near = near_names(mentions.select(F.col("name_ar").alias("a")), candidates.select(F.col("name_ar").alias("b"))).withColumn("ratio", ratio_udf("a", "b")).where(F.col("ratio") >= least)
    met = mentions.select("mention", F.col("name_ar").alias("a")).join(near, "a").join(candidates.select("candidate", "seq", F.col("name_ar").alias("b")), "b")
    best = met.groupBy("mention").agg(F.min(F.struct((-F.col("ratio")).alias("r"), "seq", "candidate")).alias("x"))
    return best.select("mention", F.col("x.candidate").alias("candidate"), (-F.col("x.r") / 100).alias("score"), F.lit("fuzzy").alias("stage"))


#: Names of a pack; packs of names with one beginning meet as a whole, so that a pair of names is no row.
PACK = 1024


def _packs(names: DataFrame, name: str) -> DataFrame:
    """(p, pack, names): distinct names by their first two letters, cut by their hash into packs."""
    n = names.select(name).dropna().distinct().withColumn("p", F.substring(name, 1, 2))
    cut = n.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / PACK).alias("_n"))
    return n.join(cut, "p").groupBy("p", F.pmod(F.xxhash64(name), "_n").alias(f"pack_{name}")).agg(F.collect_list(name).alias(f"{name}s"))


def likest_names(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b, ratio): of each name ``a`` the names ``b`` alike in the first two letters that have the best ratio in their pack, if it is enough; so the best of all are among them."""
    spark = left.sparkSession
    met = _packs(left, "a").join(_packs(right, "b"), "p")
    tasks = max(8 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(c)[i].values for c in ("as", "bs"))
                r = ratios(a.to_pylist(), b.to_pylist())
                x, y = np.nonzero((r >= least) & (r == r.max(axis=1, keepdims=True)))
                yield pa.RecordBatch.from_arrays([a.take(pa.array(x)), b.take(pa.array(y)), pa.array(r[x, y])], names=["a", "b", "ratio"])

    # So many tasks whatever the bytes: the work is in the pairs, which are many for few bytes.
    return met.repartition(tasks, "p", "pack_a", "pack_b").select("as", "bs").mapInArrow(work, "a string, b string, ratio double")


def crossref_matches(mentions: DataFrame, candidates: DataFrame, least: float = 60.0) -> DataFrame:
    """As fuzzy, among the candidates with an external id, at a lower ratio and any distance, within the block of the first two letters."""
    known = candidates.where("external_id is not null").select("candidate", "seq", F.col("name_ar").alias("b"))
    near = likest_names(mentions.select(F.col("name_ar").alias("a")), known, least)
    met = mentions.select("mention", F.col("name_ar").alias("a")).join(near, "a").join(known, "b")
    best = met.groupBy("mention").agg(F.min(F.struct((-F.col("ratio")).alias("r"), "seq", "candidate")).alias("x"))
    return best.select("mention", F.col("x.candidate").alias("candidate"), (-F.col("x.r") / 100).alias("score"), F.lit("crossref").alias("stage"))


def temporal_ok(year: Column, adjacent: Column, least: int = 15, most: int = 80) -> Column:
    """A candidate without a year passes, as does one with some adjacent year at a plausible distance."""
    return year.isNull() | (F.size(F.coalesce(adjacent, F.array().cast("array<int>"))) == 0) | F.exists(adjacent, lambda x: F.abs(year - x).between(least, most))


def adjacent_years(rows: DataFrame, group: Sequence[str], position: str, year: str) -> DataFrame:
    """All columns with ``adjacent``: the years found at the positions just before and after in the same chain."""
    w = Window.partitionBy(*group).orderBy(position).rangeBetween(-1, 1)
    own = F.struct(F.col(position).alias("p"), F.col(year).alias("y"))
    got = F.collect_list(F.when(F.col(year).isNotNull(), own)).over(w)
    return rows.withColumn("adjacent", F.array_sort(F.transform(F.filter(got, lambda x: x["p"] != F.col(position)), lambda x: x["y"])))


def accepted(matches: DataFrame, ok: Column, least: float = 0.70) -> DataFrame:
    """(mention, candidate, score, stage) of the stage that comes first: exact, fuzzy, crossref; only at a sufficient score and where the evidence is not against it."""
    order = F.when(F.col("stage") == "exact", 0).when(F.col("stage") == "fuzzy", 1).otherwise(2)
    best = matches.where((F.col("score") >= least) & ok).groupBy("mention").agg(F.min(F.struct(order.alias("o"), (-F.col("score")).alias("s"), "candidate", "stage")).alias("x"))
    return best.select("mention", "x.candidate", (-F.col("x.s")).alias("score"), "x.stage")


def top_candidates(matches: DataFrame, k: int = 3) -> DataFrame:
    """(mention, place, candidate, score): the k best distinct candidates of each mention."""
    one = matches.groupBy("mention", "candidate").agg(F.max("score").alias("score"))
    w = Window.partitionBy("mention").orderBy(F.desc("score"), "candidate")
    return one.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def first_wins(rows: DataFrame, key: str, seq: Sequence[str], scalars: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """One record per key: the first value of each scalar that is not null, the arrays' elements in order of first sight, the number of rows; one aggregation."""
    at = F.struct(*seq)
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c) for c in scalars]
    for c in arrays:
        listed = F.array_sort(F.collect_set(F.when(F.col(c).isNotNull(), F.struct(at.alias("s"), F.col(c).alias("v")))))
        aggs.append(F.array_distinct(F.flatten(F.transform(listed, lambda x: x["v"]))).alias(c))
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs, F.count(F.lit(1)).alias("records"))


def promote(existing: DataFrame, new: DataFrame, key: str, scalars: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """Full outer merge: existing values win, new ones fill nulls, arrays are joined; ``promoted`` marks keys that only the new side has."""
    n = new.select(key, *[F.col(c).alias(f"_{c}") for c in (*scalars, *arrays)], F.lit(True).alias("_in"))
    met = existing.withColumn("_had", F.lit(True)).join(n, key, "full")
    empty = F.array().cast("array<string>")
    return met.select(key, *[F.coalesce(c, f"_{c}").alias(c) for c in scalars], *[F.array_distinct(F.concat(F.coalesce(c, empty), F.coalesce(f"_{c}", empty))).alias(c) for c in arrays], F.col("_had").isNull().alias("promoted"))


def remap(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """An id column rewritten by (old_id, new_id); ids that are not in the map stay."""
    m = ids.select(F.col("old_id").alias(column), F.col("new_id").alias("_new"))
    return rows.join(m, column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


# ---- clustering

def significant_tokens(names: Column) -> Column:
    """Distinct words of at least two letters of an array of names, joining words left out."""
    words = F.flatten(F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda n: F.split(F.coalesce(n, F.lit("")), " ")))
    return F.array_distinct(F.filter(words, lambda t: (F.length(t) >= 2) & ~t.isin(*CONNECTORS)))


def is_generic(name: Column, mentions: Column) -> Column:
    """Whether a name is so thin and so frequent that it may hide several persons."""
    words = F.split(F.trim(F.coalesce(name, F.lit(""))), " ")
    kunya = F.get(words, F.lit(0)).isin(*KUNYA_MARKS) & ~F.exists(words, lambda t: t.isin(*NASAB_MARKS))
    return F.coalesce((F.trim(name) != "") & (mentions >= GENERIC_MENTIONS) & (F.size(significant_tokens(F.array(name))) <= THIN_TOKENS) & ((F.size(words) <= 2) | kunya), F.lit(False))


def candidate_pairs(records: DataFrame, max_block: int = 250) -> DataFrame:
    """(a, b): records (id, keys) that share at least two significant words, by blocks of word pairs; blocks of more than ``max_block`` records, which tell nobody apart, are passed over.

    All words of a record count, however many it has; its word pairs are unrolled a word at a time, so that no row holds all of them.
    """
    words = F.array_sort(F.array_distinct(F.flatten(F.collect_list(significant_tokens(F.col("keys"))))))
    heads = records.groupBy("id").agg(words.alias("w")).select("id", "w", F.posexplode("w").alias("i", "x"))
    pairs = heads.select("id", "x", F.explode(F.slice("w", F.col("i") + 2, F.size("w"))).alias("y"))
    pairs = stored(pairs, "blocks")
    size = pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).where(F.col("n").between(2, max_block)).select("x", "y")
    live = pairs.join(size, ["x", "y"], "left_semi")
    return live.select("x", "y", F.col("id").alias("a")).join(live.select("x", "y", F.col("id").alias("b")), ["x", "y"]).where("a < b").select("a", "b").distinct()


def order_kept(a: Column, b: Column) -> Column:
    """Whether the significant words two names share stand in the same order in both."""
    def words(n: Column) -> Column:
        return F.filter(F.split(n, " "), lambda t: (F.length(t) >= 2) & ~t.isin(*CONNECTORS))

    x, y = words(a), words(b)
    shared = F.array_intersect(x, y)
    return (F.size(shared) < 2) | (F.filter(x, lambda t: F.array_contains(y, t)) == F.filter(y, lambda t: F.array_contains(x, t)))


def _order_kept(a: str, b: str) -> bool:
    """``order_kept`` of two texts."""
    x, y = ([t for t in n.split(" ") if len(t) >= 2 and t not in CONNECTORS] for n in (a, b))
    in_x, in_y = set(x), set(y)
    return len(in_x & in_y) < 2 or [t for t in x if t in in_y] == [t for t in y if t in in_x]


def mergeable(records: DataFrame, pairs: DataFrame, least: float = 90.0) -> DataFrame:
    """(a, b) of the pairs whose records (id, keys, death_year, provenance, gender) may be one person: no conflict of years or gender, and some pair of names alike with its words in the same order."""
    side = {x: records.select(*[F.col(c).alias(f"{c}_{x}") for c in ("id", "keys", "death_year", "provenance", "gender")]).withColumnRenamed(f"id_{x}", x) for x in "ab"}
    met = pairs.join(side["a"], "a").join(side["b"], "b")
    weak = (F.col("provenance_a") == "uncorroborated") | (F.col("provenance_b") == "uncorroborated")
    limit = F.when(F.coalesce(weak, F.lit(False)), GROSS_SPREAD).otherwise(DEATH_TOLERANCE)
    years = F.coalesce(F.abs(F.col("death_year_a") - F.col("death_year_b")) > limit, F.lit(False))
    genders = F.coalesce((F.col("gender_a") != "") & (F.col("gender_b") != "") & (F.col("gender_a") != F.col("gender_b")), F.lit(False))
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(c) for c in ("keys_a", "keys_b")]
            coded = pa.concat_arrays([k.flatten() for k in keys]).dictionary_encode()
            names, code = coded.dictionary.to_pylist(), coded.indices.fill_null(-1).to_numpy()
            n, m = (k.value_lengths().fill_null(0).to_numpy().astype(np.int64) for k in keys)
            row = np.repeat(np.arange(len(n)), n * m)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n * m) - n * m, n * m)
            x, y = code[(np.cumsum(n) - n)[row] + at // m[row]], code[n.sum() + (np.cumsum(m) - m)[row] + at % m[row]]
            there = (x >= 0) & (y >= 0)
            row, x, y = row[there], x[there], y[there]
            may = sifted(names, x, y, least)
            alike, found = {}, set()
            for r, i, j in zip(row[may].tolist(), x[may].tolist(), y[may].tolist(), strict=True):
                if r not in found:
                    if (i, j) not in alike:
                        alike[i, j] = token_set_ratio(names[i], names[j]) >= least and _order_kept(names[i], names[j])
                    if alike[i, j]:
                        found.add(r)
            yield batch.select(["a", "b"]).take(pa.array(sorted(found), pa.int64()))

    return met.where(~years & ~genders).select("a", "b", "keys_a", "keys_b").mapInArrow(work, "a string, b string").distinct()


def safe_groups(records: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, group_id): each component of mergeable pairs cut into groups within which every two records may merge; records join, in the order of their ids, the first group that all of suits."""
    edges = stored(pairs, "mergeable")
    comp = components(edges.select(F.col("a").alias("from_id"), F.col("b").alias("to_id")))
    rows = edges.join(comp.select(F.col("id").alias("a"), "component"), "a").groupBy("component").applyInPandas(_cliques, "id string, group_id string")
    alone = records.select("id").join(rows, "id", "left_anti")
    return rows.unionByName(alone.select("id", F.col("id").alias("group_id")))


def _cliques(frame: pd.DataFrame) -> pd.DataFrame:
    friends: dict[str, set[str]] = {}
    for a, b in zip(frame["a"], frame["b"], strict=True):
        friends.setdefault(a, set()).add(b)
        friends.setdefault(b, set()).add(a)
    group: dict[str, str] = {}
    members: dict[str, list[str]] = {}
    for x in sorted(friends):
        # Only groups of friends can suit; they are tried in the order in which they were opened.
        for g in sorted({group[y] for y in friends[x] if y in group}):
            if all(y in friends[x] for y in members[g]):
                break
        else:
            g, members[x] = x, []
        group[x] = g
        members[g].append(x)
    return pd.DataFrame({"id": list(group), "group_id": list(group.values())})


def representatives(records: DataFrame, groups: DataFrame, complete: Sequence[str]) -> DataFrame:
    """(group_id, representative): the record with most mentions, then most fields filled, then the longest name, then the smallest id."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in complete), F.lit(0))
    rank = F.struct((-F.coalesce("mention_count", F.lit(0))).alias("m"), (-filled).alias("f"), (-F.coalesce(F.length("name"), F.lit(0))).alias("l"), F.col("id").alias("id"))
    return records.join(groups, "id").groupBy("group_id").agg(F.min(rank).alias("r")).select("group_id", F.col("r.id").alias("representative"))


def merge_groups(records: DataFrame, groups: DataFrame, chosen: DataFrame, scalars: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """One record per group under its representative's id: that record's values, filled from the others in the order of their ids; mentions summed, arrays joined."""
    met = records.join(groups, "id").join(chosen, "group_id")
    met = met.withColumn("_at", (F.col("id") != F.col("representative")).cast("int"))
    out = first_wins(met, "representative", ["_at", "id"], scalars, arrays)
    counts = met.groupBy("representative").agg(F.sum(F.coalesce("mention_count", F.lit(0))).alias("mention_count"))
    return out.join(counts, "representative").withColumnRenamed("representative", "id")


def pair_quality(truth: DataFrame, found: DataFrame) -> DataFrame:
    """(true_pairs, found_pairs, both, precision, recall, f1) of a clustering (id, label) against the true one, by counts of label cells, never by pairs."""
    def pairs(df: DataFrame, *by: str) -> DataFrame:
        n = F.count(F.lit(1))
        return df.groupBy(*by).agg((n * (n - 1) / 2).alias("p")).agg(F.coalesce(F.sum("p"), F.lit(0.0)).alias("p"))

    met = truth.select("id", F.col("label").alias("t")).join(found.select("id", F.col("label").alias("f")), "id")
    t, f, b = pairs(truth.select("label"), "label"), pairs(found.select("label"), "label"), pairs(met, "t", "f")
    row = one_row(t.select(F.col("p").alias("true_pairs")), f.select(F.col("p").alias("found_pairs")), b.select(F.col("p").alias("both")))
    row = row.withColumn("precision", F.coalesce(F.try_divide("both", "found_pairs"), F.lit(1.0))).withColumn("recall", F.coalesce(F.try_divide("both", "true_pairs"), F.lit(1.0)))
    return row.withColumn("f1", F.coalesce(F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))


# ---- splitting and contexts

def death_estimates(chain: DataFrame, years: DataFrame) -> DataFrame:
    """(mention, person, estimate): a death year for each mention from its neighbours': the one before plus, the one after less, half a transmission's span; their mean if both are known.

    chain: (mention, person, previous, following); years: (person, year).
    """
    y = years.where("year is not null").groupBy("person").agg(F.min("year").alias("year"))
    met = chain.join(y.select(F.col("person").alias("previous"), F.col("year").alias("py")), "previous", "left").join(y.select(F.col("person").alias("following"), F.col("year").alias("fy")), "following", "left")
    both = F.array_compact(F.array(F.col("py") + MID_GAP, F.col("fy") - MID_GAP))
    mean = F.aggregate(both, F.lit(0.0), lambda a, x: a + x) / F.size(both)
    return met.where(F.size(both) > 0).select("mention", "person", S.clamp_death(F.bround(mean).cast("int")).alias("estimate"))


def split_plan(estimates: DataFrame) -> DataFrame:
    """(person, band, mentions, midpoint, earliest, latest, label, role): the bands of a person's estimates that qualify, and whether they stay or peel.

    Bands open at gaps; those with enough mentions qualify; a person with too many is noise; bands out of every generation's window fall out; with two or more left, the largest stays (the earliest
    among equals) and the others peel.
    """
    w = Window.partitionBy("person").orderBy("estimate", "mention")
    cut = estimates.withColumn("_o", F.when(F.col("estimate") - F.lag("estimate").over(w) > SPLIT_GAP, 1).otherwise(0))
    cut = cut.withColumn("band", F.sum("_o").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    b = cut.groupBy("person", "band").agg(F.count(F.lit(1)).alias("mentions"), F.bround(F.avg("estimate")).cast("int").alias("midpoint"), F.min("estimate").alias("earliest"), F.max("estimate").alias("latest")).where(F.col("mentions") >= SPLIT_SUPPORT)
    windows = [F.col("midpoint").between(lo, hi) for lo, hi in S.GENERATIONS.values()]
    count = sum((x.cast("int") for x in windows), F.lit(0))
    label = F.concat(F.lit("d:"), F.floor(F.col("midpoint") / 25).cast("int") * 25)
    for lo, hi in S.GENERATIONS.values():
        label = F.when((count == 1) & F.col("midpoint").between(lo, hi), f"d:{lo}-{hi}").otherwise(label)
    p = Window.partitionBy("person")
    b = b.withColumn("_n", F.count(F.lit(1)).over(p)).where(F.col("_n") <= SPLIT_MOST).where(count > 0).withColumn("_k", F.count(F.lit(1)).over(p)).where("_k >= 2")
    place = F.row_number().over(p.orderBy(F.desc("mentions"), "midpoint"))
    return b.select("person", "band", "mentions", "midpoint", "earliest", "latest", label.alias("label"), F.when(place == 1, "stays").otherwise("peels").alias("role"))


def contextual_matches(mentions: DataFrame, signatures: DataFrame) -> DataFrame:
    """(mention, signature): mentions (mention, name, previous_name, following_name) that fit exactly one signature (signature, name, teacher, student) of their bare name; a null there asks nothing.

    Signatures are a curated table; they meet mentions on the name.
    """
    s = signatures.select("signature", "name", "teacher", "student")
    met = mentions.join(s, "name").where((F.col("teacher").isNull() | (F.col("teacher") == F.col("previous_name"))) & (F.col("student").isNull() | (F.col("student") == F.col("following_name"))))
    return met.groupBy("mention").agg(F.min("signature").alias("signature"), F.count_distinct("signature").alias("n")).where("n = 1").select("mention", "signature")


def contextual_coverage(mentions: DataFrame, matched: DataFrame, signatures: DataFrame) -> DataFrame:
    """(name, mentions, matched): how many mentions of each bare name with signatures found one."""
    m = mentions.join(signatures.select("name").distinct(), "name", "left_semi").join(matched.withColumn("hit", F.lit(1)), "mention", "left")
    return m.groupBy("name").agg(F.count(F.lit(1)).alias("mentions"), F.count("hit").alias("matched"))


def refine_mononyms(mentions: DataFrame, registry: DataFrame) -> DataFrame:
    """(mention, person): bare names (mention, name, adjacent) that one person of the registry (person, name, death_year) alone fits in time."""
    met = mentions.join(registry, "name").where(temporal_ok(F.col("death_year"), F.col("adjacent")))
    return met.groupBy("mention").agg(F.min("person").alias("person"), F.count_distinct("person").alias("n")).where("n = 1").select("mention", "person")


# ---- dates

def reconcile_dates(seen: DataFrame) -> DataFrame:
    """(person, point, earliest, latest, precision, sources, conflict) from observations (person, point, earliest, latest, precision).

    Years on which sources agree span a band (a lone outlier dropped where there are three or more); bounds widen it unless years compete, open bounds clip it; the point is the most
    frequent year in it, the earliest among equals. Persons dated by open bounds only get these. Aggregations only, in three passes.
    """
    o = seen.where("person is not null and (point is not null or earliest is not null or latest is not null)").withColumn(
        "kind", F.when((F.col("precision") == "after") & F.coalesce("earliest", "point").isNotNull(), "after").when((F.col("precision") == "before") & F.coalesce("latest", "point").isNotNull(), "before").otherwise("closed")
    )
    o = stored(o.select("person", "kind", "precision", F.when(F.col("kind") == "closed", F.coalesce("point", "earliest", "latest")).alias("p"), F.when(F.col("kind") == "before", None).otherwise(F.coalesce("earliest", "point")).alias("lo"), F.when(F.col("kind") == "after", None).otherwise(F.coalesce("latest", "point")).alias("hi")), "seen")
    mid = o.where("p is not null").groupBy("person").agg(F.percentile("p", F.lit(0.5)).alias("median"), F.count("p").alias("n"), F.min("p").alias("p_min"), F.max("p").alias("p_max"))
    near = F.abs(F.col("p") - F.col("median")) <= OUTLIER_GAP
    core = o.join(mid, "person").where("p is not null").groupBy("person", "n", "p_min", "p_max").agg(F.min(F.when(near, F.col("p"))).alias("c_lo"), F.max(F.when(near, F.col("p"))).alias("c_hi"), F.count_if(near).alias("k"))
    drop = (F.col("n") > 2) & (F.col("k") >= 2)
    core = stored(core.select("person", "p_min", "p_max", F.when(drop, F.col("c_lo")).otherwise(F.col("p_min")).alias("b_lo"), F.when(drop, F.col("c_hi")).otherwise(F.col("p_max")).alias("b_hi")), "bands")
    band = o.where("kind = 'closed'").join(core, "person").where(F.col("p").between(F.col("b_lo") - AGREEMENT, F.col("b_hi") + AGREEMENT))
    competing = F.count_distinct("p") > 1
    wide = band.groupBy("person", "b_lo", "b_hi", "p_min", "p_max").agg(
        competing.alias("competing"), F.min("lo").alias("any_lo"), F.max("hi").alias("any_hi"), F.min(F.when(F.col("b_lo") - F.col("lo") <= NOISE_GAP, F.col("lo"))).alias("near_lo"), F.max(F.when(F.col("hi") - F.col("b_hi") <= NOISE_GAP, F.col("hi"))).alias("near_hi"),
        F.min(F.col("precision") == "circa").alias("circa"),
    )
    lo = F.least("b_lo", F.when(F.col("competing"), F.col("near_lo")).otherwise(F.col("any_lo")))
    hi = F.greatest("b_hi", F.when(F.col("competing"), F.col("near_hi")).otherwise(F.col("any_hi")))
    wide = wide.select("person", "p_min", "p_max", lo.alias("lo0"), hi.alias("hi0"), "circa")
    opened = o.where("kind <> 'closed'").groupBy("person").agg(F.max("lo").alias("a_max"), F.min("hi").alias("b_min"))
    # Lower bounds clip the band first; an upper bound counts only within what they leave, so that no band ends before it begins.
    clip = o.where("kind <> 'closed'").select("person", F.col("lo").alias("a"), F.col("hi").alias("b")).join(wide.select("person", "lo0", "hi0"), "person")
    low = F.max(F.when(F.col("a").between(F.col("lo0"), F.col("hi0")), F.col("a"))).over(Window.partitionBy("person"))
    clip = clip.withColumn("lo", F.coalesce(low, "lo0")).groupBy("person").agg(F.max("lo").alias("lo"), F.min(F.when(F.col("b").between(F.col("lo"), F.col("hi0")), F.col("b"))).alias("b_in"))
    closed = wide.join(clip, "person", "left").select("person", "p_min", "p_max", F.coalesce("lo", "lo0").alias("lo"), F.coalesce("b_in", "hi0").alias("hi"), "circa")
    votes = band.select("person", "p").join(closed.select("person", "lo", "hi"), "person").where(F.col("p").between(F.col("lo"), F.col("hi"))).groupBy("person", "p").agg(F.count(F.lit(1)).alias("v"))
    mode = votes.groupBy("person").agg(F.min(F.struct((-F.col("v")).alias("v"), "p")).alias("x")).select("person", F.col("x.p").alias("mode"))
    total = o.groupBy("person").agg(F.count(F.lit(1)).alias("sources"))
    met = total.join(closed, "person", "left").join(mode, "person", "left").join(opened, "person", "left")
    is_closed, a, b = F.col("lo").isNotNull(), F.col("a_max"), F.col("b_min")
    precision = (
        F.when(is_closed & F.col("circa"), "circa").when(is_closed & (F.col("lo") == F.col("hi")), "exact").when(is_closed, "range")
        .when(a.isNotNull() & b.isNotNull() & (a == b), "exact").when(a.isNotNull() & b.isNotNull() & (a < b), "range").when(a.isNotNull(), "after").when(b.isNotNull(), "before").otherwise("unknown")
    )
    return met.select(
        "person", F.when(is_closed, F.coalesce("mode", F.floor((F.col("lo") + F.col("hi")) / 2).cast("int"))).otherwise(F.coalesce(a, b)).alias("point"),
        F.when(is_closed, F.col("lo")).otherwise(a).alias("earliest"), F.when(is_closed, F.col("hi")).when(a.isNotNull() & b.isNotNull() & (a > b), None).otherwise(b).alias("latest"),
        precision.alias("precision"), "sources", F.when(is_closed, F.col("p_max") - F.col("p_min") > AGREEMENT).otherwise(F.coalesce(a > b, F.lit(False))).alias("conflict"),
    )


def fill_generation_dates(records: DataFrame) -> DataFrame:
    """Deaths that are wholly undated take the window of the record's generation; all others stay."""
    dated = F.coalesce("death_year_ah", "death_year_ah_earliest", "death_year_ah_latest").isNotNull() | ~F.coalesce("death_date_precision", F.lit("")).isin("", "unknown")
    w = S.generation_window(F.col("generation"))
    fill = ~dated & w.isNotNull()
    out = records.withColumn("_w", w).withColumn("_f", fill)
    for c, f in (("death_year_ah", "point"), ("death_year_ah_earliest", "earliest"), ("death_year_ah_latest", "latest")):
        out = out.withColumn(c, F.when(F.col("_f"), F.col(f"_w.{f}")).otherwise(F.col(c)))
    return out.withColumn("death_date_precision", F.when(F.col("_f"), "tabaqa_estimate").otherwise(F.col("death_date_precision"))).drop("_w", "_f")


# ---- unification and flags

def neighbour_overlap(chain: DataFrame, pairs: DataFrame, k: int = 20) -> DataFrame:
    """(a, b, overlap): shared share of the k most frequent neighbours of two persons, by the smaller of their counts. chain: (person, previous, following); pairs: (a, b)."""
    both = chain.select("person", F.explode(F.array("previous", "following")).alias("x")).where("x is not null")
    n = both.groupBy("person", "x").agg(F.count(F.lit(1)).alias("n"))
    top = n.withColumn("r", F.row_number().over(Window.partitionBy("person").orderBy(F.desc("n"), "x"))).where(F.col("r") <= k).groupBy("person").agg(F.collect_set("x").alias("xs"))
    met = pairs.join(top.select(F.col("person").alias("a"), F.col("xs").alias("xa")), "a", "left").join(top.select(F.col("person").alias("b"), F.col("xs").alias("xb")), "b", "left")
    empty = F.array().cast("array<string>")
    xa, xb = F.coalesce("xa", empty), F.coalesce("xb", empty)
    return met.select("a", "b", F.coalesce(F.try_divide(F.size(F.array_intersect(xa, xb)), F.least(F.size(xa), F.size(xb))), F.lit(0.0)).alias("overlap"))


def unify(seeds: DataFrame, records: DataFrame, flagged: DataFrame, overlap: DataFrame, least_overlap: float = 0.3) -> DataFrame:
    """(seed, verdict): which seeds (seed, member) may be unified, or why not: too few members on record, a flagged member, conflicting years, a wide spread, conflicting genders, no shared context."""
    m = seeds.join(records.select(F.col("id").alias("member"), "death_year", "provenance", "gender"), "member").join(flagged.select(F.col("id").alias("member"), F.lit(True).alias("flag")), "member", "left")
    sure = F.when(F.col("provenance") == "corroborated", F.col("death_year"))
    g = m.groupBy("seed").agg(
        F.count_distinct("member").alias("n"), F.max("flag").alias("flag"), (F.max(sure) - F.min(sure)).alias("sure"), (F.max("death_year") - F.min("death_year")).alias("spread"),
        F.count_distinct(F.when(F.col("gender").isin("male", "female"), F.col("gender"))).alias("genders"), F.min("member").alias("a"), F.max("member").alias("b"),
    )
    g = g.join(overlap, ["a", "b"], "left")
    verdict = (
        F.when(F.col("n") < 2, "too_few").when(F.col("flag"), "flagged").when(F.coalesce(F.col("sure") > DEATH_TOLERANCE, F.lit(False)), "years").when(F.coalesce(F.col("spread") > GROSS_SPREAD, F.lit(False)), "spread")
        .when(F.col("genders") > 1, "gender").when(F.coalesce("overlap", F.lit(0.0)) < least_overlap, "context").otherwise("unify")
    )
    return seeds.select("seed").distinct().join(g, "seed", "left").select("seed", F.coalesce(verdict, F.lit("too_few")).alias("verdict"))


def flag_over_merged(records: DataFrame, rules: DataFrame) -> DataFrame:
    """Records (id, ..) with over_merged and over_merge_note from a curated table (id, note)."""
    return records.join(rules.select("id", F.col("note").alias("over_merge_note")).dropDuplicates(["id"]), "id", "left").withColumn("over_merged", F.col("over_merge_note").isNotNull())


def curated_links(rows: DataFrame, records: DataFrame) -> DataFrame:
    """Curated mention links whose person is on record."""
    return rows.join(records.select(F.col("id").alias("person")), "person", "left_semi")
