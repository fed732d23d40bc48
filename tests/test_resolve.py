import itertools
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from khayt.functions import places
from khayt.functions.similarity import token_set_ratio
from khayt.operators import parallels as P
from khayt.operators import resolve as R


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_near_names_loses_none(spark):
    rnd = random.Random(4)
    names = list({"".join(rnd.choice("abc") for _ in range(rnd.randrange(3, 9))) for _ in range(60)}) + ["ab" * 40, "ab" * 40 + "c", "ab", "ac", "a", "b", "abca"]
    df = spark.createDataFrame([(n,) for n in names], "a string")
    got = R.near_names(df, df.withColumnRenamed("a", "b"), 2, 2)
    assert rows(got) == sorted(((a, b, edits(a, b)) for a in names for b in names if a[:2] == b[:2] and edits(a, b) <= 2), key=str)


def test_matching_stages(spark):
    m = spark.createDataFrame([("m1", "مالك بن انس", None), ("m2", None, "Malik"), ("m3", "مالك بن انسس", None), ("m4", "لا احد", None)], "mention string, name_ar string, name_en string")
    c = spark.createDataFrame([("c2", "مالك بن انس", "MALIK", "2", "x", 179), ("c1", "مالك بن انس", "other", "1", None, 179)], "candidate string, name_ar string, name_en string, seq string, external_id string, death_year int")
    exact = R.exact_matches(m, c)
    assert rows(exact.select("mention", "candidate")) == [("m1", "c1"), ("m2", "c2")]
    every = exact.unionByName(R.fuzzy_matches(m, c)).unionByName(R.crossref_matches(m, c))
    got = {r["mention"]: (r["candidate"], r["stage"]) for r in R.accepted(every, F.lit(True)).collect()}
    assert got["m1"] == ("c1", "exact") and got["m3"] == ("c1", "fuzzy") and "m4" not in got
    assert R.top_candidates(every).where("place = 1 and mention = 'm1'").count() == 1


def test_evidence(spark):
    d = spark.createDataFrame([(100, [150]), (100, [101]), (None, [1]), (100, []), (100, None)], "y int, adj array<int>")
    assert [r[0] for r in d.select(R.temporal_ok(F.col("y"), F.col("adj"))).collect()] == [True, False, True, True, True]
    z = spark.createDataFrame([("andalus", "khurasan"), ("andalus", "hijaz"), ("x", "fars"), ("egypt", "iraq")], "a string, b string")
    assert [r[0] for r in z.select(places.travel_ok(F.col("a"), F.col("b"))).collect()] == [False, True, True, True]
    a = spark.createDataFrame([("h", 0, 10), ("h", 1, None), ("h", 2, 30), ("h", 4, 50)], "h string, p int, y int")
    assert {r["p"]: r["adjacent"] for r in R.adjacent_years(a, ["h"], "p", "y").collect()} == {0: [], 1: [10, 30], 2: [], 4: []}


def test_folds(spark):
    d = spark.createDataFrame([("a", 2, "y", ["q"], 1), ("a", 1, None, ["p", "q"], 2), (None, 1, "z", None, 3), ("b", 1, None, None, 4)], "k string, s int, v string, xs array<string>, extra int")
    assert rows(R.first_wins(d, "k", ["s"], ["v"], ["xs"])) == [("a", "y", ["p", "q"], 2), ("b", None, [], 1)]
    got = R.promote(d.where("s = 2").select("k", "v", "xs"), d.where("s = 1 and k is not null").select("k", "v", "xs"), "k", ["v"], ["xs"])
    assert rows(got) == [("a", "y", ["q", "p"], False), ("b", None, [], True)]
    ids = spark.createDataFrame([("a", "z")], "old_id string, new_id string")
    assert rows(R.remap(d.select("k", "s"), ids, "k")) == [("b", 1), ("z", 1), ("z", 2), (None, 1)]


GOLD = [("1", "محمد بن اسماعيل البخاري"), ("2", "محمد بن اسماعيل بن ابراهيم البخاري"), ("3", "اسماعيل بن محمد البخاري"), ("4", "محمد بن عيسي الترمذي"), ("5", "محمد بن عيسي بن سوره الترمذي"), ("6", "مالك")]


def test_clusters_on_gold(spark):
    r = spark.createDataFrame([(i, [n], None, None, None) for i, n in GOLD], "id string, keys array<string>, death_year int, provenance string, gender string")
    groups = {x["id"]: x["group_id"] for x in R.safe_groups(r, R.mergeable(r, R.candidate_pairs(r))).collect()}
    assert groups["1"] == groups["2"] and groups["4"] == groups["5"] and len(set(groups.values())) == 4
    apart = r.withColumn("death_year", F.when(F.col("id") == "1", 256).when(F.col("id") == "2", 300))
    assert {x["id"]: x["group_id"] for x in R.safe_groups(apart, R.mergeable(apart, R.candidate_pairs(apart))).collect()}["2"] == "2"
    assert R.candidate_pairs(r.limit(0)).count() == 0


def test_candidate_pairs_of_records_with_many_words(spark):
    # 70 words in the first name, so the shared ones of another name come after the 64th of those kept by name.
    own, shared = " ".join(f"w{i:03}" for i in range(70)), "zz1 zz2"
    r = spark.createDataFrame([("a", [own, shared]), ("b", [shared]), ("c", ["zz1"])], "id string, keys array<string>")
    assert rows(R.candidate_pairs(r)) == [("a", "b")]


def test_cliques_are_cliques():
    import pandas as pd

    rnd = random.Random(1)
    for _ in range(30):
        pairs = [p for p in itertools.combinations("abcdefgh", 2) if rnd.random() < 0.5]
        if not pairs:
            continue
        got = R._cliques(pd.DataFrame(pairs, columns=["a", "b"])).set_index("id")["group_id"].to_dict()
        friends = {frozenset(p) for p in pairs}
        for x, y in itertools.combinations(got, 2):
            assert got[x] != got[y] or frozenset((x, y)) in friends


def test_quality(spark):
    t = spark.createDataFrame([(i, i // 3) for i in range(9)], "id int, label int")
    f = spark.createDataFrame([(i, i // 2) for i in range(9)], "id int, label int")
    same = lambda k: {(a, b) for a, b in itertools.combinations(range(9), 2) if a // k == b // k}
    r = R.pair_quality(t, f).first()
    assert (r["true_pairs"], r["found_pairs"], r["both"]) == (len(same(3)), len(same(2)), len(same(3) & same(2)))


def test_split_plan(spark):
    e = [("p", f"a{i}", 100) for i in range(12)] + [("p", f"b{i}", 300) for i in range(10)] + [("p", f"c{i}", 210) for i in range(3)] + [("q", f"d{i}", 100) for i in range(30)]
    got = {(r["person"], r["midpoint"]): (r["role"], r["label"], r["mentions"]) for r in R.split_plan(spark.createDataFrame(e, "person string, mention string, estimate int")).collect()}
    assert got[("p", 100)][0] == "stays" and got[("p", 300)][0] == "peels" and not any(k[0] == "q" for k in got)
    chain = spark.createDataFrame([("m", "p", "t", "s"), ("n", "p", None, "s"), ("o", "p", None, None)], "mention string, person string, previous string, following string")
    years = spark.createDataFrame([("t", 100), ("s", 201)], "person string, year int")
    assert rows(R.death_estimates(chain, years)) == [("m", "p", 150), ("n", "p", 154)]


def reconcile(obs):
    """The rules, one person at a time."""
    closed, after, before = [], [], []
    for p, lo, hi, prec in obs:
        if p is None and lo is None and hi is None:
            continue
        if prec == "after" and (lo if lo is not None else p) is not None:
            after.append(lo if lo is not None else p)
        elif prec == "before" and (hi if hi is not None else p) is not None:
            before.append(hi if hi is not None else p)
        else:
            q = next(x for x in (p, lo, hi) if x is not None)
            closed.append((q, lo if lo is not None else p, hi if hi is not None else p, prec))
    n = len(closed) + len(after) + len(before)
    if not n:
        return None
    if not closed:
        a, b = max(after, default=None), min(before, default=None)
        if a is not None and b is not None:
            return (a, a, b, "exact" if a == b else "range", n, False) if a <= b else (a, a, None, "after", n, True)
        return (a, a, None, "after", n, False) if a is not None else (b, None, b, "before", n, False)
    pts = sorted(c[0] for c in closed)
    core = pts
    if len(pts) > 2:
        near = [p for p in pts if abs(p - statistics.median(pts)) <= 25]
        core = near if len(near) >= 2 else pts
    c_lo, c_hi = min(core), max(core)
    band = [c for c in closed if c_lo - 2 <= c[0] <= c_hi + 2]
    competing = len({c[0] for c in band}) > 1
    lo, hi = c_lo, c_hi
    for c in band:
        if c[1] is not None and c[1] < lo and (not competing or c_lo - c[1] <= 10):
            lo = c[1]
        if c[2] is not None and c[2] > hi and (not competing or c[2] - c_hi <= 10):
            hi = c[2]
    lo0, hi0 = lo, hi
    lo = max([lo0, *(a for a in after if lo0 <= a <= hi0)])
    hi = min([hi0, *(b for b in before if lo <= b <= hi0)])
    votes = Counter(c[0] for c in band if lo <= c[0] <= hi)
    point = max(votes.items(), key=lambda kv: (kv[1], -kv[0]))[0] if votes else (lo + hi) // 2
    circa = {c[3] for c in band} == {"circa"}
    return (point, lo, hi, "circa" if circa else "exact" if lo == hi else "range", n, pts[-1] - pts[0] > 2)


def test_dates_against_the_rules(spark):
    rnd = random.Random(8)
    obs = []
    for person in range(150):
        for _ in range(rnd.randrange(1, 6)):
            y = rnd.choice([100, 101, 104, 120, 180]) + rnd.randrange(3)
            kind = rnd.choice(["exact", "exact", "circa", "range", "after", "before"])
            obs.append((str(person), *{"exact": (y, y, y), "circa": (y, y, y), "range": (y, y - rnd.randrange(15), y + rnd.randrange(15)), "after": (y, y, None), "before": (y, None, y)}[kind], kind))
    obs += [("none", None, None, None, None), (None, 5, 5, 5, "exact")]
    obs += [("clipped", 150, 100, 200, "range"), ("clipped", None, 150, None, "after"), ("clipped", None, None, 120, "before")]
    got = {r[0]: tuple(r[1:]) for r in R.reconcile_dates(spark.createDataFrame(obs, "person string, point int, earliest int, latest int, precision string")).collect()}
    for person in {o[0] for o in obs}:
        want = reconcile([o[1:] for o in obs if o[0] == person]) if person else None
        assert got.get(person) == want, (person, [o[1:] for o in obs if o[0] == person])
    assert got["clipped"][:3] == (150, 150, 200)


def test_contexts_and_gates(spark):
    m = spark.createDataFrame([("m1", "x", "t", "s"), ("m2", "x", "t", None), ("m3", "x", "q", "q")], "mention string, name string, previous_name string, following_name string")
    s = spark.createDataFrame([("one", "x", "t", "s"), ("two", "x", "t", None)], "signature string, name string, teacher string, student string")
    hit = R.contextual_matches(m, s)
    assert rows(hit) == [("m2", "two")] and rows(R.contextual_coverage(m, hit, s)) == [("x", 3, 1)]
    reg = spark.createDataFrame([("p", "x", 100), ("q", "x", 400)], "person string, name string, death_year int")
    assert rows(R.refine_mononyms(spark.createDataFrame([("m", "x", [150]), ("n", "x", [])], "mention string, name string, adjacent array<int>"), reg)) == [("m", "p")]
    rec = spark.createDataFrame([("a", 100, "corroborated", "male"), ("b", 101, None, "male"), ("c", 300, None, "female")], "id string, death_year int, provenance string, gender string")
    seeds = spark.createDataFrame([("s1", "a"), ("s1", "b"), ("s2", "a"), ("s2", "c"), ("s3", "a")], "seed string, member string")
    over = spark.createDataFrame([("a", "b", 0.9), ("a", "c", 0.9)], "a string, b string, overlap double")
    assert rows(R.unify(seeds, rec, rec.limit(0), over)) == [("s1", "unify"), ("s2", "spread"), ("s3", "too_few")]
    assert R.flag_over_merged(rec, spark.createDataFrame([("a", "why")], "id string, note string")).where("over_merged").count() == 1
    assert R.curated_links(spark.createDataFrame([("m", "a"), ("n", "zz")], "mention string, person string"), rec).count() == 1


def test_generic_names(spark):
    d = spark.createDataFrame([("ابو عبد الله", 60), ("محمد بن اسماعيل البخاري", 99), ("سفيان", 10), ("سفيان", 50), ("", 99), (None, 99)], "n string, k int")
    assert [r[0] for r in d.select(R.is_generic(F.col("n"), F.col("k"))).collect()] == [True, False, False, True, False, False]


@pytest.mark.parametrize("max_df", [None, 6])
def test_similar_classes_against_brute_force(spark, max_df):
    rnd = random.Random(6)
    texts = [(f"t{i:03}", sorted({rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(0, 7))})) for i in range(70)]
    c = P.token_classes(spark.createDataFrame(texts, "id string, w array<string>"), "id", F.col("w"))
    sets = {}
    for i, w in texts:
        if w:
            sets.setdefault(tuple(w), i)
    df = Counter(x for _, w in texts for x in w)
    want = []
    for (x, a), (y, b) in itertools.combinations(sorted(sets.items(), key=lambda kv: kv[1]), 2):
        inter = set(x) & set(y)
        j = len(inter) / len(set(x) | set(y))
        if j >= 0.5 and (max_df is None or any(df[t] <= max_df for t in inter)):
            want.append((a, b, round(j, 9)))
    assert rows(P.similar_classes(c, 0.5, max_df).select("class_a", "class_b", F.round("score", 9))) == sorted(want, key=str)
    assert P.similar_classes(c.limit(0)).count() == 0


def test_vector_search_and_recall(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(12, 16))
    m = np.repeat(base, 25, axis=0) + 0.25 * rng.normal(size=(300, 16))
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)] + [(900, None), (901, [0.0] * 16)], "id bigint, e array<float>")
    q = v.where("id % 50 = 0")
    exact = P.cosine_search(v, q, "id", "e", k=5, least=0.5, query_block=3, data_block=40)
    unit = m.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    got = {(r["query"], r["key"]) for r in exact.collect()}
    for i in range(0, 300, 50):
        s = unit @ unit[i]
        s[i] = -1
        assert {b for a, b in got if a == i} == {j for j in np.argsort(-s)[:5] if s[j] >= 0.5}
    near = {(r["query"], r["key"]) for r in P.inverted_search(v, q, "id", "e", k=5, least=0.5, lists=12, probes=4).collect()}
    assert len(near & got) / len(got) >= 0.9
    assert P.cosine_search(v.limit(0), q.limit(0), "id", "e").count() == 0


def test_token_order(spark):
    d = spark.createDataFrame([("علي بن محمد بن حسن", "علي محمد حسن"), ("علي بن محمد", "محمد بن علي"), ("علي", "محمد علي")], "a string, b string")
    assert [r[0] for r in d.select(R.order_kept(F.col("a"), F.col("b"))).collect()] == [True, False, True]
    assert token_set_ratio("علي بن محمد", "محمد بن علي") == 100


def test_ratios_of_lists_are_the_ratio_of_each_pair():
    import random

    import numpy as np

    from khayt.functions.similarity import ratio, ratios

    rng = random.Random(3)
    text = lambda most: "".join(rng.choice("ابتجحدر س😀") for _ in range(rng.randint(0, most)))
    a, b = ["", "ا", "x" * 64, "xy" * 40, *[text(70) for _ in range(30)]], ["", "ا", "x" * 65, *[text(90) for _ in range(40)]]
    assert np.array_equal(ratios(a, b), [[ratio(x, y) for y in b] for x in a])
    assert ratios([], b).shape == (0, len(b)) and ratios(a, []).shape == (len(a), 0)


def test_crossref_matches_by_packs_find_the_best_of_all(spark, monkeypatch):
    import random

    from khayt.functions.similarity import ratio

    rng = random.Random(4)
    names = lambda n: ["بن" + "".join(rng.choice("ابج ") for _ in range(rng.randint(0, 9))) for _ in range(n)]
    m, c = [*enumerate(names(60)), (60, ""), (61, None)], [(f"c{i:02}", x, i % 3) for i, x in enumerate([*names(70), "", None])]
    monkeypatch.setattr(R, "PACK", 7)
    mentions = spark.createDataFrame([(str(i), x) for i, x in m], "mention string, name_ar string")
    known = spark.createDataFrame([(k, x, k, "x" if e else None) for k, x, e in c], "candidate string, name_ar string, seq string, external_id string")
    assert R.likest_names(mentions.selectExpr("name_ar a"), known.selectExpr("name_ar b"), 60.0).count() < 62 * 72 / 4
    want = {}
    for i, x in m:
        hits = [(-ratio(x, y), k) for k, y, e in c if e and x is not None and y is not None and x[:2] == y[:2] and ratio(x, y) >= 60]
        if hits:
            want[str(i)] = (min(hits)[1], -min(hits)[0] / 100)
    assert {r["mention"]: (r["candidate"], r["score"]) for r in R.crossref_matches(mentions, known).collect()} == want


def test_near_names_are_met_by_their_beginning_too(spark):
    # Names that share a part but not their beginning are no pairs to be compared.
    a = spark.createDataFrame([(f"{chr(0x627 + i)}{chr(0x627 + j)} عبد الله",) for i in range(8) for j in range(8)], "a string")
    plan = R.near_names(a, a.withColumnRenamed("a", "b"))._jdf.queryExecution().optimizedPlan().toString()
    assert "_p#" in next(line for line in plan.splitlines() if "Join" in line and "text#" in line)
    assert R.near_names(a, a.withColumnRenamed("a", "b")).count() == 64


def test_sifting_leaves_out_no_like_names():
    from khayt.functions.similarity import sifted

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ابتجحد") for _ in range(rng.randint(1, 5)))
    known = [word() for _ in range(12)]
    names = ["", " ", *[" ".join(rng.choice(known) if rng.random() < 0.8 else word() for _ in range(rng.randint(1, 16))) for _ in range(150)]]
    x, y = (v.ravel() for v in np.meshgrid(np.arange(len(names)), np.arange(len(names))))
    may = sifted(names, x, y, 90.0, together=500)
    alike = np.array([token_set_ratio(names[i], names[j]) >= 90 for i, j in zip(x, y, strict=True)])
    assert alike.sum() > 200 and not (alike & ~may).any()
    short = np.array([len(set(n.split())) <= 12 for n in names])
    assert (may & short[x] & short[y]).sum() < 4 * (alike & short[x] & short[y]).sum()


def test_mergeable_as_by_every_pair_of_names(spark):
    rng = random.Random(6)
    words = ["محمد", "بن", "علي", "الكوفي", "حسن", "حسين", "زيد", "الكوفيي", "ا"]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 5)))
    rows = [(f"{i:02}", None if i == 3 else [name() for _ in range(rng.randint(0, 3))] + [None] * (i % 7 == 0), rng.choice([None, 100, 101, 130]), rng.choice([None, "uncorroborated"]), rng.choice([None, "male", "female"])) for i in range(40)]
    r = spark.createDataFrame(rows, "id string, keys array<string>, death_year int, provenance string, gender string")
    pairs = [(a[0], b[0]) for a in rows for b in rows if a[0] < b[0]]
    kept = spark.createDataFrame([(x, y) for q in rows for p in rows for x in q[1] or [] for y in p[1] or []], "x string, y string").where("x is not null and y is not null").distinct()
    order = {(k["x"], k["y"]): k["ok"] for k in kept.select("x", "y", R.order_kept(F.col("x"), F.col("y")).alias("ok")).collect()}
    by = {x[0]: x for x in rows}
    want = set()
    for i, j in pairs:
        a, b = by[i], by[j]
        limit = R.GROSS_SPREAD if "uncorroborated" in (a[3], b[3]) else R.DEATH_TOLERANCE
        if not (a[2] and b[2] and abs(a[2] - b[2]) > limit) and not (a[4] and b[4] and a[4] != b[4]):
            if any(x and y and token_set_ratio(x, y) >= 90 and order[x, y] for x in a[1] or [] for y in b[1] or []):
                want.add((i, j))
    got = R.mergeable(r, spark.createDataFrame(pairs, "a string, b string"))
    assert want and len(want) < len(pairs) and {tuple(x) for x in got.collect()} == want
    assert "explode" not in got._jdf.queryExecution().optimizedPlan().toString()
