import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from khayt.operators import graph as G
from khayt.operators import sequence as Q


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_sequences(spark):
    d = spark.createDataFrame([("h", 0, "a"), ("h", 1, None), ("h", 2, "b"), ("h", 3, "b"), ("h", 4, "c"), ("i", 0, "z")], "g string, p int, x string")
    assert rows(Q.consecutive_pairs(d, ["g"], ["p"], "x").select("g", "from_item", "to_item")) == [("h", "a", "b"), ("h", "b", "c")]
    assert rows(Q.first_of(d, ["g"], ["p"], "x")) == [("h", "a"), ("i", "z")]
    assert rows(Q.collected(d, ["g"], ["p"], "x").select("g", F.array_join("items", ""), "length")) == [("h", "abbc", 4), ("i", "z", 1)]
    n = {r["p"]: (r["previous"], r["following"]) for r in Q.neighbours(d, ["g"], ["p"], "x").where("g = 'h'").collect()}
    assert n[1] == ("a", "b") and n[2] == ("a", None) and n[4] == ("b", None)
    b = spark.createDataFrame([("a", v) for v in (1, 50, 200, 210, 400)], "g string, v int")
    assert [r["band"] for r in sorted(Q.bands(b, ["g"], "v", [], 80).collect(), key=lambda r: r["v"])] == [0, 0, 1, 1, 2]
    assert Q.bands(b.limit(0), ["g"], "v", [], 80).count() == 0


def test_overlaps_against_brute_force(spark):
    rnd = random.Random(2)
    span = lambda: (lambda a: (a, a + rnd.choice([0, 3, 90, 400]) if rnd.random() < 0.9 else None))(rnd.randrange(-200, 900))
    a, b = [(i, *span()) for i in range(60)], [(i, *span()) for i in range(60)]
    got = Q.overlaps(spark.createDataFrame(a, "i int, s int, e int"), spark.createDataFrame(b, "j int, u int, v int"), ("s", "e"), ("u", "v")).select("i", "j")
    assert rows(got) == sorted(((i, j) for i, s, e in a for j, u, v in b if e is not None and v is not None and s <= v and u <= e), key=str)


@pytest.fixture
def net(spark):
    rnd = random.Random(9)
    ids = [f"n{i:02}" for i in range(25)]
    edges = [(rnd.choice(ids[:20]), rnd.choice(ids[:20])) for _ in range(45)]
    return ids, edges, spark.createDataFrame([(i,) for i in ids], "id string"), spark.createDataFrame(edges, "from_id string, to_id string")


def test_components_of_few_links_are_found_by_one_task(spark, net, monkeypatch):
    _, _, _, e = net
    path = spark.createDataFrame([(f"{(i * 37) % 101:03}", f"{((i + 1) * 37) % 101:03}") for i in range(100) if i % 30], "from_id string, to_id string")
    stages = []
    monkeypatch.setattr(G, "store", lambda df, what, kept=G.store: stages.append(what) or kept(df, what))
    for edges in (e, path, path.limit(0)):
        want = {tuple(r) for r in G.components(edges, few=-1).collect()}
        stages.clear()
        got = G.components(edges)
        assert stages == ["links", "labels"] and {tuple(r) for r in got.collect()} == want


def test_components_and_communities(spark, net):
    ids, edges, _, e = net
    root = {i: i for x in edges for i in x}
    for _ in ids:
        for a, b in edges:
            m = min(root[a], root[b])
            root[a] = root[b] = m
    assert {r[0]: r[1] for r in G.components(e).collect()} == root
    assert G.components(e.limit(0)).count() == 0
    two = spark.createDataFrame([(a, b) for g in ("abc", "xyz") for a in g for b in g if a < b], "from_id string, to_id string")
    assert len({r[1] for r in G.communities(two).collect()}) == 2


def test_pagerank(spark, net):
    ids, edges, n, e = net
    out = defaultdict(int)
    for a, _ in edges:
        out[a] += 1
    rank = dict.fromkeys(ids, 0.15)
    for _ in range(20):
        gain = defaultdict(float)
        for a, b in edges:
            gain[b] += rank[a] / out[a]
        rank = {i: 0.15 + 0.85 * gain[i] for i in ids}
    got = {r[0]: r[1] for r in G.pagerank(n, e).collect()}
    assert all(abs(got[i] - rank[i]) < 1e-9 for i in ids)


def test_betweenness(spark, net):
    ids, edges, n, e = net
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
    score = dict.fromkeys(ids, 0.0)
    for s in ids:
        dist, sigma, order, before, queue = {s: 0}, defaultdict(float, {s: 1.0}), [], defaultdict(list), deque([s])
        while queue:
            v = queue.popleft()
            order.append(v)
            for w in near[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    queue.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    before[w].append(v)
        delta = defaultdict(float)
        for w in reversed(order):
            for v in before[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                score[w] += delta[w]
    got = {r[0]: r[1] for r in G.betweenness(n, e).collect()}
    assert all(abs(got[i] - score[i]) < 1e-6 for i in ids)


def test_betweenness_of_a_long_path(spark, net):
    n = spark.createDataFrame([(f"{i:03}",) for i in range(106)], "id string")
    e = spark.createDataFrame([(f"{i:03}", f"{i + 1:03}") for i in range(105)], "from_id string, to_id string")
    got = {r[0]: r[1] for r in G.betweenness(n, e).collect()}
    assert all(abs(got[f"{i:03}"] - i * (105 - i)) < 1e-6 for i in range(106))
    with pytest.raises(RuntimeError):
        G.betweenness(n.where("id < '008'"), e.where("to_id < '008'"), max_depth=3, graph_size=0)
    _, _, n, e = net
    want = {r[0]: r[1] for r in G.betweenness(n, e, graph_size=0).collect()}
    got = {r[0]: r[1] for r in G.betweenness(n, e).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 for i in got)


def test_betweenness_follows_a_link_once_for_like_sources(monkeypatch):
    import numpy as np

    # 640 sources that all link to one of two hubs, each with 300 nodes behind it that meet in a last one.
    begin, end = [], []
    for h in (0, 1):
        begin += [*range(2 + h, 642, 2), *[h] * 300, *range(642 + 300 * h, 942 + 300 * h)]
        end += [*[h] * 320, *range(642 + 300 * h, 942 + 300 * h), *[1242] * 300]
    begin, end = np.array(begin, np.int32), np.array(end, np.int32)
    by = np.argsort(end, kind="stable")
    begin, end = begin[by], end[by]
    followed, sums = [], G._run_sums
    monkeypatch.setattr(G, "_run_sums", lambda values, index, *rest: followed.append(len(index)) or sums(values, index, *rest))
    sources = G._alike(1243, begin, end, np.arange(2, 642))
    assert sorted(sources) == list(range(2, 642))
    got = G._dependencies(1243, begin, end, sources)
    assert np.allclose(got[:2], 320 * 301) and np.allclose(got[642:1242], 320 / 300) and not got[2:642].any()
    assert sum(followed) < 640 * 600 * 2 / 30


def test_betweenness_query_searches_from_every_source(spark, data):
    from khayt.plans.graph import Tables, g_betweenness

    t = Tables(spark, data)
    want = {r[0]: r[1] for r in G.betweenness(t.narrators(), t.transmitted()).collect()}
    got = {r[0]: r[1] for r in g_betweenness(spark, data).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-3 for i in got)


def test_upsert_and_prune(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "id string, v int, w string")
    new = spark.createDataFrame([("b", None, "y"), ("c", 3, None)], "id string, v int, w string")
    assert rows(G.upsert(old, new, ["id"])) == [("a", 1, "x", "kept"), ("b", 2, "y", "merged"), ("c", 3, None, "created")]
    nodes = spark.createDataFrame([(x,) for x in "abcd"], "id string")
    e = spark.createDataFrame([("a", "b"), ("a", "d")], "from_id string, to_id string")
    kept, left = G.prune(nodes, spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "id string"), e)
    assert kept.count() == 3 and rows(left.select("from_id", "to_id")) == [("a", "b")]
    for bad in ([], ["a"], ["x", "y"]):
        with pytest.raises(G.PruneRefused):
            G.prune(nodes, spark.createDataFrame([(x,) for x in bad], "id string"), e)


def test_studied_under(spark):
    from khayt.functions import scalars as S
    from khayt.functions.arabic import canonical_surface

    names = spark.createDataFrame([("مالك بن أنس",), ("نافع",)], "n string").select(S.canonical_id(canonical_surface(F.col("n"))).alias("id"))
    kind = "from_name string, from_external_id string, to_name string, to_external_id string, relation string"
    ok = spark.createDataFrame([("مالك بن أنس", None, "نافع", None, "STUDIED_UNDER"), ("مالك بن أنس", None, "غائب", None, "STUDIED_UNDER"), ("نافع", None, "مالك بن أنس", None, "TRANSMITTED_TO")], kind)
    assert G.studied_under(ok, names).count() == 1
    with pytest.raises(ValueError):
        G.studied_under(spark.createDataFrame([("a", None, "b", None, None)], kind), names)
