"""The property graph as tables: nodes, edges with their endpoints checked, upserts, pruning, and measures of nodes."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from khayt.functions import scalars as S
from khayt.operators import sequence as Q
from khayt.runtime import release, store

HADITH_COLUMNS = ("source_corpus", "collection_name", "book_number", "chapter_number", "hadith_number", "matn_ar", "matn_en", "full_text_ar", "grade", "sect")
MENTION_COLUMNS = ("canonical_narrator_id", "hadith_id", "chain_index", "position_in_chain", "source_corpus")


def hadith_outcomes(hadiths: DataFrame) -> DataFrame:
    """The latest row of each source_id with ``outcome``: invalid_source_id, noncanonical, cross_edition_dedup, malformed or keep, in this order."""
    rows = Q.latest(hadiths, ["source_id"], ["loaded_at"], HADITH_COLUMNS)
    text = F.when(F.trim("matn_ar") != "", F.col("matn_ar")).otherwise(F.coalesce("full_text_ar", F.lit("")))
    rows = rows.withColumn("identity", S.matn_identity(text, F.col("matn_en")))
    composed = S.in_composition(F.coalesce("source_corpus", F.lit("")), F.coalesce("collection_name", F.lit("")))
    dedup = F.coalesce(F.col("source_corpus").isin(*S.DEDUP_CORPORA), F.lit(False))
    curated = rows.where(~dedup & composed & F.col("identity").isNotNull()).select("identity").distinct().withColumn("_curated", F.lit(True))
    met = rows.join(curated, "identity", "left")
    return met.withColumn(
        "outcome",
        F.when(F.coalesce(F.trim("source_id"), F.lit("")) == "", "invalid_source_id").when(~composed, "noncanonical")
        .when(dedup & F.col("_curated").isNotNull(), "cross_edition_dedup").when(S.is_doubled(F.col("source_id")), "malformed").otherwise("keep"),
    ).drop("_curated")


def hadith_nodes(hadiths: DataFrame) -> DataFrame:
    kept = hadith_outcomes(hadiths).where("outcome = 'keep'")
    return kept.select(S.with_prefix(F.col("source_id"), "hdt:").alias("id"), "source_id", *HADITH_COLUMNS, S.normalize_grade(F.col("grade")).alias("grade_normalized"))


def narrator_nodes(canonical: DataFrame) -> DataFrame:
    cols = ("name_ar", "name_en", "generation", "gender", "birth_year_ah", "death_year_ah", "mention_count", "attestation", "source_corpus")
    return Q.latest(canonical.where("canonical_id is not null"), ["canonical_id"], ["loaded_at"], cols).select(S.with_prefix(F.col("canonical_id"), "nar:").alias("id"), *cols)


def collection_nodes(collections: DataFrame) -> DataFrame:
    cols = ("name_ar", "name_en", "compiler_name", "compilation_year_ah", "sect", "total_hadiths", "expected_count", "source_corpus")
    return Q.latest(collections.where("collection_id is not null"), ["collection_id"], ["loaded_at"], cols).select(S.with_prefix(F.col("collection_id"), "col:").alias("id"), *cols)


def grading_nodes(hadiths: DataFrame) -> DataFrame:
    """A grading for every kept hadith that states a grade."""
    return hadith_nodes(hadiths).where(F.trim("grade") != "").select(F.regexp_replace("id", "^hdt:", "grd:").alias("id"), F.col("id").alias("hadith_id"), "grade", "grade_normalized")


def event_nodes(events: DataFrame) -> DataFrame:
    return events.where("id is not null").dropDuplicates(["id"])


def surviving_mentions(mentions: DataFrame, nodes: DataFrame) -> DataFrame:
    """The latest row of each mention whose hadith was kept, with prefixed ids and chain 0 where none is named."""
    rows = Q.latest(mentions.where("mention_id is not null and hadith_id is not null"), ["mention_id"], ["loaded_at"], MENTION_COLUMNS)
    rows = rows.withColumn("chain_index", F.coalesce("chain_index", F.lit(0))).withColumn("hadith_id", S.with_prefix(F.col("hadith_id"), "hdt:"))
    rows = rows.withColumn("canonical_narrator_id", S.with_prefix(F.col("canonical_narrator_id"), "nar:"))
    return rows.join(nodes.select(F.col("id").alias("hadith_id")), "hadith_id", "left_semi")


def chain_nodes(mentions: DataFrame) -> DataFrame:
    """The narrators of each chain in order."""
    got = Q.collected(mentions, ["hadith_id", "chain_index"], ["position_in_chain", "mention_id"], "canonical_narrator_id")
    return got.select(F.concat(F.lit("chn:"), F.regexp_replace("hadith_id", "^hdt:", ""), F.lit("-"), "chain_index").alias("id"), "hadith_id", F.col("items").alias("narrator_ids"), F.col("length").alias("chain_length"))


def with_endpoints(edges: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """The edges (from_id, to_id, ..) whose two ends exist, by two semi-joins."""
    return edges.join(sources.select(F.col("id").alias("from_id")), "from_id", "left_semi").join(targets.select(F.col("id").alias("to_id")), "to_id", "left_semi")


def missing_endpoints(edges: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """(side, id, edges): ends that do not exist."""
    out = []
    for side, nodes in (("from", sources), ("to", targets)):
        gone = edges.join(nodes.select(F.col("id").alias(f"{side}_id")), f"{side}_id", "left_anti")
        out.append(gone.groupBy(F.col(f"{side}_id").alias("id")).agg(F.count(F.lit(1)).alias("edges")).withColumn("side", F.lit(side)))
    return out[0].unionByName(out[1])


def transmitted_to(mentions: DataFrame, narrators: DataFrame) -> DataFrame:
    pairs = Q.consecutive_pairs(mentions, ["hadith_id", "chain_index"], ["position_in_chain", "mention_id"], "canonical_narrator_id", ["position_in_chain"])
    edges = pairs.select(F.col("from_item").alias("from_id"), F.col("to_item").alias("to_id"), F.col("position_in_chain").alias("position"), "hadith_id").distinct()
    return with_endpoints(edges, narrators, narrators)


def narrated(mentions: DataFrame, narrators: DataFrame) -> DataFrame:
    first = Q.first_of(mentions, ["hadith_id", "chain_index"], ["position_in_chain", "mention_id"], "canonical_narrator_id")
    edges = first.select(F.col("canonical_narrator_id").alias("from_id"), F.col("hadith_id").alias("to_id")).distinct()
    return edges.join(narrators.select(F.col("id").alias("from_id")), "from_id", "left_semi")


def appears_in(hadiths: DataFrame, collections: DataFrame) -> DataFrame:
    edges = hadiths.where(F.coalesce("collection_name", F.lit("")) != "").select(
        F.col("id").alias("from_id"), S.with_prefix(F.concat_ws(":", F.nullif("source_corpus", F.lit("")), "collection_name"), "col:").alias("to_id"), "book_number", "chapter_number", F.col("hadith_number").alias("hadith_number_in_book"), "source_corpus"
    )
    return edges.join(collections.select(F.col("id").alias("to_id")), "to_id", "left_semi")


def graded_by(gradings: DataFrame) -> DataFrame:
    return gradings.select(F.col("hadith_id").alias("from_id"), F.col("id").alias("to_id"))


def parallel_of(links: DataFrame, hadiths: DataFrame) -> DataFrame:
    a, b = S.with_prefix(F.col("hadith_id_a"), "hdt:"), S.with_prefix(F.col("hadith_id_b"), "hdt:")
    edges = links.where("hadith_id_a is not null and hadith_id_b is not null").select(F.least(a, b).alias("from_id"), F.greatest(a, b).alias("to_id"), "similarity_score", "variant_type", "cross_sect")
    return with_endpoints(edges, hadiths, hadiths)


def studied_under(network: DataFrame, narrators: DataFrame) -> DataFrame:
    """(from_id, to_id) of the network edges (from_name, from_external_id, to_name, to_external_id, relation) that declare this relation; ends are found by their names' minted ids.

    A row that declares no relation, or one that is not known, is refused.
    """
    from khayt.functions.arabic import canonical_surface

    bad = network.where(~F.coalesce(F.trim("relation").isin("STUDIED_UNDER", "TRANSMITTED_TO"), F.lit(False)))
    if not bad.isEmpty():
        raise ValueError("a network edge declares no known relation")

    def end(side: str):
        name, other = F.col(f"{side}_name"), F.col(f"{side}_external_id")
        return F.when(F.trim(name) != "", S.canonical_id(canonical_surface(name))).when(F.trim(other) != "", S.with_prefix(other, "nar:"))

    edges = network.where(F.trim("relation") == "STUDIED_UNDER").select(end("from").alias("from_id"), end("to").alias("to_id")).dropna().distinct()
    return with_endpoints(edges, narrators, narrators)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both by key: new values that are not null win, old ones fill them; ``merge`` says created, merged or kept."""
    cols = [c for c in old.columns if c not in keys]
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in cols], F.lit(True).alias("_new"))
    met = old.withColumn("_old", F.lit(True)).join(n, list(keys), "full")
    state = F.when(F.col("_old").isNull(), "created").when(F.col("_new").isNotNull(), "merged").otherwise("kept")
    return met.select(*keys, *[F.coalesce(f"_n_{c}", c).alias(c) for c in cols], state.alias("merge"))


class PruneRefused(RuntimeError):
    """The set to keep is empty or would delete more than the guards allow."""


def prune(nodes: DataFrame, keep: DataFrame, edges: DataFrame, max_missing: float = 0.5, max_orphans: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """Nodes in the set to keep, and the edges between them. Guards come first: no empty set, no more than half the nodes missing from it, nor more than nine tenths of its ids unknown."""
    k = keep.select("id").dropna().distinct()
    counts = nodes.select("id", F.lit(1).alias("n")).join(k.withColumn("k", F.lit(1)), "id", "full").agg(F.count("n"), F.count("k"), F.count_if(F.col("n").isNotNull() & F.col("k").isNotNull())).first()
    have, wanted, both = counts
    if not wanted:
        raise PruneRefused("the set to keep is empty")
    if have and (have - both) / have > max_missing:
        raise PruneRefused(f"{have - both} of {have} nodes would be deleted")
    if (wanted - both) / wanted > max_orphans:
        raise PruneRefused(f"{wanted - both} of {wanted} ids to keep are not known")
    kept = nodes.join(k, "id", "left_semi")
    return kept, edges.join(k.withColumnRenamed("id", "from_id"), "from_id", "left_semi").join(k.withColumnRenamed("id", "to_id"), "to_id", "left_semi")


def degrees(edges: DataFrame) -> DataFrame:
    """(id, in_degree, out_degree); parallel edges count each."""
    ends = edges.select(F.col("from_id").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(edges.select(F.col("to_id").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return ends.groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))


def pagerank(nodes: DataFrame, edges: DataFrame, iterations: int = 20, damping: float = 0.85, cut_every: int = 5) -> DataFrame:
    """(id, rank): rank = 1 - d + d * sum of the in-neighbours' rank by their out-degree; parallel edges weigh as often as they occur. Lineage is cut every few rounds."""
    spark = nodes.sparkSession
    weight, at = store(edges.groupBy("from_id", "to_id").agg(F.count(F.lit(1)).alias("n")), "weights")
    out = weight.groupBy("from_id").agg(F.sum("n").alias("all"))
    flow, flow_at = store(weight.join(out, "from_id").select("from_id", "to_id", (F.col("n") / F.col("all")).alias("w")), "flow")
    release(spark, at)
    ids, _ = store(nodes.select("id").distinct(), "ids")
    rank, rank_at = ids.withColumn("rank", F.lit(1.0 - damping)), None
    for i in range(iterations):
        gain = flow.join(rank, flow.from_id == rank.id).groupBy("to_id").agg(F.sum(F.col("rank") * F.col("w")).alias("gain"))
        rank = ids.join(gain, ids.id == gain.to_id, "left").select("id", (F.lit(1.0 - damping) + F.lit(damping) * F.coalesce("gain", F.lit(0.0))).alias("rank"))
        if (i + 1) % cut_every == 0 or i + 1 == iterations:
            rank, now = store(rank, "rank")
            if rank_at:
                release(spark, rank_at)
            rank_at = now
    return rank


#: Links up to which components are found by one task.
FEW_LINKS = 1_000_000


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, component) of all links (a, b) at once, by the same minima."""
    got = [x for x in batches if x.num_rows]
    if not got:
        return
    links = pa.Table.from_batches(got)
    ids = pa.chunked_array([*links["a"].chunks, *links["b"].chunks]).unique()
    ids = ids.take(pc.sort_indices(ids))
    a, b = (pc.index_in(links[c], value_set=ids).to_numpy() for c in ("a", "b"))
    label = np.arange(len(ids))
    while True:
        near = label.copy()
        np.minimum.at(near, a, label[b])
        np.minimum.at(near, b, label[a])
        # A smaller label reaches all that had the same one, then minima are followed to their own.
        low = np.arange(len(ids))
        np.minimum.at(low, label, near)
        near = low[near]
        while (near != near[near]).any():
            near = near[near]
        if (near == label).all():
            break
        label = near
    for at in range(0, len(ids), 1 << 16):
        yield pa.RecordBatch.from_arrays([ids.slice(at, 1 << 16), ids.take(pa.array(label[at : at + (1 << 16)]))], names=["id", "component"])


def components(edges: DataFrame, max_rounds: int = 60, few: int = FEW_LINKS) -> DataFrame:
    """(id, component): the smallest id reachable, by passing minima along edges and jumping to the minimum's own minimum, until nothing changes. Up to ``few`` links are taken by one task."""
    spark = edges.sparkSession
    both = edges.select(F.col("from_id").alias("a"), F.col("to_id").alias("b")).dropna()
    both, links_at = store(both.distinct(), "links")
    if both.count() <= few:
        kind = both.schema["a"].dataType.simpleString()
        label, _ = store(both.coalesce(1).mapInArrow(_joined, f"id {kind}, component {kind}"), "labels")
        release(spark, links_at)
        return label
    both, _ = store(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "both")
    label, at = store(both.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct(), "labels")
    for _ in range(max_rounds):
        near = both.join(label, both.b == label.id).groupBy("a").agg(F.min("component").alias("near"))
        nearer = label.join(near, label.id == near.a).select("id", F.least("component", "near").alias("component"), F.col("component").alias("was"))
        jump = nearer.select(F.col("id").alias("component"), F.col("component").alias("further")).where(F.col("component") != F.col("further"))
        nxt = nearer.join(jump, "component", "left").select("id", F.coalesce("further", "component").alias("component"), "was")
        nxt, to = store(nxt, "labels")
        release(spark, at)
        at = to
        changed = not nxt.where(F.col("component") != F.col("was")).isEmpty()
        label = nxt.select("id", "component")
        if not changed:
            return label
    raise RuntimeError(f"labels were still changing after {max_rounds} rounds")


def communities(edges: DataFrame, rounds: int = 10) -> DataFrame:
    """(id, community) by label propagation: in each round a node takes the label most of its neighbours have, the smallest among equals, until no label changes or for ``rounds`` rounds.

    Labels may go to and fro for ever (two nodes that take each other's), so the number of rounds is part of the definition, not a cut. Stands for a modularity method, which has no
    distributed form here.
    """
    both = edges.where("from_id <> to_id").select(F.col("from_id").alias("a"), F.col("to_id").alias("b"))
    both, links_at = store(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "both")
    label, at = store(both.select(F.col("a").alias("id"), F.col("a").alias("community")).distinct(), "labels")
    for _ in range(rounds):
        votes = both.join(label, both.b == label.id).groupBy("a", "community").agg(F.sum("n").alias("n"))
        best = votes.groupBy(F.col("a").alias("id")).agg(F.min(F.struct((-F.col("n")).alias("n"), "community")).alias("best"))
        following, to = store(best.select("id", F.col("best.community").alias("community")), "labels")
        changed = not following.join(label, ["id", "community"], "left_anti").isEmpty()
        release(edges.sparkSession, at)
        label, at = following, to
        if not changed:
            break
    release(edges.sparkSession, links_at)
    return label


#: Nodes and links up to which a graph is given whole to every task of a search.
GRAPH_SIZE = 4_000_000


#: Sources searched at once, a bit each; values of a search held at once, about a third of what it takes.
SOURCES, HELD = 64, 16_000_000
#: Longest run of rows summed a row of each run at a time; longer ones are summed one by one. Rows of a piece, which stays in the cache.
RUN, PIECE = 16, 4096


class _Room:
    """Arrays of a fixed width that are used again, as new ones cost as much as what is done with them."""

    def __init__(self, width: int) -> None:
        self.width, self.held = width, {}

    def __call__(self, what: int | str, rows: int) -> np.ndarray:
        got = self.held.get(what)
        if got is None or len(got) < rows:
            got = self.held[what] = np.empty((rows + rows // 8 + 1, self.width))
        return got[:rows]


def _run_sums(values: np.ndarray, index: np.ndarray, heads: np.ndarray, out: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Into ``out`` the sums of values[index] over the runs that begin at ``heads``, longest first; gives the numbers of the runs in that order."""
    count = np.diff(heads, append=len(index)).clip(max=RUN + 1)
    by = np.argsort(-count, kind="stable")
    count, first = count[by], heads[by]
    ends = np.append(heads[1:], len(index))[by]
    longer = [int(np.searchsorted(-count, -r)) for r in range(RUN + 1)]
    for i in range(longer[RUN]):
        out[i] = 0
        for at in range(first[i], ends[i], PIECE):
            part = index[at : min(at + PIECE, ends[i])]
            out[i] += np.take(values, part, axis=0, out=piece[: len(part)], mode="clip").sum(axis=0)
    for at in range(longer[RUN], len(heads), PIECE):
        end = min(at + PIECE, len(heads))
        np.take(values, index[first[at:end]], axis=0, out=out[at:end], mode="clip")
        for r in range(1, RUN):
            if (k := min(longer[r], end)) <= at:
                break
            out[at:k] += np.take(values, index[first[at:k] + r], axis=0, out=piece[: k - at], mode="clip")
    return by


def _dependencies(n: int, begin: np.ndarray, end: np.ndarray, sources: np.ndarray) -> np.ndarray:
    """The sum, per node, of what the shortest paths from the sources, which are distinct, hang on it. Links (begin, end) are in the order of their ends.

    Up to 64 sources are searched at once: which of them reach a node at a level is one word, and a level holds a row of a value per source for each node that any of them reaches there.
    So a link is followed once for all sources that take it at the same level; sources at like distances from everything, one after another, share most of it.
    """
    total, place = np.zeros(n), np.zeros(n, np.int32)
    width = max(1, min(SOURCES, len(sources), HELD // max(1, n)))
    room, piece = _Room(width), np.empty((PIECE, width))
    for at in range(0, len(sources), width):
        own = sources[at : at + width]
        if len(own) < width:
            room, piece = _Room(len(own)), np.empty((PIECE, len(own)))
        bits = np.uint64(1) << np.arange(len(own), dtype=np.uint64)
        every, seen = np.bitwise_or.reduce(bits), np.zeros(n, np.uint64)
        seen[own] = bits
        front, place[own] = seen.copy(), np.arange(len(own))
        levels, a, b = [(own, np.eye(len(own)), None, None, None)], begin, end
        while True:
            met = front[a]
            used = np.flatnonzero(met & ~seen[b])
            if not len(used):
                break
            here, there = a[used], b[used]
            heads = np.flatnonzero(np.diff(there, prepend=-1))
            rows = there[heads]
            new = np.bitwise_or.reduceat(met[used], heads) & ~seen[rows]
            sigma = room(len(levels), len(rows))
            by = _run_sums(levels[-1][1], place[here], heads, sigma, piece)
            rows, new = rows[by], new[by]
            part = np.flatnonzero(new != every)
            sigma[part] *= (new[part, None] & bits) != 0
            levels.append((rows, sigma, here, there, part))
            place[rows], front = np.arange(len(rows)), np.zeros(n, np.uint64)
            front[rows] = new
            seen[rows] |= new
            left = np.flatnonzero(seen[b] != every)
            a, b = a[left], b[left]
        delta = room("even", len(levels[-1][0]))
        delta[:] = 0
        for i in range(len(levels) - 1, 0, -1):
            rows, sigma, here, there, part = levels[i]
            total[rows] += delta.sum(axis=1)
            if i == 1:
                break
            delta += 1
            with np.errstate(divide="ignore"):
                delta /= sigma
            delta[part] = np.where(sigma[part] > 0, delta[part], 0)
            place[rows] = np.arange(len(rows))
            back = np.argsort(here, kind="stable")
            here = here[back]
            heads = np.flatnonzero(np.diff(here, prepend=-1))
            share = room("share", len(heads))
            by = _run_sums(delta, place[there[back]], heads, share, piece)
            rows, sigma = levels[i - 1][:2]
            place[rows] = np.arange(len(rows))
            delta = room("odd" if (len(levels) - i) % 2 else "even", len(rows))
            delta[:] = 0
            delta[place[here[heads]][by]] = share
            delta *= sigma
    return total


def _alike(n: int, begin: np.ndarray, end: np.ndarray, sources: np.ndarray, hubs: int = 6) -> np.ndarray:
    """The sources in an order in which neighbours are at like distances: by their distances to the nodes most linked to, then by the two most linked to of those that they link to."""
    degree = np.bincount(end, minlength=n)
    start = np.concatenate([[0], np.cumsum(degree)])
    most = np.argsort(-degree, kind="stable")
    keys = []
    for hub in most[:hubs]:
        far = np.full(n, n, np.int32)
        front, d = np.array([hub]), 0
        while len(front):
            far[front], d = d, d + 1
            link = np.repeat(start[front] - np.cumsum(degree[front]) + degree[front], degree[front]) + np.arange(degree[front].sum())
            front = np.unique(begin[link])
            front = front[far[front] == n]
        keys.append(far)
    rank = np.empty(n, np.int64)
    rank[most] = np.arange(n)
    first, second = np.full(n, n), np.full(n, n)
    np.minimum.at(first, begin, rank[end])
    np.minimum.at(second, begin, np.where(rank[end] == first[begin], n, rank[end]))
    return sources[np.lexsort((sources, second[sources], first[sources], *[k[sources] for k in reversed(keys)]))]


def _searched(ids: DataFrame, links: DataFrame, chosen: DataFrame) -> DataFrame:
    """(v, d): the dependencies of all nodes on the chosen sources. The graph, as numbers, goes to every task; sources are dealt to tasks in runs of like ones."""
    spark = ids.sparkSession
    every = ids.unionByName(links.select(F.col("from_id").alias("id"))).unionByName(links.select(F.col("to_id").alias("id"))).distinct()
    number, _ = store(every.where("id is not null").select("id", (F.row_number().over(Window.orderBy("id")) - 1).cast("bigint").alias("k")), "number")
    a, b = (number.select(F.col("id").alias(f"{x}_id"), F.col("k").alias(x)) for x in ("from", "to"))
    pairs = links.join(a, "from_id").join(b, "to_id").select(F.col("from").cast("int"), F.col("to").cast("int")).toArrow()
    n = number.count()
    begin, end = (pairs[c].to_numpy() for c in ("from", "to"))
    by = np.argsort(end, kind="stable")
    begin, end = begin[by], end[by]
    sources = _alike(n, begin, end, np.sort(chosen.join(number, "id").select("k").toArrow()["k"].to_numpy()))
    graph = spark.sparkContext.broadcast((begin, end, sources))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, end, sources = graph.value
        for batch in batches:
            block = batch.column(0).to_numpy()
            d = _dependencies(n, begin, end, sources[SOURCES * block[0] : SOURCES * (block[-1] + 1)])
            k = np.flatnonzero(d)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(d[k])], names=["k", "d"])

    blocks = math.ceil(len(sources) / SOURCES)
    parts = max(1, min(blocks, 8 * spark.sparkContext.defaultParallelism))
    asked = spark.range(0, blocks, 1, parts)
    return asked.mapInArrow(work, "k bigint, d double").groupBy("k").agg(F.sum("d").alias("d")).join(number, "k").select(F.col("id").alias("v"), "d")


def betweenness(nodes: DataFrame, edges: DataFrame, pivots: int | None = None, seed: int = 42, max_depth: int = 100, graph_size: int = GRAPH_SIZE) -> DataFrame:
    """(id, score): shortest-path betweenness of the directed graph, from all sources or from a sample of ``pivots`` scaled to all.

    A graph of at most ``graph_size`` nodes and links is searched whole by every task, each from its own sources, to any depth. In a larger one all sources search at once,
    level by level, as joins on (source, node): no node's neighbours and no source's tree is held by one task. Then dependencies are summed back from the deepest level;
    paths of more than ``max_depth`` links are an error there. Parallel edges are one.
    """
    spark = nodes.sparkSession
    ids, _ = store(nodes.select("id").distinct(), "ids")
    links, _ = store(edges.where("from_id <> to_id").select("from_id", "to_id").distinct(), "links")
    total = ids.count()
    chosen = ids if pivots is None or pivots >= total else ids.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(pivots)
    scale = 1.0 if pivots is None or pivots >= total else total / pivots
    if total + links.count() <= graph_size:
        score = _searched(ids, links, chosen)
        return ids.join(score, ids.id == score.v, "left").select("id", (F.coalesce("d", F.lit(0.0)) * scale).alias("score"))
    front, at = store(chosen.select(F.col("id").alias("s"), F.col("id").alias("v"), F.lit(1.0).alias("sigma")), "front")
    seen, levels = front.select("s", "v"), [front]
    for _ in range(max_depth):
        reached = front.join(links, front.v == links.from_id).groupBy("s", F.col("to_id").alias("v")).agg(F.sum("sigma").alias("sigma"))
        front, _ = store(reached.join(seen, ["s", "v"], "left_anti"), "front")
        if front.isEmpty():
            break
        levels.append(front)
        seen = seen.unionByName(front.select("s", "v"))
    else:
        raise RuntimeError(f"nodes were still being reached after {max_depth} levels")
    delta = levels[-1].select("s", "v", "sigma", F.lit(0.0).alias("delta"))
    done = []
    for level in reversed(levels[:-1]):
        w = delta.select("s", F.col("v").alias("w"), F.col("sigma").alias("sw"), F.col("delta").alias("dw"))
        share = level.join(links, level.v == links.from_id).join(w, (level.s == w.s) & (links.to_id == w.w)).groupBy(level.s, level.v).agg(F.sum(level.sigma / w.sw * (1 + w.dw)).alias("delta"))
        done.append(delta.where("s <> v").select("v", "delta"))
        delta, _ = store(level.join(share, ["s", "v"], "left").select("s", "v", "sigma", F.coalesce("delta", F.lit(0.0)).alias("delta")), "delta")
    done.append(delta.where("s <> v").select("v", "delta"))
    all_ = done[0]
    for more in done[1:]:
        all_ = all_.unionByName(more)
    score = all_.groupBy("v").agg(F.sum("delta").alias("d"))
    return ids.join(score, ids.id == score.v, "left").select("id", (F.coalesce("d", F.lit(0.0)) * scale).alias("score"))
