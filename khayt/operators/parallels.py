"""Near-duplicate texts and vectors: set-similarity join by prefix filter, top-k cosine search in blocks, union with precedence."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from khayt.functions import arabic as A
from khayt.functions import scalars as S
from khayt.runtime import stored


def tokens(matn_ar: Column, matn_en: Column) -> Column:
    """Sorted distinct words of the Arabic text, else of the English one; empty without either."""
    text = F.when(A.is_arabic(matn_ar), A.normalize_arabic(matn_ar)).when(F.trim(matn_en) != "", A.clean_whitespace(F.lower(matn_en)))
    return F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda t: t != "")))


def token_classes(rows: DataFrame, key: str, items: Column, mark: Column | None = None) -> DataFrame:
    """(key, class_id, tokens, mark): rows with equal token sets share a class, named by its smallest key; rows without tokens have none. Equal sets meet by digest, so copies cost a row each."""
    r = rows.select(F.col(key).alias("key"), items.alias("tokens"), (mark if mark is not None else F.lit(None).cast("string")).alias("mark")).where((F.size("tokens") > 0) & F.col("key").isNotNull())
    r = r.groupBy("key").agg(F.max_by("tokens", F.size("tokens")).alias("tokens"), F.max("mark").alias("mark"))
    r = r.withColumn("digest", F.sha2(F.array_join("tokens", "\x01"), 256))
    names = r.groupBy("digest").agg(F.min("key").alias("class_id"))
    return r.join(names, "digest").select("key", "class_id", "tokens", "mark")


def similar_classes(classes: DataFrame, threshold: float = 0.5, max_df: int | None = 500) -> DataFrame:
    """(class_a, class_b, score): pairs of classes, a < b, whose token sets have a Jaccard similarity of at least ``threshold`` and share a word of at most ``max_df`` texts.

    Exact: words are ordered by rarity, and two sets so similar share one of the first ``n - ceil(t n) + 1`` words of each; only those are joined, then every pair is measured. The
    rarity bound is part of what a pair is (frequent words alone make none), and is checked on the pair. Copies are one class.
    """
    size = classes.groupBy("class_id").agg(F.count(F.lit(1)).alias("copies"), F.any_value("tokens").alias("tokens"))
    size = stored(size, "classes")
    words = size.select("class_id", "copies", F.explode("tokens").alias("t"))
    df = words.groupBy("t").agg(F.sum("copies").alias("df"))
    ranked = (
        words.join(df, "t").groupBy("class_id").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("ranked"))
        .select("class_id", F.size("ranked").alias("n"), F.transform("ranked", lambda x: x["t"]).alias("words"), F.size(F.filter("ranked", lambda x: x["df"] <= (max_df if max_df is not None else 2**62))).alias("rare"))
    )
    ranked = stored(ranked.where("rare > 0"), "ranked")
    # A head that reaches past a set's rare words holds all of them, so two sets that share a rare word, and a word of their heads, share a rare word of their heads.
    keep = F.least("rare", F.col("n") - F.ceil(F.lit(threshold) * F.col("n")) + 1)
    heads = ranked.select("class_id", "n", F.posexplode(F.slice("words", F.lit(1), keep.cast("int"))).alias("at", "t"))
    a, b = (heads.select(F.col("class_id").alias(f"class_{x}"), F.col("n").alias(f"n_{x}"), F.col("at").alias(f"at_{x}"), "t") for x in "ab")
    # What follows the first shared word bounds the overlap of two sets; it must reach what the threshold asks of their sizes.
    enough = (1 + F.least(F.col("n_a") - F.col("at_a") - 1, F.col("n_b") - F.col("at_b") - 1)) * F.lit(1 + threshold) + 1e-9 >= F.lit(threshold) * (F.col("n_a") + F.col("n_b"))
    met = a.join(b, "t").where((F.col("class_a") < F.col("class_b")) & (F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b")) & enough).select("class_a", "class_b").distinct()
    sides = [ranked.select(F.col("class_id").alias(f"class_{x}"), F.col("words").alias(f"w_{x}"), F.slice("words", F.lit(1), F.col("rare")).alias(f"r_{x}")) for x in "ab"]
    met = met.join(sides[0], "class_a").join(sides[1], "class_b")
    common = F.size(F.array_intersect("w_a", "w_b"))
    score = common / (F.size("w_a") + F.size("w_b") - common)
    return met.where(F.arrays_overlap("r_a", "r_b")).select("class_a", "class_b", score.alias("score")).where(F.col("score") >= threshold)


def cosine_search(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 50, least: float = 0.7, query_block: int = 4096, data_block: int = 65536) -> DataFrame:
    """(query, key, score): for each query vector its k most similar others with a cosine of at least ``least``; ties go to the smaller key.

    Queries and data are cut into blocks of bounded size and each pair of blocks is one matrix product; each query keeps its best k of a block, then its best k of all. Null and
    zero vectors match nothing. A query does not meet itself.
    """
    nq, nd = queries.count(), vectors.count()
    q_parts, d_parts = max(1, math.ceil(nq / query_block)), max(1, math.ceil(nd / data_block))

    def pick(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        got = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).cast("array<float>").alias("vector"))
        return got.withColumn(own, F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        column = t["vector"].combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        m = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(t), -1) if len(t) else np.zeros((0, 1))
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        return t["key"].to_numpy(), np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)

    def meet(data: pa.Table, asked: pa.Table) -> pa.Table:
        ids, m = matrix(data)
        qids, q = matrix(asked)
        rows: list[tuple] = []
        if len(ids) and len(qids):
            for i in range(0, len(qids), 256):
                scores = q[i : i + 256] @ m.T
                for row, qid in zip(scores, qids[i : i + 256], strict=True):
                    hit = np.flatnonzero((row >= least - 1e-9) & (ids != qid))
                    best = hit[np.lexsort((ids[hit], -row[hit]))][:k]
                    rows += [(qid, ids[j], row[j]) for j in best]
        cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
        return pa.table({"query": pa.array(cols[0], pa.int64()), "key": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    left, right = pick(vectors, "d", d_parts, "q", q_parts), pick(queries, "q", q_parts, "d", d_parts)
    found = left.groupBy("d", "q").cogroup(right.groupBy("d", "q")).applyInArrow(meet, "query bigint, key bigint, score double")
    w = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    return found.where(F.col("score") >= least).withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).drop("place")


def assign_centroids(vectors: DataFrame, key: str, vector: str, lists: int = 100, sample: int = 20_000, rounds: int = 8, seed: int = 42) -> tuple[DataFrame, np.ndarray]:
    """(key, vector, list): every vector in the list of its nearest centroid. Centroids are fitted by k-means on a sample of bounded size; all vectors are indexed."""
    rows = vectors.where(F.col(vector).isNotNull()).orderBy(F.xxhash64(F.lit(seed), key)).limit(sample).select(vector).toPandas()[vector]
    m = np.stack([np.asarray(v, np.float64) for v in rows]) if len(rows) else np.zeros((1, 1))
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    centre = m[np.random.default_rng(seed).permutation(len(m))[: min(lists, len(m))]]
    for _ in range(rounds):
        near = (m @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, near, m)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(norm > 0, total / np.maximum(norm, 1e-12), centre)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            x = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), v, pa.array((x @ centre.T).argmax(axis=1), pa.int32())], names=["key", "vector", "list"])

    src = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<float>").alias("vector"))
    return src.mapInArrow(work, "key bigint, vector array<float>, list int"), centre


def inverted_search(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 50, least: float = 0.7, lists: int | None = None, probes: int | None = None, sample: int = 20_000) -> DataFrame:
    """As ``cosine_search``, each query looked up only in the lists of its ``probes`` nearest centroids. Not exact; recall is measured against the exact search in the tests and by a query.

    There are as many lists as the square root of the vectors unless ``lists`` says otherwise, so that a list grows as slowly as their number; a third of the lists are looked up
    unless ``probes`` says otherwise.
    """
    lists = lists or max(1, math.ceil(math.sqrt(vectors.count())))
    probes = probes or max(1, math.ceil(lists / 3))
    indexed, centre = assign_centroids(vectors, key, vector, lists, sample)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            x = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            near = np.argsort(-(x @ centre.T), axis=1)[:, :probes]
            at = np.repeat(np.arange(batch.num_rows), near.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), v.take(pa.array(at)), pa.array(near.ravel(), pa.int32())], names=["query", "asked", "list"])

    asked = queries.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("bigint"), F.col(vector).cast("array<float>")).mapInArrow(probe, "query bigint, asked array<float>, list int")
    dot = F.aggregate(F.zip_with("vector", "asked", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda a, x: a + x)
    norms = [F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))) for c in ("vector", "asked")]
    met = indexed.join(asked, "list").where("key <> query").select("query", "key", F.try_divide(dot, norms[0] * norms[1]).alias("score")).where(F.col("score") >= least)
    w = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    return met.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).drop("place")


def compose(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union of links (hadith_id_a, hadith_id_b, similarity_score, variant_type, cross_sect) by pair; where both have one, the first's row stands. Pairs are put in order; self pairs fall out."""
    both = first.withColumn("_p", F.lit(0)).unionByName(second.withColumn("_p", F.lit(1)))
    a, b = F.least("hadith_id_a", "hadith_id_b"), F.greatest("hadith_id_a", "hadith_id_b")
    rows = both.select(a.alias("hadith_id_a"), b.alias("hadith_id_b"), F.struct("_p", (-F.col("similarity_score")).alias("s"), "similarity_score", "variant_type", "cross_sect").alias("x")).where("hadith_id_a <> hadith_id_b")
    return rows.groupBy("hadith_id_a", "hadith_id_b").agg(F.min("x").alias("x")).select("hadith_id_a", "hadith_id_b", "x.similarity_score", "x.variant_type", "x.cross_sect")


def links(pairs: DataFrame, a: str, b: str, score: Column, sect_a: Column, sect_b: Column) -> DataFrame:
    """Links with their tier; the score is stored as a float after its tier has been told."""
    return pairs.select(F.col(a).alias("hadith_id_a"), F.col(b).alias("hadith_id_b"), score.cast("float").alias("similarity_score"), S.variant_type(score).alias("variant_type"), S.cross_sect(sect_a, sect_b).alias("cross_sect"))
