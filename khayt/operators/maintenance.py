"""Upkeep of finished tables: stale measures, old ids, cleaned names with what hangs on them, collection facts, topics, samples."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from khayt.functions import scalars as S
from khayt.functions.names import clean_name_udf


def invalidate(nodes: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Measures that follow from the edges set to null, to be worked out anew; a name that is no column is refused."""
    if unknown := set(measures) - set(nodes.columns):
        raise ValueError(f"no such measures: {sorted(unknown)}")
    return nodes.withColumns({m: F.lit(None).cast(nodes.schema[m].dataType) for m in measures})


def undouble(hadith_id: Column) -> Column:
    """An id of the old form with its corpus written twice, once; all others as they are. Only for migrating what is stored."""
    bare = F.regexp_replace(hadith_id, "^hdt:", "")
    parts = F.split(bare, ":")
    again = S.is_doubled(hadith_id) & (F.size(parts) > 2)
    return F.when(hadith_id.isNull(), None).otherwise(F.concat(F.lit("hdt:"), F.when(again, F.array_join(F.slice(parts, F.lit(2), F.size(parts)), ":")).otherwise(bare)))


def migrate_ids(edges: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The edges with ids of the new form, and (old_id, new_id, edges) of those that changed."""
    new = undouble(F.col(column))
    changed = edges.select(F.col(column).alias("old_id"), new.alias("new_id")).where("old_id <> new_id").groupBy("old_id", "new_id").agg(F.count(F.lit(1)).alias("edges"))
    return edges.withColumn(column, new), changed


def scrub_names(records: DataFrame, mentions: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Names of records (id, name, ..) cleaned again; a record whose name is none goes, with the mentions (.., person) and links (.., a, b) that name it."""
    cleaned = records.withColumn("name", clean_name_udf("name"))
    gone = cleaned.where("name is null").select("id")
    kept_links = links.join(gone.withColumnRenamed("id", "a"), "a", "left_anti").join(gone.withColumnRenamed("id", "b"), "b", "left_anti")
    return cleaned.where("name is not null"), mentions.join(gone.withColumnRenamed("id", "person"), "person", "left_anti"), kept_links


def fill_collections(collections: DataFrame, facts: DataFrame, columns: Sequence[str] = ("compiler_name", "compilation_year_ah", "expected_count")) -> DataFrame:
    """Facts from a curated table (slug, ..) where a collection has none; nothing is overwritten."""
    slug = F.element_at(F.split("collection_id", ":"), -1)
    f = facts.dropDuplicates(["slug"]).select("slug", *[F.col(c).alias(f"_{c}") for c in columns])
    met = collections.withColumn("slug", slug).join(f, "slug", "left")
    return met.select(*[F.coalesce(c, f"_{c}").alias(c) if c in columns else F.col(c) for c in collections.columns])


def topics(texts: DataFrame, key: str, text: str, words: Mapping[str, Sequence[str]], k: int = 3, least_length: int = 20) -> DataFrame:
    """(key, place, topic, score): the k topics with most of their words in a text, by share; shorter texts have none. A keyword scorer stands where no model is at hand."""
    tokens = F.split(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}]+", " "), " ")
    t = texts.where(F.length(text) >= least_length).select(key, tokens.alias("_t"))

    def share(of: Sequence[str]) -> Column:
        return F.size(F.filter("_t", lambda x: x.isin(*of))) / F.size("_t")

    scored = [F.struct(share(w).alias("score"), F.lit(n).alias("topic")) for n, w in words.items()]
    best = F.slice(F.array_sort(F.filter(F.array(*scored), lambda s: s["score"] > 0), lambda a, b: F.when(a["score"] != b["score"], F.when(a["score"] > b["score"], -1).otherwise(1)).otherwise(F.when(a["topic"] < b["topic"], -1).otherwise(1))), 1, k)
    return t.select(key, F.posexplode(best).alias("i", "b")).select(key, (F.col("i") + 1).alias("place"), "b.topic", "b.score")


def sample(df: DataFrame, key: str, n: int = 100, seed: int = 42) -> DataFrame:
    """n rows by a seeded hash of their key: the same rows each time."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)


@F.pandas_udf(StringType())
def blake2b(text: pd.Series) -> pd.Series:
    """The 8-byte digest of book keys, in hex."""
    return pd.Series([None if t is None else hashlib.blake2b(t.encode(), digest_size=8).hexdigest() for t in text], dtype="object")
