"""Checks of tables in single passes, drift against a baseline, and differences of manifests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from khayt.functions import arabic as A


def null_shares(df: DataFrame, name: str) -> DataFrame:
    """(table_name, column_name, rows, null_pct): one pass over the table."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(df.columns)])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("k")) for i, c in enumerate(df.columns)])
    pct = F.coalesce(F.try_divide(F.lit(100.0) * (F.col("_n") - F.col("k")), F.col("_n")), F.lit(0.0))
    return counts.select("_n", F.inline(cells)).select(F.lit(name).alias("table_name"), "column_name", F.col("_n").alias("rows"), F.round(pct, 2).alias("null_pct"))


def table_checks(df: DataFrame, name: str, key: str, arabic: Sequence[str] = (), texts: Sequence[str] = (), numbers: Sequence[str] = ()) -> DataFrame:
    """(table_name, check, value): duplicate keys, shares of Arabic, blank texts and filled numbers; one aggregation."""
    n, empty = F.count(F.lit(1)), lambda c: F.trim(F.regexp_replace(c, "[\t\n\r]", " ")) == ""
    made = {"duplicate_ids": n - F.count_distinct(key) - F.max(F.col(key).isNull().cast("int"))}
    made |= {f"arabic_pct_{c}": F.round(F.coalesce(F.try_divide(F.lit(100.0) * F.count_if(A.is_arabic(F.col(c))), F.count(c)), F.lit(0.0)), 2) for c in arabic}
    made |= {f"empty_{c}": F.count_if(F.coalesce(empty(c), F.lit(True))) for c in texts}
    made |= {f"coverage_pct_{c}": F.round(F.coalesce(F.try_divide(F.lit(100.0) * F.count(c), n), F.lit(0.0)), 2) for c in numbers}
    row = df.agg(*[v.cast("double").alias(k) for k, v in made.items()])
    return row.select(F.inline(F.array(*[F.struct(F.lit(name).alias("table_name"), F.lit(k).alias("check"), F.col(k).alias("value")) for k in made])))


def out_of_domain(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """(column_name, value, rows) of values that are not in the column's domain; null is none."""
    parts = [df.where(F.col(c).isNotNull() & ~F.col(c).isin(*v)).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(c).alias("column_name"), "value", "rows") for c, v in domains.items()]
    return reduce(DataFrame.unionByName, parts)


def drift(current: DataFrame, baseline: DataFrame, tolerance: float = 30.0) -> DataFrame:
    """(metric, baseline, value, drift_pct, within) by metric; a baseline of zero drifts wholly or not at all."""
    met = baseline.select("metric", F.col("value").alias("baseline")).join(current.select("metric", "value"), "metric")
    pct = F.when(F.col("baseline") != 0, F.round(F.lit(100.0) * F.abs(F.col("value") - F.col("baseline")) / F.abs("baseline"), 2)).when(F.col("value") == 0, 0.0).otherwise(100.0)
    return met.select("metric", "baseline", "value", pct.alias("drift_pct")).withColumn("within", F.col("drift_pct") <= tolerance)


def provenance_violations(df: DataFrame, required: Sequence[str], corpora: Sequence[str]) -> DataFrame:
    """(violation, rows) of rows that lack a required value or name an unknown corpus."""
    bad = {f"null_{c}": F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")) for c in required} | {"unknown_corpus": F.count_if(~F.col("source_corpus").isin(*corpora))}
    return df.agg(*[v.alias(k) for k, v in bad.items()]).select(F.inline(F.array(*[F.struct(F.lit(k).alias("violation"), F.col(k).alias("rows")) for k in bad])))


def unrouted(df: DataFrame, column: str, routed: Sequence[str]) -> list[str]:
    """Values of a column that no route takes; the list is of corpora, a closed set."""
    return [r[0] for r in df.where(F.col(column).isNotNull() & ~F.col(column).isin(*routed)).select(column).distinct().limit(100).collect()]


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, digest) of the files of a folder, read as binary by the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("size"), F.md5("content").alias("digest"))


def compare_manifests(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(path, state): added, modified, unchanged or removed."""
    met = current.select("path", F.col("digest").alias("now")).join(previous.select("path", F.col("digest").alias("was")), "path", "full")
    return met.select("path", F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("now") != F.col("was"), "modified").otherwise("unchanged").alias("state"))


def fingerprint(df: DataFrame) -> DataFrame:
    """(rows, digest): a digest of a table's content in any order."""
    h = F.xxhash64(*df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(h).alias("digest"), F.sum(h.cast("decimal(20,0)")).cast("string").alias("total"))
