"""References to records that do not exist: parent keys compressed to runs, references matched as of the preceding run.

A key is split into a stem and the integer at its end (``corpus:book:17`` -> ``corpus:book:``, 17); the split is one to one, as integers with leading zeros
or more than 18 digits stay in the stem. Sorted parent integers of a stem are compressed to contiguous runs, each with the latest first arrival in it and whether
a key of it was deleted. Referring keys are reduced to one row each, matched as of the preceding run start, and are orphans beyond the run's end. Within a run whose
latest arrival is no later than the key's earliest reference and in which nothing was deleted, a key is sound; only the few keys left are looked up one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from khayt.runtime import small, stored

#: Integers of a stem fall into blocks of this size, so that one stem with very many keys is many sort groups; runs end at block borders.
BLOCK = 1 << 16


def split_key(key: Column) -> tuple[Column, Column]:
    """Stem and trailing integer of a key; -1 where it ends in none."""
    digits = F.regexp_extract(key, r"(?<![0-9])(0|[1-9][0-9]{0,17})$", 1)
    number = F.when(digits == "", F.lit(-1).cast("bigint")).otherwise(digits.cast("bigint"))
    return F.when(digits == "", key).otherwise(F.substring(key, F.lit(1), F.length(key) - F.length(digits))), number


def parent_states(parents: DataFrame, key: Column, loaded: Column, deletions: DataFrame | None = None) -> DataFrame:
    """(key, first_loaded, last_loaded, gone): one row per non-null parent key; gone if a deletion names it and no row was loaded after the last one.

    deletions: (key, deleted_at), in which repeats, unknown keys and old notices may occur.
    """
    states = parents.select(key.alias("key"), loaded.alias("_at")).where(F.col("key").isNotNull()).groupBy("key").agg(F.min("_at").alias("first_loaded"), F.max("_at").alias("last_loaded"))
    if deletions is None:
        return states.withColumn("gone", F.lit(False))
    last = deletions.where(F.col("key").isNotNull() & F.col("deleted_at").isNotNull()).groupBy("key").agg(F.max("deleted_at").alias("deleted_at"))
    return states.join(last, "key", "left").select(
        "key", "first_loaded", "last_loaded", (F.col("deleted_at").isNotNull() & ~F.coalesce(F.col("last_loaded") > F.col("deleted_at"), F.lit(False))).alias("gone")
    )


def runs(states: DataFrame, block: int = BLOCK) -> DataFrame:
    """(stem, block, start, stop, latest, any_gone): the parent keys as contiguous runs of integers per stem and block."""
    stem, number = split_key(F.col("key"))
    cells = states.select(stem.alias("stem"), F.floor(number / block).alias("block"), number.alias("n"), "first_loaded", "gone")
    w = Window.partitionBy("stem", "block").orderBy("n")
    return (
        cells.withColumn("island", F.col("n") - F.row_number().over(w))
        .groupBy("stem", "block", "island")
        .agg(F.min("n").alias("start"), F.max("n").alias("stop"), F.max("first_loaded").alias("latest"), F.max("gone").alias("any_gone"))
        .drop("island")
    )


def unsound_keys(references: DataFrame, states: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, state, first_loaded) of the referred-to keys that are ``missing``, ``deleted``, or there but perhaps late (``check``).

    references: (key, at), one row per reference; reduced to a row per key before anything else, so a hot key is one row.
    """
    asked = references.where(F.col("key").isNotNull()).groupBy("key").agg(F.min(F.col("at")).alias("earliest"), F.max(F.col("at").isNull()).alias("undated"))
    stem, number = split_key(F.col("key"))
    left = asked.select(stem.alias("stem"), F.floor(number / block).alias("block"), number.alias("n"), "key", "earliest", "undated", F.lit(None).cast("struct<start:bigint,stop:bigint,latest:timestamp_ntz,any_gone:boolean>").alias("run"))
    right = runs(states, block).select(
        "stem", "block", F.col("start").alias("n"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("timestamp_ntz").alias("earliest"), F.lit(None).cast("boolean").alias("undated"),
        F.struct("start", "stop", F.col("latest").cast("timestamp_ntz").alias("latest"), "any_gone").alias("run"),
    )
    # A run sorts before the references at its own start; the run in force is the last one seen.
    w = Window.partitionBy("stem", "block").orderBy("n", F.col("key").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = (
        left.withColumn("earliest", F.col("earliest").cast("timestamp_ntz")).unionByName(right)
        .withColumn("run", F.last("run", ignorenulls=True).over(w))
        .where(F.col("key").isNotNull())
    )
    there = F.col("run").isNotNull() & (F.col("n") <= F.col("run.stop"))
    sound = there & ~F.col("run.any_gone") & ~F.col("undated") & F.coalesce(F.col("run.latest") <= F.col("earliest"), F.lit(False))
    met = met.where(~F.coalesce(sound, F.lit(False))).select("key", F.coalesce(there, F.lit(False)).alias("there"))
    return met.join(states, "key", "left").select(
        "key", F.when(~F.col("there"), "missing").when(F.col("gone"), "deleted").otherwise("check").alias("state"), F.col("first_loaded")
    )


def orphan_references(children: DataFrame, record: Column, key: Column, at: Column, states: DataFrame, block: int = BLOCK) -> DataFrame:
    """(record_id, missing_key, period, state), distinct: the references of children to keys that are not there.

    state: ``missing`` if the key has no row; else ``deleted`` if its deletion was the last thing that befell it; else ``late`` if it first came after the referring
    row. period is the month of the referring row. Null keys refer to nothing and are left out; a null record or time gives an empty string; a reference without a time is
    never late. Empty tables: no references, no rows; no parents, all are missing. Further columns of either side are not read.
    """
    refs = children.select(F.coalesce(record, F.lit("")).alias("record_id"), key.alias("key"), at.alias("at")).where(F.col("key").isNotNull())
    states = stored(states, "parents")
    bad = small(unsound_keys(refs.select("key", "at"), states, block), "unsound")
    state = F.when(F.col("state") != "check", F.col("state")).when(F.col("first_loaded") > F.col("at"), "late")
    return (
        refs.join(bad, "key")
        .select("record_id", F.col("key").alias("missing_key"), F.coalesce(F.date_format("at", "yyyy-MM"), F.lit("")).alias("period"), state.alias("state"))
        .where(F.col("state").isNotNull())
        .distinct()
    )
