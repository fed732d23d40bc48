"""Ordered sequences: neighbours, consecutive pairs, firsts, ordinals, bands; and interval overlaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], by: Sequence[str], others: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``by`` columns, ties broken by the other columns; one aggregation, no sort of a key's rows."""
    best = F.max(F.struct(*by, *[c for c in others if c not in by])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in [*by, *[c for c in others if c not in by]]])


def consecutive_pairs(df: DataFrame, group: Sequence[str], order: Sequence[str], item: str, keep: Sequence[str] = ()) -> DataFrame:
    """(group, from_item, to_item, keep): each item with the next in its sequence. Null items are passed over, so gaps are bridged; an item before itself makes no pair, and is not bridged."""
    w = Window.partitionBy(*group).orderBy(*order)
    return (
        df.where(F.col(item).isNotNull())
        .select(*group, *[c for c in keep if c not in group], F.col(item).alias("from_item"), F.lead(item).over(w).alias("to_item"))
        .where(F.col("to_item").isNotNull() & (F.col("from_item") != F.col("to_item")))
    )


def neighbours(df: DataFrame, group: Sequence[str], order: Sequence[str], item: str) -> DataFrame:
    """All columns with ``previous`` and ``following``: the nearest items that are not null; null where it would be the row's own item."""
    w = Window.partitionBy(*group).orderBy(*order)
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    return df.withColumn("previous", F.nullif(F.last(item, ignorenulls=True).over(before), F.col(item))).withColumn("following", F.nullif(F.first(item, ignorenulls=True).over(after), F.col(item)))


def first_of(df: DataFrame, group: Sequence[str], order: Sequence[str], item: str) -> DataFrame:
    """(group, item): the first item of each sequence that is not null, by aggregation alone."""
    return df.where(F.col(item).isNotNull()).groupBy(*group).agg(F.min_by(F.col(item), F.struct(*order)).alias(item))


def collected(df: DataFrame, group: Sequence[str], order: Sequence[str], item: str) -> DataFrame:
    """(group, items, length): the sequence as an array."""
    got = F.array_sort(F.collect_list(F.struct(*order, F.col(item).alias("_item"))))
    return df.where(F.col(item).isNotNull()).groupBy(*group).agg(F.transform(got, lambda x: x["_item"]).alias("items")).withColumn("length", F.size("items"))


def pairs_in_list(items: Column) -> Column:
    """Array of struct(position, from_item, to_item) of the consecutive elements of an array."""
    return F.filter(
        F.transform(items, lambda x, i: F.struct(i.alias("position"), x.alias("from_item"), F.get(items, i + 1).alias("to_item"))), lambda p: p["to_item"].isNotNull() & (p["from_item"] != p["to_item"])
    )


def ordinals(df: DataFrame, group: Sequence[str], order: Sequence[str], number: str, reliable: Column) -> DataFrame:
    """The number filled from the row's place in its group, only where no row of the group has one and the order is reliable."""
    known = F.max(number).over(Window.partitionBy(*group))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(number, F.when(reliable & known.isNull(), place).otherwise(F.col(number)))


def bands(df: DataFrame, group: Sequence[str], value: str, tie: Sequence[str], gap: int) -> DataFrame:
    """All columns with ``band``, from 0: a new one opens where a value lies more than ``gap`` above the one before it."""
    w = Window.partitionBy(*group).orderBy(value, *tie)
    opens = F.when(F.col(value) - F.lag(value).over(w) > gap, 1).otherwise(0)
    return df.withColumn("_opens", opens).withColumn("band", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_opens")


def overlaps(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str], width: int = 64) -> DataFrame:
    """All pairs whose closed integer intervals overlap, with the columns of both sides (their names must differ).

    Intervals are cut into cells of ``width`` and joined on the cell; a pair is kept only in the cell where the later of the two starts, so it comes once. Rows with a null
    or reversed interval overlap nothing.
    """

    def cells(df: DataFrame, span: tuple[str, str]) -> DataFrame:
        a, b = F.col(span[0]), F.col(span[1])
        return df.where(a <= b).withColumn("_cell", F.explode(F.sequence(F.floor(a / width), F.floor(b / width))))

    met = cells(left, left_span).join(cells(right, right_span), "_cell")
    start = F.greatest(F.col(left_span[0]), F.col(right_span[0]))
    return met.where((F.col(left_span[0]) <= F.col(right_span[1])) & (F.col(right_span[0]) <= F.col(left_span[1])) & (F.col("_cell") == F.floor(start / width))).drop("_cell")
