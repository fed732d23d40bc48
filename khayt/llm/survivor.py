"""Field-by-field survivorship: one aggregation, per field the maximum of a struct that orders the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_value(value: Column, blanks: Sequence[str] = ("", "unknown")) -> Column:
    """Trimmed and in lower case; null if nothing is left or it is a placeholder."""
    text = F.lower(F.regexp_replace(value.cast("string"), r"(?U)^\s+|\s+$", ""))
    return F.when(~text.isin(*blanks), text)


def survivors(rows: DataFrame, key: str, when: Column, fields: Mapping[str, tuple[Column, Column, Mapping[str, Column]]], least_rows: int = 2) -> DataFrame:
    """(key, field_name, field_value): the surviving value of each field of every key with at least ``least_rows`` rows.

    fields: name -> (value, priority, followers). The row that wins has a value, then the highest priority, then the latest time, then the greatest value and followers
    (so ties and repeated rows give one result in any order); a missing priority or time is lowest. Followers are values of the row that won, under their own names.
    A field without any value has no row, nor has a key that is null. Values come as text. An empty table gives no rows; columns that are not named are not read.
    """
    best = {}
    for name, (value, priority, followers) in fields.items():
        best[name] = F.max(F.struct(value.isNotNull().alias("is"), priority.alias("p"), when.alias("t"), value.alias("v"), *[x.alias(f"f_{n}") for n, x in followers.items()])).alias(f"b_{name}")
    one = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(key)).agg(F.count(F.lit(1)).alias("_n"), *best.values()).where(F.col("_n") >= least_rows)
    cells = []
    for name, (_, _, followers) in fields.items():
        got = F.col(f"b_{name}")
        for field, at in ((name, "v"), *((n, f"f_{n}") for n in followers)):
            cells.append(F.struct(F.lit(field).alias("field_name"), F.when(got["is"], got[at].cast("string")).alias("field_value")))
    return one.select(key, F.inline(F.array(*cells))).where(F.col("field_value").isNotNull())


def narrator_survivors(canonical: DataFrame) -> DataFrame:
    """Death year with its provenance, generation and gender of narrators delivered several times under one canonical_id.

    The year comes from the row whose provenance is best, the latest among equals; provenance is that row's; generation and gender come each from the latest row with a value.
    Years outside 1 to 1500 are none.
    """
    said = clean_value(F.col("death_year_provenance"))
    year = F.when(F.col("death_year_ah").between(1, 1500), F.col("death_year_ah"))
    trust = F.when(said == "corroborated", 2).when(said == "uncorroborated", 1).otherwise(0)
    return survivors(
        canonical, "canonical_id", F.col("loaded_at"),
        {
            "death_year_ah": (year, trust, {"death_year_provenance": said}),
            "generation": (clean_value(F.col("generation")), F.lit(0), {}),
            "gender": (clean_value(F.col("gender")), F.lit(0), {}),
        },
    )
