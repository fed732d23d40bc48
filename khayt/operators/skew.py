"""Per-key results where a handful of keys hold most rows: eager aggregation through joins.

Both inputs of a join are first reduced to one compact state per join key (and output group), the states are joined, and counts and sums are
combined algebraically: a group's joined row count is the sum of left count x right count, a joined sum is left sum x right count. No joined row is
ever built, so a hot key costs as many rows as it has states, not as many as it has records. Aggregation is partial before each shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from khayt.runtime import stored


def _state(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], tag: str) -> DataFrame:
    """One row a key: the number of rows and of each value its sum and how many were not null."""
    made = [F.count(F.lit(1)).alias(f"_{tag}n")]
    for name, value in sums.items():
        made += [F.sum(value).alias(f"_{tag}s_{name}"), F.count(value).alias(f"_{tag}c_{name}")]
    return df.groupBy(*keys).agg(*made)


def eager_join_aggregate(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    by_left: Sequence[str] = (),
    by_right: Sequence[str] = (),
    left_sums: Mapping[str, Column] | None = None,
    right_sums: Mapping[str, Column] | None = None,
    how: str = "inner",
) -> DataFrame:
    """What ``left JOIN right ON .. GROUP BY by_left, by_right`` gives, without building the join.

    on: pairs (left column, right column). Result: the group columns, ``rows`` (joined rows), ``left_rows`` (left rows that take part, each once for each of its
    right groups), ``keys`` (distinct join keys without null among these), and of each named value ``sum_<name>`` and ``count_<name>`` over the joined rows (sums of floats are doubles).

    how: ``inner`` or ``left``. With ``left``, a left row without partner counts once, its right columns null. Null join keys match nothing.
    Empty inputs give an empty result; further columns are ignored, as only those named are read, renamed so that clashing names do no harm.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how!r}")
    left_sums, right_sums = dict(left_sums or {}), dict(right_sums or {})
    ls = left.select(
        *[F.col(a).alias(f"_k{i}") for i, (a, _) in enumerate(on)], *[F.col(c).alias(f"_l_{c}") for c in by_left], *[v.alias(f"_lv_{n}") for n, v in left_sums.items()]
    )
    rs = right.select(
        *[F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(on)], *[F.col(c).alias(f"_r_{c}") for c in by_right], *[v.alias(f"_rv_{n}") for n, v in right_sums.items()]
    )
    keys = [f"_k{i}" for i in range(len(on))]
    if how == "inner":
        ls = ls.dropna(subset=keys)
    a = _state(ls, [*keys, *[f"_l_{c}" for c in by_left]], {n: F.col(f"_lv_{n}") for n in left_sums}, "a")
    b = _state(rs.dropna(subset=keys), [*keys, *[f"_r_{c}" for c in by_right]], {n: F.col(f"_rv_{n}") for n in right_sums}, "b")
    j = a.join(b, keys, how)
    times = F.coalesce(F.col("_bn"), F.lit(1))
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    # There is one state a key, left group and right group: states are keys.
    out = [F.sum(F.col("_an") * times).alias("rows"), F.sum("_an").alias("left_rows"), F.count_if(whole).alias("keys")]
    for n in left_sums:
        out += [F.sum(F.col(f"_as_{n}") * times).alias(f"sum_{n}"), F.sum(F.col(f"_ac_{n}") * times).alias(f"count_{n}")]
    for n in right_sums:
        out += [F.sum(F.col(f"_bs_{n}") * F.col("_an")).alias(f"sum_{n}"), F.coalesce(F.sum(F.col(f"_bc_{n}") * F.col("_an")), F.lit(0)).alias(f"count_{n}")]
    return j.groupBy(*[F.col(f"_l_{c}").alias(c) for c in by_left], *[F.col(f"_r_{c}").alias(c) for c in by_right]).agg(*out)


def member_profile(rows: DataFrame, key: str, member: str, value: str, members: DataFrame, member_key: str) -> DataFrame:
    """Per key, the null key included: ``rows`` as delivered, ``members`` (distinct non-null ones), ``on_record`` (rows whose member has a row in ``members``) and the ``total`` and
    ``valued`` (how many) of the non-null values.

    An eager left join on the member: rows become one state per member and key, in which a hot key is spread over its members, ``members`` one state per member; the states are
    joined, counts and sums combined and rolled up per key. Empty rows give no rows, empty members leave ``on_record`` 0. Ties and repeated rows count as they come.
    """
    known = members.select(F.col(member_key).alias("_m")).where(F.col("_m").isNotNull()).distinct()
    got = eager_join_aggregate(
        rows.select(F.col(key).alias("_key"), F.col(member).alias("_member"), F.col(value).cast("double").alias("_value")), known.withColumn("_one", F.lit(1)), [("_member", "_m")],
        by_left=["_key"], left_sums={"value": F.col("_value")}, right_sums={"one": F.col("_one")}, how="left",
    )
    return got.select(
        F.col("_key").alias(key), F.col("left_rows").alias("rows"), F.col("keys").alias("members"), F.col("count_one").alias("on_record"), F.col("sum_value").alias("total"), F.col("count_value").alias("valued")
    )


def heavy_keys(profile: DataFrame, key: str, one_in: int) -> DataFrame:
    """Of a profile of keys, its null key included, those that hold at least one in ``one_in`` of all rows: (key, rows, total_rows).

    The profile is stored, and the total is rolled up from it and joined back as a single row. Empty profile: no rows. The null key counts in the total and is no key itself.
    """
    states = stored(profile.select(key, "rows"), "profile")
    total = states.agg(F.sum("rows").alias("total_rows"))
    return states.where(F.col(key).isNotNull()).join(F.broadcast(total), F.col("rows") * F.lit(one_in) >= F.col("total_rows"))
