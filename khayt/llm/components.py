"""Groups from pairwise links: alternating large-star and small-star rewrites until nothing changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from khayt.runtime import release, store


#: A node with more links than the larger of these (a number, a share of all links) is a hub. There are at most 2 / HUB_SHARE hubs.
HUB_LINKS, HUB_SHARE = 1000, 1 / 500


def _store(edges: DataFrame) -> tuple[DataFrame, str, tuple]:
    """Store edges, and their order-free fingerprint, observed as they are written: how many edges, and the sum and the xor of their hashes."""
    seen, h = Observation(), F.xxhash64("u", "v")
    watched = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(20,0)")).alias("sum"), F.bit_xor(h).alias("xor"))
    out, at = store(watched, "edges")
    return out, at, tuple(seen.get[k] for k in ("n", "sum", "xor"))


def _join_minima(edges: DataFrame, low: DataFrame, hub: int) -> DataFrame:
    """Edges with the minimum ``m`` of their ``u``. low: (u, m, links).

    The minima of hubs are broadcast (they are at most 2 / HUB_SHARE rows) and their links salted, so that no hub's links meet in one task; all other nodes hold a small share.
    """
    hubs = F.broadcast(low.where(F.col("links") > hub).select("u", F.col("m").alias("_hub")))
    known = F.col("_hub").isNotNull()  # these match nothing below and lie by the hash of their other end
    salted = edges.join(hubs, "u", "left").select(F.when(~known, F.col("u")).alias("_u"), F.xxhash64(F.when(known, F.col("v")).otherwise(F.col("u"))).alias("_salt"), "u", "v", "_hub")
    rest = low.where(F.col("links") <= hub).select(F.col("u").alias("_u"), F.xxhash64("u").alias("_salt"), "m")
    return salted.join(rest, ["_u", "_salt"], "left").select("u", "v", F.coalesce("_hub", "m").alias("m"))


def _large_star(edges: DataFrame, hub: int = HUB_LINKS) -> DataFrame:
    """Every node's larger neighbours go to the smallest of its neighbours and itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"), F.count(F.lit(1)).alias("links"))
    larger = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))  # edges come as u > v
    return _join_minima(larger, low, hub).where(F.col("v") != F.col("m")).select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).distinct()


def _small_star(edges: DataFrame, hub: int = HUB_LINKS) -> DataFrame:
    """Every node and its smaller neighbours go to the smallest of them. Edges come as u > v."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("links"))
    moved = _join_minima(edges, low, hub).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected(edges: DataFrame, left: str = "left", right: str = "right", max_rounds: int = 100) -> DataFrame:
    """(id, group_id): each id that is linked to another, with the smallest id of its component.

    Both columns have one orderable type; strings go by code points. Null ends and self links are no links; repeated and reversed pairs count once. An id with no link to
    another has no row. No links or an empty table: no rows. Further columns are not read.

    Each star's edges are stored in the shared folder and those before them deleted. A hub costs a row for each of its links: minima are aggregated before they are shuffled, and those of hubs
    are broadcast to where their links are (see ``_join_minima``).
    """
    spark = edges.sparkSession
    now, at, seen = _store(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right))).distinct()
    )
    for _ in range(max_rounds):
        if not seen[0]:
            break
        last = seen
        for star in (_large_star, _small_star):
            following, to, made = _store(star(now, max(HUB_LINKS, int(seen[0] * HUB_SHARE))))
            release(spark, at)
            now, at, seen = following, to, made
        if seen == last:
            break
    else:
        raise RuntimeError(f"links were still changing after {max_rounds} rounds")
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("group_id"))
    return stars.unionByName(stars.select(F.col("group_id").alias("id"), "group_id").distinct())


def links_by_element(rows: DataFrame, node: str, element: str) -> DataFrame:
    """(left, right): each node tied to the smallest node that has the same element; as many links as occurrences, never all pairs."""
    cells = rows.select(F.col(node).alias("left"), F.col(element).alias("_e")).dropna().distinct()
    # Only elements of at least two nodes make links; min and max tell.
    hubs = cells.groupBy("_e").agg(F.min("left").alias("right"), F.max("left").alias("_last")).where(F.col("right") < F.col("_last")).select("_e", "right")
    return cells.join(hubs, "_e").where(F.col("left") != F.col("right")).select("left", "right")


def with_prefix(key: Column, prefix: str = "nar:") -> Column:
    return F.when(key.startswith(prefix), key).otherwise(F.concat(F.lit(prefix), key))


#: Words that stand for no source id.
NO_ELEMENT = ("", "n/a", "unknown")


def narrator_links(canonical: DataFrame, matches: DataFrame, mentions: DataFrame) -> DataFrame:
    """(left, right): links between canonical ids on record, from accepted matches, shared source ids and mentions resolved in several ways."""
    known = canonical.select("canonical_id").dropna().distinct()
    accepted = matches.where(F.lower("decision") == "accepted").select(with_prefix(F.col("left_id")).alias("left"), with_prefix(F.col("right_id")).alias("right"))
    sources = canonical.select("canonical_id", F.explode("source_ids").alias("e")).select("canonical_id", F.lower(F.regexp_replace("e", r"(?U)^\s+|\s+$", "")).alias("e"))
    shared = links_by_element(sources.where(~F.col("e").isin(*NO_ELEMENT)), "canonical_id", "e")
    twice = links_by_element(mentions.select("canonical_narrator_id", "mention_id"), "canonical_narrator_id", "mention_id")
    links = accepted.unionByName(shared).unionByName(twice).dropna().where(F.col("left") != F.col("right"))
    for end in ("left", "right"):
        links = links.join(known.select(F.col("canonical_id").alias(end)), end, "left_semi")
    return links
