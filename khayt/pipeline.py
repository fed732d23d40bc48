"""Stages from raw files to the graph: a small runner, and the command line."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from enum import IntEnum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from khayt.functions import scalars as S


class Exit(IntEnum):
    """Distinct exit codes; 2 is argparse's own."""

    OK = 0
    FAILED = 1
    MISSING_INPUT = 3
    BAD_ARGUMENT = 4
    FINDINGS = 5
    REFUSED = 6


class MissingInput(RuntimeError):
    """A stage lacks a table it needs."""


@dataclass
class Stage:
    """One step: the tables it needs, and what it makes of them. Without ``resumable`` it cannot be a starting point."""

    name: str
    needs: Sequence[str]
    run: Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]]
    resumable: bool = True


@dataclass
class Outcome:
    ran: list[str] = field(default_factory=list)
    skipped: dict[str, str] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)


def run_stages(stages: Sequence[Stage], tables: dict[str, DataFrame], from_step: str | None = None, only: Sequence[str] = (), skip: Sequence[str] = (), stop_after: str | None = None) -> Outcome:
    """Run stages in order over a table of DataFrames, which grows, from one stage to another if these are named. A failed stage stops those that need its tables, not the others."""
    names = [s.name for s in stages]
    for asked in (*([from_step] if from_step else []), *([stop_after] if stop_after else []), *only, *skip):
        if asked not in names:
            raise ValueError(f"no stage {asked}; stages: {', '.join(names)}")
    if from_step and not next(s for s in stages if s.name == from_step).resumable:
        raise ValueError(f"{from_step} cannot be a starting point")
    out = Outcome()
    started, stopped = from_step is None, False
    for s in stages:
        started, last = started or s.name == from_step, stopped
        stopped = stopped or s.name == stop_after
        if not started or last or s.name in skip or (only and s.name not in only):
            out.skipped[s.name] = "not asked for"
            continue
        if lacking := [t for t in s.needs if t not in tables]:
            out.failed[s.name] = f"missing input: {', '.join(lacking)}"
            continue
        try:
            tables.update(s.run(tables))
            out.ran.append(s.name)
        except Exception as e:  # noqa: BLE001
            out.failed[s.name] = f"{type(e).__name__}: {str(e)[:300]}"
    return out


#: Tables of links that ``load`` takes if the folder has them, and what they become.
LINKS = ("parallel_links", "network_edges")


def graph_stages(links: Sequence[str] = ()) -> list[Stage]:
    """Raw tables to nodes, edges and measures; with the tables named in ``links``, the edges made of them too."""
    from khayt.operators import graph as G

    more = [
        Stage("parallels", ["parallel_links", "n_hadith"], lambda t: {"e_parallel_of": G.parallel_of(t["parallel_links"], t["n_hadith"])}),
        Stage("network", ["network_edges", "n_narrator"], lambda t: {"e_studied_under": G.studied_under(t["network_edges"], t["n_narrator"])}),
    ]
    return [
        Stage("nodes", ["hadiths", "narrators_canonical", "collections"], lambda t: {"n_hadith": G.hadith_nodes(t["hadiths"]), "n_narrator": G.narrator_nodes(t["narrators_canonical"]), "n_collection": G.collection_nodes(t["collections"]), "n_grading": G.grading_nodes(t["hadiths"])}),
        Stage("chains", ["mentions_resolved", "n_hadith"], lambda t: {"mentions": G.surviving_mentions(t["mentions_resolved"], t["n_hadith"])}),
        Stage("edges", ["mentions", "n_hadith", "n_narrator", "n_collection", "n_grading"], lambda t: {"e_transmitted_to": G.transmitted_to(t["mentions"], t["n_narrator"]), "e_narrated": G.narrated(t["mentions"], t["n_narrator"]), "e_appears_in": G.appears_in(t["n_hadith"], t["n_collection"]), "e_graded_by": G.graded_by(t["n_grading"])}),
        *[s for s in more if s.needs[0] in links],
        Stage("metrics", ["e_transmitted_to", "n_narrator"], lambda t: {"m_degree": G.degrees(t["e_transmitted_to"]), "m_rank": G.pagerank(t["n_narrator"], t["e_transmitted_to"]), "m_betweenness": G.betweenness(t["n_narrator"], t["e_transmitted_to"]), "m_community": G.communities(t["e_transmitted_to"])}),
    ]


#: Tables that ``resolve`` takes if the folder has them, and the stages that need them.
CURATED = {"signatures": "contextual", "over_merge_rules": "over_merged", "curated_links": "links", "biographies": "bio_promote"}


def resolve_stages(extra: Sequence[str] = ()) -> list[Stage]:
    """Mentions and records as delivered to mentions and records as they stand, in the order in which they build on each other; with the curated tables named in ``extra``, the stages that need these too.

    Each stage's tables are stored, and are what a later run may start from.
    """
    from khayt.operators import resolution as N
    from khayt.operators import resolve as R
    from khayt.plans import resolve as P
    from khayt.runtime import stored

    def keep(**made: DataFrame) -> dict[str, DataFrame]:
        return {name: stored(df, name) for name, df in made.items()}

    def both(pair: tuple[DataFrame, DataFrame]) -> dict[str, DataFrame]:
        return keep(mentions=pair[0], records=pair[1])

    def disambiguate(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        names = t["mentions"].where("person is null").select(F.coalesce("name_ar", "name_en").alias("mention"), "name_ar", "name_en").where("mention is not null").distinct()
        made = keep(matches=N.name_matches(names, t["records"]))
        return made | keep(mentions=N.back_fill(t["mentions"], N.disambiguate(t["mentions"], t["records"], made["matches"])))

    def flagged(t: Mapping[str, DataFrame]) -> DataFrame:
        return t["narrators_canonical"].where("over_merged").select(S.with_prefix(F.col("canonical_id"), "nar:").alias("id")).distinct()

    core = ["mentions", "records"]
    stages = [
        Stage("mentions", ["mentions_resolved"], lambda t: keep(mentions=P.mention_rows(t["mentions_resolved"])), resumable=False),
        Stage("records", ["narrators_canonical"], lambda t: keep(records=P.person_records(t["narrators_canonical"])), resumable=False),
        Stage("disambiguate", core, disambiguate),
        Stage("bio_promote", ["records", "biographies"], lambda t: keep(records=R.promote(t["records"], t["biographies"], "id", [c for c in t["records"].columns if c not in ("id", "keys")], ["keys"]).select(*t["records"].columns))),
        Stage("cluster", core, lambda t: both(N.cluster(t["mentions"], t["records"]))),
        Stage("narrator_split", core, lambda t: both(N.split(t["mentions"], t["records"]))),
        Stage("contextual", ["mentions", "signatures"], lambda t: keep(mentions=N.contextual(t["mentions"], t["signatures"]))),
        Stage("reconcile", ["records", "narrators_canonical"], lambda t: keep(records=N.dated(t["records"], P.death_observations(t["narrators_canonical"])))),
        Stage("generation_dates", ["records"], lambda t: keep(records=N.dated_by_generation(t["records"]))),
        Stage("unify", [*core, "narrator_matches", "narrators_canonical"], lambda t: both(N.unify(t["mentions"], t["records"], P.accepted_pairs(t["narrator_matches"]), flagged(t)))),
        Stage("over_merged", ["records", "over_merge_rules"], lambda t: keep(flags=R.flag_over_merged(t["records"], t["over_merge_rules"]).where("over_merged").select("id", "over_merge_note"))),
        Stage("links", ["records", "curated_links"], lambda t: keep(links=R.curated_links(t["curated_links"], t["records"]))),
        Stage("measures", [*core, "matches"], lambda t: keep(measures=N.measures(t["mentions"], t["records"], t["matches"]))),
    ]
    left_out = {stage for name, stage in CURATED.items() if name not in extra}
    return [s for s in stages if s.name not in left_out]


#: What ``resolve`` writes, and reads back where it starts from a later stage.
RESOLVED = ("mentions", "records", "matches", "measures", "flags", "links")


def main(argv: Sequence[str] | None = None) -> int:
    from khayt.runtime import exists, session, stored, table
    from khayt.sources import adapters, views
    from khayt.sources.sinks import write_staged

    p = argparse.ArgumentParser(prog="khayt")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("parse", help="raw folders to staging tables")
    a.add_argument("raw")
    a.add_argument("out")
    a.add_argument("--only", nargs="*", default=None)
    g = sub.add_parser("load", help="tables to graph tables")
    g.add_argument("data")
    g.add_argument("out")
    g.add_argument("--from-step")
    g.add_argument("--skip", nargs="*", default=[])
    r = sub.add_parser("resolve", help="mentions and records to mentions and records as they stand")
    r.add_argument("data")
    r.add_argument("out")
    r.add_argument("--from-step")
    r.add_argument("--stop-after")
    q = sub.add_parser("sql", help="one query over the views of folders")
    q.add_argument("query")
    q.add_argument("--layer", action="append", default=[], help="name=folder")
    v = sub.add_parser("validate", help="checks of a data directory")
    v.add_argument("data")
    args = p.parse_args(argv)
    spark = SparkSession.getActiveSession() or session()
    if args.command == "parse":
        tables, failed = adapters.parse_all(spark, args.raw, args.only)
        for name, df in tables.items():
            write_staged(df, name, f"{args.out}/{name}")
        for slug, why in failed.items():
            print(f"{slug}: {why}", file=sys.stderr)
        return Exit.FAILED if failed else Exit.OK
    if args.command == "load":
        tables = {n: table(spark, args.data, n) for n in ("hadiths", "narrators_canonical", "collections", "mentions_resolved")}
        names = [n for n in LINKS if exists(spark, f"{args.data}/{n}.parquet")]
        tables |= {n: table(spark, args.data, n) for n in names}
        try:
            got = run_stages(graph_stages(names), tables, args.from_step, skip=args.skip)
        except ValueError as e:
            print(e, file=sys.stderr)
            return Exit.BAD_ARGUMENT
        for name, df in tables.items():
            if name[:2] in ("n_", "e_", "m_"):
                df.write.mode("overwrite").parquet(f"{args.out}/{name}")
        return Exit.MISSING_INPUT if any("missing input" in x for x in got.failed.values()) else Exit.FAILED if got.failed else Exit.OK
    if args.command == "resolve":
        extra = [n for n in CURATED if exists(spark, f"{args.data}/{n}.parquet")]
        tables = {n: table(spark, args.data, n) for n in ("mentions_resolved", "narrators_canonical", "narrator_matches", *extra)}
        if args.from_step:  # what the stages before it left; written anew only after all of it has been read
            tables |= {n: stored(spark.read.parquet(f"{args.out}/{n}"), n) for n in RESOLVED if exists(spark, f"{args.out}/{n}")}
        try:
            got = run_stages(resolve_stages(extra), tables, args.from_step, stop_after=args.stop_after)
        except ValueError as e:
            print(e, file=sys.stderr)
            return Exit.BAD_ARGUMENT
        for name in RESOLVED:
            if name in tables:
                tables[name].write.mode("overwrite").parquet(f"{args.out}/{name}")
        for name, why in got.failed.items():
            print(f"{name}: {why}", file=sys.stderr)
        return Exit.MISSING_INPUT if any("missing input" in x for x in got.failed.values()) else Exit.FAILED if got.failed else Exit.OK
    if args.command == "sql":
        views.query(spark, dict(x.split("=", 1) for x in args.layer), args.query).show(1000, truncate=False)
        return Exit.OK
    from khayt.plans.graph import v1_cycles, v4_dangling

    loops = v1_cycles(spark, args.data).first()["self_loops"]
    return Exit.FINDINGS if loops or not v4_dangling(spark, args.data).isEmpty() else Exit.OK


if __name__ == "__main__":
    sys.exit(main())
