"""Writers: staged Parquet behind a conformance check, CSV reports, pointer messages, run records."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khayt.functions.scalars import CORPORA
from khayt.operators.quality import fingerprint, provenance_violations
from khayt.schemas import REQUIRED, conform


class Refused(ValueError):
    """Rows do not conform; nothing was written."""


def write_staged(df: DataFrame, table: str, path: str) -> None:
    """The table's columns as Parquet by source_corpus where it has one, after one aggregate that finds no row without a required value or of an unknown corpus."""
    out = conform(df, table)
    if "source_corpus" in out.columns:
        bad = {r[0]: r[1] for r in provenance_violations(out, REQUIRED[table], CORPORA).collect() if r[1]}
    else:
        bad = {c: n for c, n in out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED[table]]).first().asDict().items() if n}
    if bad:
        raise Refused(f"{table}: {bad}")
    writer = out.write.mode("overwrite")
    (writer.partitionBy("source_corpus") if "source_corpus" in out.columns else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def with_provenance(df: DataFrame, column: str, **facts: str) -> DataFrame:
    """Facts about how a table was made, kept as metadata of one of its columns; Parquet keeps them."""
    return df.withMetadata(column, {**df.schema[column].metadata, **facts})


def messages(df: DataFrame, key: str) -> DataFrame:
    """(key, value): rows as JSON pointer messages, as a Kafka sink takes them."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def send(df: DataFrame, key: str, servers: str, topic: str) -> bool:
    """To Kafka; a broker that fails, or a connector that is not on the class path, is reported, not raised. A wrong key or column raises."""
    out = messages(df, key)
    out.schema  # noqa: B018  errors of analysis show here
    try:
        out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").option("kafka.retries", "3").option("topic", topic).save()
        return True
    except Exception:  # noqa: BLE001
        return False


#: The topics of the pipeline and the one for what failed.
TOPICS = ("pipeline.raw", "pipeline.staged", "pipeline.resolved", "pipeline.graph", "pipeline.enriched")
DEAD_LETTERS = "pipeline.dlq"


def run_record(path: str, stages: Mapping[str, str], tables: Mapping[str, DataFrame], status: str) -> dict:
    """A small JSON record of a run: its stages, and rows and digest of each table; only a finished run is complete."""
    if status == "complete" and any(s != "ran" for s in stages.values()):
        raise ValueError("a run with stages that did not run is not complete")
    record = {"status": status, "stages": dict(stages), "tables": {n: {k: str(v) for k, v in fingerprint(d).first().asDict().items()} for n, d in tables.items()}}
    with open(f"{path}.part", "w", encoding="utf-8") as f:
        json.dump(record, f, ensure_ascii=False, indent=1, sort_keys=True)
    os.replace(f"{path}.part", path)
    return record


def may_publish(record: Mapping, required: set[str], checks: Mapping[str, Callable[[], bool]] | None = None) -> list[str]:
    """What stands against publishing: an incomplete run, tables that are not there, checks that fail."""
    against = [] if record.get("status") == "complete" else ["the run is not complete"]
    against += [f"{t} is missing" for t in sorted(required - set(record.get("tables", {})))]
    return against + [n for n, ok in (checks or {}).items() if not ok()]
