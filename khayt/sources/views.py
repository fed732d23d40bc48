"""Ad-hoc SQL over all files of the layers: views by file, and by shared prefix where schemas are the same."""

from __future__ import annotations

import os
import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession


def plan_views(files: dict[str, tuple]) -> dict[str, list[str]]:
    """View -> files, from file stem -> schema: one view a file, and one for each longest prefix of words that at least two files with one schema share."""
    views = {stem: [stem] for stem in files}
    groups: dict[tuple, list[str]] = defaultdict(list)
    for stem, schema in files.items():
        words = stem.split("_")
        for n in range(1, len(words)):
            groups["_".join(words[:n]), schema].append(stem)
    shared: dict[frozenset, str] = {}
    for (prefix, _), stems in groups.items():
        if len(stems) > 1 and len(prefix) > len(shared.get(frozenset(stems), "")):
            shared[frozenset(stems)] = prefix
    for stems, prefix in shared.items():
        views.setdefault(prefix, sorted(stems))
    return views


def register(spark: SparkSession, layers: dict[str, str]) -> dict[str, str]:
    """Temporary views ``<layer>_<name>`` over the Parquet files of each layer's folder; a file that cannot be read is passed over. Returns view -> what it holds."""
    made = {}
    for layer, folder in layers.items():
        schemas = {}
        for entry in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
            if entry.endswith(".parquet"):
                try:
                    schemas[entry.removesuffix(".parquet")] = tuple(sorted((f.name, f.dataType.simpleString()) for f in spark.read.parquet(f"{folder}/{entry}").schema))
                except Exception:  # noqa: BLE001
                    continue
        for name, stems in plan_views(schemas).items():
            view = re.sub(r"\W", "_", f"{layer}_{name}")
            spark.read.option("mergeSchema", "true").parquet(*[f"{folder}/{s}.parquet" for s in stems]).createOrReplaceTempView(view)
            made[view] = ", ".join(stems)
    return made


def query(spark: SparkSession, layers: dict[str, str], sql: str) -> DataFrame:
    register(spark, layers)
    return spark.sql(sql)
