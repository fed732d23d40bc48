"""Structured Streaming: landed files as events, and windowed, sessioned and stateful results over event streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def events(spark: SparkSession, folder: str, pattern: str = "events*.parquet", files_at_once: int = 1) -> DataFrame:
    """A stream of the event files of a folder; a bounded number of files each trigger."""
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def landed(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """A stream of the files that land in a folder: path, size and time, each once."""
    return spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("landed_at"))


def tumbling(stream: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window_start, event_type, events, total) per window; rows later than the watermark fall out."""
    w = stream.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total"))
    return w.select(F.col("window.start").alias("window_start"), "event_type", "events", "total")


def sliding(stream: DataFrame, size: str = "2 hours", step: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    w = stream.withWatermark("ts", late).groupBy(F.window("ts", size, step)).agg(F.count(F.lit(1)).alias("events"))
    return w.select(F.col("window.start").alias("window_start"), "events")


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(user_id, session_start, session_end, events): runs of a user's events without a longer pause."""
    s = stream.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("events"))
    return s.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events")


def first_seen(stream: DataFrame, key: str, late: str = "1 hour") -> DataFrame:
    """The first row of each key within the watermark."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def running_totals(stream: DataFrame) -> DataFrame:
    """(user_id, events, total) after each batch: state kept per user."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for f in frames:
            n, total = n + len(f), total + float(f["value"].fillna(0).sum())
        state.update((n, total))
        yield pd.DataFrame({"user_id": [key[0]], "events": [n], "total": [total]})

    return stream.groupBy("user_id").applyInPandasWithState(update, "user_id bigint, events bigint, total double", "n bigint, total double", "update", GroupStateTimeout.NoTimeout)


def _keep(df: DataFrame, batch: int, path: str, mode: str) -> None:
    """Write a batch's rows; a batch that has none leaves no folder, unless an empty result is the whole one."""
    if mode == "complete" or batch == 0 or not df.isEmpty():
        df.write.mode("overwrite").parquet(path)


def drain(spark: SparkSession, stream: DataFrame, folder: str, mode: str = "append", keys: Sequence[str] = ()) -> DataFrame:
    """Run a stream over what is there now, into Parquet under its own checkpoint, and return the result as it stands; run again on the same folder, it goes on from where it was.

    append: all rows written. complete: the rows of the last batch, which are the whole result. update: of each key (``keys``) the row of the last batch that has one.
    """
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    else:
        q = stream.writeStream.outputMode(mode).foreachBatch(lambda df, i: _keep(df, i, f"{folder}/out/batch={i}", mode)).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    if mode == "append":
        return spark.read.schema(stream.schema).parquet(f"{folder}/out")
    written = spark.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).parquet(f"{folder}/out")
    if mode == "complete":
        last = written.agg(F.max("batch")).first()[0]
        return written.where(F.col("batch") == last).drop("batch")
    if not keys:
        raise ValueError("the keys of an updated result must be named")
    rest = [c for c in stream.columns if c not in keys]
    latest = written.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_row"))
    return latest.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in stream.columns])
