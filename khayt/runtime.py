"""Session, tables, materialisation and size-checked broadcasts shared by all operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes up to which a side may be broadcast after it has been measured.
BROADCAST_BYTES = 32 << 20

_made: list[tuple[SparkSession, str]] = []


def session(cpus: str = "*", shuffle: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("khayt")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one of our own where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    own = f"file://{tempfile.mkdtemp(prefix='khayt-')}"
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir() or own


def _path(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, where: str) -> bool:
    path, fs = _path(spark, where)
    return fs.exists(path)


def store(df: DataFrame, what: str = "stage") -> tuple[DataFrame, str]:
    """Write a DataFrame to the shared folder and read it back: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    where = f"{shared_dir(spark)}/khayt-{what}-{uuid.uuid4().hex}"
    if not _made:  # registered once Spark runs, so that it is called before Spark ends
        atexit.register(_clean)
    _made.append((spark, where))
    df.write.option("compression", "zstd").parquet(where)
    return spark.read.schema(df.schema).parquet(where), where


def stored(df: DataFrame, what: str = "stage") -> DataFrame:
    return store(df, what)[0]


def release(spark: SparkSession, where: str) -> None:
    """Delete a stored stage that no later step reads."""
    path, fs = _path(spark, where)
    fs.delete(path, True)


def _clean() -> None:
    """Delete what was stored and not released, on whatever file system it is; local folders also if Spark has ended."""
    for spark, where in _made:
        try:
            release(spark, where)
        except Exception:  # noqa: BLE001  Spark is gone
            if where.startswith(("file:", "/")):
                shutil.rmtree(where.removeprefix("file://").removeprefix("file:"), ignore_errors=True)


def small(df: DataFrame, what: str = "side", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Store a side of a join and mark it for broadcast only if what was written is small: its values are measured, 16 bytes for a fixed one, a text by its length.

    Beyond the bound the stored side is returned unmarked and the join shuffles.
    """
    out = stored(df, what)
    widths = [F.coalesce(F.octet_length(f.name), F.lit(0)) + 16 if f.dataType.simpleString() == "string" else F.lit(16) for f in out.schema]
    size = out.agg(F.sum(sum(widths, F.lit(0)))).first()[0] or 0
    return F.broadcast(out) if size <= max_bytes else out


def one_row(*rows: DataFrame) -> DataFrame:
    """Frames of one row each, side by side: united, then the one value of each column taken. No join."""
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])


def data_dir(default: str = "/root/testdata/sf0.1") -> str:
    return os.environ.get("BENCH_SF_DIR", default)
