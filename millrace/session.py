"""Session helpers: shared scratch space, lineage cuts and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast by hint only when it was counted and is at most this long.
BROADCAST_ROWS = 100_000

_local_dirs: dict[str, str] = {}


def build_session(app: str = "millrace", master: str = "local[8]", **conf) -> SparkSession:
    """Session for tests and the benchmark; on a cluster the job brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        # small test tables still use all local cores after a shuffle
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; a cluster without
    the setting is an error, because a machine-local path is lost with its host.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="millrace-", dir="/tmp")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never one that exists."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Iterative jobs call this once per round, so the plan stays short and a lost
    executor costs one round at most.
    """
    path = scratch_path(df.sparkSession, "cut")
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if it has at most ``limit`` rows, else leave the choice to AQE."""
    return F.broadcast(df) if len(df.limit(limit + 1).select(F.lit(1)).collect()) <= limit else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Repartition by ``key`` only if the scan has fewer partitions than the session has cores.

    A small table in one file would otherwise keep row-expanding work on one core; a
    large one already comes in many splits and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, for tasks that import from it."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        root = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp(prefix="millrace-code-")) / "millrace_code.zip"
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted((root / "millrace").rglob("*.py")):
                z.write(p, p.relative_to(root))
        spark.sparkContext.addPyFile(str(path))
