"""Spark session helpers.

The library never creates a session behind the caller's back: every public
function takes DataFrames (or a session) as arguments.  `local_session` is only
for tests, the bench and the driver entry point.
"""
from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "judgeline") -> SparkSession:
    """A local session tuned for small scale factors (tests, bench)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only when unset.

    On a cluster `spark.checkpoint.dir` names a shared folder and is left alone;
    without one this raises there, since executors share no local folder.  Local
    runs (tests) get a fresh scratch folder.
    """
    current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not current and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not current:
        current = tempfile.mkdtemp(prefix="judgeline-ckpt-", dir="/tmp")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor
    loss); never a local checkpoint.  The input is persisted while the
    checkpoint is written so it is computed once, not twice."""
    ensure_checkpoint_dir(df.sparkSession)
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


_OWNED: ContextVar[list | None] = ContextVar("judgeline_owned", default=None)


def keep(df: DataFrame) -> DataFrame:
    """Persist a frame that several steps read; inside ``owned()`` it is
    released at the end of the block."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    frames = _OWNED.get()
    if frames is not None:
        frames.append(df)
    return df


BROADCAST_BYTES = 32 * 2**20


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its measured bytes (strings by their
    length, 16 for any other value) are under the limit, else as it is, for the
    planner's shuffle join.  ``df`` should be kept: it is read once to measure."""
    width = F.lit(16 * len(df.columns)).cast("long")
    for name, kind in df.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    size = df.agg(F.sum(width).alias("b")).first()["b"] or 0
    return F.broadcast(df) if size <= limit else df


@contextmanager
def owned():
    """Release every frame that the library persists inside this block.  Write
    or checkpoint the result inside it as well."""
    frames: list[DataFrame] = []
    token = _OWNED.set(frames)
    try:
        yield frames
    finally:
        _OWNED.reset(token)
        for df in frames:
            df.unpersist()


def env_cpus(default: int = 8) -> int:
    try:
        return int(os.environ.get("BENCH_CPUS", default))
    except ValueError:
        return default
