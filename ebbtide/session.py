"""Session settings, written intermediate tables and size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only after it was counted and found at most this long.
BROADCAST_ROWS = 200_000


def build_session(app: str = "ebbtide", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings the jobs are designed for; keyword names use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a session without executors of its own, as in tests, may go without."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="ebbtide-")
        spark.sparkContext.setCheckpointDir(named)
    return f"{named.rstrip('/')}/ebbtide"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later jobs neither recompute it nor
    depend on an executor that may be gone, and the planner knows its size from the files."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(staged: DataFrame) -> None:
    """Delete a table of :func:`stage`, once all that was made of it has been written itself."""
    spark = staged.sparkSession
    folders = {file.rsplit("/", 1)[0] for file in staged.inputFiles()}
    for folder in folders:
        if "/ebbtide/" not in folder:
            raise ValueError(f"{folder} is not a staged table")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when a count proves it short, else unchanged (shuffle join)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
