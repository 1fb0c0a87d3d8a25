"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "cohortlens", **settings: str) -> SparkSession:
    """Session with adaptive execution on; partition counts are left to AQE."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a
    missing setting is an error, because a machine-local folder would be lost
    together with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="cohortlens-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/cohortlens-{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Deletes all tables that this driver wrote to scratch paths; returns how many.

    A job calls this at its end: frames that still read such a table are lost with it.
    """
    gone = 0
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        gone += bool(files.delete(path, True))
    return gone


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder and read back.

    It survives the loss of executors and ends plan growth. Unlike a
    checkpoint, which keeps the estimates of the plan it replaces, a table
    brings its real size, so iterative joins keep choosing sound strategies.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "state")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineages(*frames: DataFrame) -> list[DataFrame]:
    """``cut_lineage`` of independent frames, written by concurrent jobs."""
    with ThreadPoolExecutor(len(frames)) as pool:
        return list(pool.map(cut_lineage, frames))


@contextmanager
def kept(df: DataFrame):
    """Persists ``df`` for the block's jobs, unless its owner already did."""
    if df.is_cached:
        yield df
        return
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()
