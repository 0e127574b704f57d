"""Frames written once where every executor can read them again."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

FOLDER = "spark.checkpoint.dir"


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder takes its place in local mode; on a cluster, executors
    would each write to a disk of their own, so that is an error.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = context.getConf().get(FOLDER)
        if folder is None and not context.master.startswith("local"):
            raise ValueError(f"set {FOLDER} to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def shared(df: DataFrame) -> DataFrame:
    """Compute a frame now, once, and read it from the shared folder from then on.

    Losing executors costs nothing of it, and plans above it start at its rows.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()
