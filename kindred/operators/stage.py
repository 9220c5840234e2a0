"""Reliable intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _checkpoint_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder, since executors
    elsewhere could not read it.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None)
    if folder is None and (current := context.getCheckpointDir()) is not None:
        return current
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="kindred-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame) -> DataFrame:
    """Checkpoint a result that is read more than once, cutting its lineage."""
    _checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table, beside the checkpoints all executors can read."""
    return f"{_checkpoint_root(spark)}/kindred-{uuid.uuid4().hex}/{name}"
