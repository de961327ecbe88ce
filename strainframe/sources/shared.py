"""The folder that driver and executors share, and lineage cut there."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_OWN: list[tempfile.TemporaryDirectory] = []


def checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of this process only where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not _OWN:
        _OWN.append(tempfile.TemporaryDirectory(prefix="strainframe-"))
    return f"file://{_OWN[0].name}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, computed once and read from the shared folder afterwards."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint()
