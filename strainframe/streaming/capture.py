"""Append-only capture with exactly-once batches, on Structured Streaming.

A folder of JSON records is a stream.  Every micro-batch is written to a folder
of its own attempt and becomes part of the target when a small file, moved into
place, names that attempt; readers follow those files.  A batch that comes
again replaces its own file only, so a restart neither loses nor doubles
anything, and no reader meets half a batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files


def stream_of(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def captured(stream: DataFrame, target: str, checkpoint: str, source: str = "stream") -> None:
    """Append what is there, batch by batch, to ``target``; several ``source``s may share one."""

    def keep(batch: DataFrame, number: int) -> None:
        attempt = f"rows/{source}-{number}-{uuid.uuid4().hex}"
        batch.write.mode("errorifexists").parquet(f"{target}/{attempt}")
        files.put_json(target, f"committed/{source}-{number}.json", {"source": source, "batch": number, "path": attempt})

    stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def committed(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all committed batches, with ``source`` and ``batch``."""
    listed = spark.read.schema("source string, batch long, path string").json(f"{target}/committed")
    named = F.regexp_extract(F.col("_metadata.file_path"), "/(rows/[^/]+)/[^/]+$", 1)
    rows = spark.read.parquet(f"{target}/rows/*").select("*", named.alias("path"))
    # One row for each batch; attempts that no file names are left out.
    return rows.join(listed, "path").drop("path")


def windowed_counts(events: DataFrame, time: str, late: str, width: str) -> DataFrame:
    """Counts and sums by type and window; with a watermark if ``events`` is a stream."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.window(time, width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("begins"), "event_type", "n", "total")
