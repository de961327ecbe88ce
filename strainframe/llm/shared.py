"""Tables that cut lineage: written below the folder that the cluster shares.

The folder is the one named by ``spark.checkpoint.dir``.  Only where that is
unset and the master is local (tests, one machine) a temporary folder of this
process takes its place; a cluster without the setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: list[tempfile.TemporaryDirectory] = []
#: What has been written or begun so far: ("folder" or "table", name).
_MADE: list[tuple[str, str]] = []


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _OWN:
        _OWN.append(tempfile.TemporaryDirectory(prefix="strainframe-"))
    return f"file://{_OWN[0].name}"


def stored(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    noted("folder", path)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def noted(kind: str, name: str) -> None:
    """Remember a folder or table that is about to be written, for ``scratch`` to drop."""
    _MADE.append((kind, name))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drop what is written inside, but for the last thing, on leaving: lazy results must have been written by then.

    Where the work fails, all that it wrote goes.
    """
    begin = len(_MADE)
    kept = 0
    try:
        yield
        kept = 1
    finally:
        gone = _MADE[begin : len(_MADE) - kept]
        del _MADE[begin : len(_MADE) - kept]
        for kind, name in gone:
            discard(spark, kind, name)


def discard(spark: SparkSession, kind: str, name: str) -> None:
    if kind == "table":
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def buckets_for(n: int, per_bucket: int, least: int = 12) -> int:
    """As many buckets as keep each near ``per_bucket`` items."""
    return max(least, -(-n // per_bucket))
