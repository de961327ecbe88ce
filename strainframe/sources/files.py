"""Single files below a folder: written by tasks, listed with their digests, held against a manifest.

Listing is Spark's own binary reader, so any store that Spark reads will do and
digests are taken where the files are read (up to 2 GB each).  Writing goes
through the file systems of Arrow, a file at a time, under another name first,
so a task that is lost or runs twice never leaves half a file.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "path string, bytes long, sha256 string"


def put(folder: str, path: str, content: bytes) -> None:
    """Write one file below ``folder``, whole or not at all."""
    store, root = fs.FileSystem.from_uri(folder)
    target = f"{root}/{path}"
    store.create_dir(target.rpartition("/")[0], recursive=True)
    # A leading dot hides the file from readers until it has its name.
    head, _, name = target.rpartition("/")
    part = f"{head}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(content)
    store.move(part, target)


def put_all(files: DataFrame, folder: str) -> DataFrame:
    """Write (path, content binary) rows below ``folder``; their entries (path, bytes, sha256) are the manifest.

    Lazy: files are written when the entries are first needed, and again, alike, if they are needed anew.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [x.as_py() for x in batch.column(1)]
            for path, content in zip(batch.column(0).to_pylist(), raw, strict=True):
                put(folder, path, content)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(len, raw)), pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in raw])], names=["path", "bytes", "sha256"])

    return files.select("path", "content").mapInArrow(write, ENTRY)


def without_scheme(path: Column) -> Column:
    return F.regexp_replace(path, "^[A-Za-z0-9+.-]+:(//[^/]*)?", "")


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """(path below the folder, bytes, sha256) of every file whose name does not begin with a dot or underscore."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    root = without_scheme(F.lit(folder.rstrip("/")))
    return found.select(F.substring(without_scheme(F.col("path")), F.length(root) + 2, F.lit(1 << 20)).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def path_problem(path: Column) -> Column:
    """Why a path cannot name a file inside a folder: it must be relative, with forward slashes and no step up."""
    parts = F.split(path, "/")
    return (
        F.when(path.isNull() | (path == ""), "no_path")
        .when(path.contains("\\") | path.startswith("/") | path.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), "not_relative")
        .when(F.exists(parts, lambda p: p.isin("", ".", "..")), "escapes")
    )


def checked(spark: SparkSession, folder: str, entries: DataFrame) -> DataFrame:
    """(path, problem) for every entry (path, bytes, sha256) of a manifest, null where the file is as it says, and for every file that no entry names."""
    own = entries.select("path", "bytes", F.col("sha256"), F.lit(1).alias("_entry"))
    times = own.groupBy("path").agg(F.count("*").alias("_times"))
    found = listed(spark, folder).select(F.col("path").alias("_path"), F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha256"))
    both = own.join(times, own["path"].eqNullSafe(times["path"])).drop(times["path"]).join(found, F.col("path") == F.col("_path"), "full")
    problem = (
        F.when(F.col("_entry").isNull(), "unlisted")
        .otherwise(F.coalesce(
            path_problem(F.col("path")), F.when(F.col("_times") > 1, "repeated"), F.when(~F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)), "no_digest"),
            F.when(~F.coalesce(F.col("bytes") >= 0, F.lit(False)), "no_size"), F.when(F.col("_path").isNull(), "missing"), F.when(F.col("bytes") != F.col("_bytes"), "size_differs"), F.when(F.col("sha256") != F.col("_sha256"), "digest_differs"),
        ))
    )
    return both.select(F.coalesce("path", "_path").alias("path"), problem.alias("problem"))


def put_json(folder: str, path: str, value: dict) -> None:
    put(folder, path, json.dumps(value, sort_keys=True).encode())


def get_json(spark: SparkSession, folder: str, path: str) -> dict | None:
    """A small JSON object, or None where there is no such file."""
    store, root = fs.FileSystem.from_uri(folder)
    if store.get_file_info(f"{root}/{path}").type != fs.FileType.File:
        return None
    with store.open_input_stream(f"{root}/{path}") as f:
        return json.loads(f.read())
