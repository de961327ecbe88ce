"""Immutable bundles: a folder of Parquet tables, a list of their files, and a manifest with the digests of all.

A bundle is written table by table and becomes one only when its manifest
stands, which is written last; an existing target is refused.  Tables have a
digest of their rows, which outlives another way of writing them, and files one
of their bytes.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files


def digest(df: DataFrame) -> tuple[int, str]:
    """Row count and a digest that does not depend on the order of rows: sums of two halves of each row's hash."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    half = lambda a: F.sum(F.conv(F.substring(row, a, 8), 16, 10).cast("decimal(38,0)"))
    got = df.agg(F.count("*").alias("n"), *(half(a).alias(f"h{a}") for a in (1, 9, 17, 25))).first()
    return got["n"], hashlib.sha256("|".join(str(x) for x in got).encode()).hexdigest()


def write_bundle(tables: dict[str, DataFrame], folder: str) -> str:
    """Write the tables and the manifest; returns the bundle's id."""
    spark = next(iter(tables.values())).sparkSession
    entries = {}
    for name, df in sorted(tables.items()):
        df.write.mode("errorifexists").parquet(f"{folder}/{name}")
        n, sha = digest(spark.read.parquet(f"{folder}/{name}"))
        entries[name] = {"rows": n, "digest": sha, "columns": sorted(df.columns)}
    listing = files.listed(spark, folder)
    listing.write.mode("errorifexists").json(f"{folder}/_files")
    n, sha = digest(listing)
    body = {"schema_version": 1, "status": "complete", "tables": entries, "files": {"rows": n, "digest": sha}}
    bundle = identity(body)
    manifest = json.dumps({**body, "dataset_id": bundle}, sort_keys=True)
    spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("errorifexists").text(f"{folder}/_manifest.txt")
    return bundle


def identity(manifest: dict) -> str:
    """A bundle's id: the digest of all its manifest says but the id."""
    return hashlib.sha256(json.dumps({k: v for k, v in manifest.items() if k != "dataset_id"}, sort_keys=True).encode()).hexdigest()


def manifest_of(spark: SparkSession, folder: str) -> dict:
    """A bundle's manifest, whose id must be its own and whose status complete."""
    manifest = json.loads(spark.read.text(f"{folder}/_manifest.txt").first()["value"])
    if manifest.get("schema_version") != 1 or manifest.get("status") != "complete" or manifest.get("dataset_id") != identity(manifest):
        raise ValueError("the manifest does not fit its own id")
    return manifest


def bundle_problems(spark: SparkSession, folder: str) -> DataFrame:
    """(path, problem): files that are not as the bundle lists them, and a list that is not as the manifest says."""
    manifest = manifest_of(spark, folder)
    listing = spark.read.schema(files.ENTRY).json(f"{folder}/_files")
    wrong = [("_files", "listing_differs")] if digest(listing) != (manifest["files"]["rows"], manifest["files"]["digest"]) else []
    found = files.checked(spark, folder, listing).where("problem is not null")
    return found.unionByName(spark.createDataFrame(wrong, "path string, problem string"))


def read_bundle(spark: SparkSession, folder: str, verify: bool = True) -> dict[str, DataFrame]:
    """The tables of a bundle; with ``verify``, files, counts and digests must agree with the manifest."""
    manifest = manifest_of(spark, folder)
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in manifest["tables"]}
    if verify:
        wrong = bundle_problems(spark, folder).limit(10).collect()
        if wrong:
            raise ValueError("; ".join(f"{r['path']}: {r['problem']}" for r in wrong))
        for name, df in tables.items():
            entry = manifest["tables"][name]
            if digest(df) != (entry["rows"], entry["digest"]):
                raise ValueError(f"table {name} differs from the manifest")
    return tables


def nested_csv(df: DataFrame, folder: str) -> None:
    """Write CSV; nested columns become JSON text."""
    nested = [f.name for f in df.schema if f.dataType.typeName() in ("array", "map", "struct")]
    df.withColumns({c: F.to_json(c) for c in nested}).write.mode("errorifexists").option("header", True).option("escape", '"').csv(folder)


def merged(parts: list[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """Datasets (samples, catalogues) as one: samples after each other, equal catalogues once."""
    samples, catalogues = parts[0]
    for s, c in parts[1:]:
        samples, catalogues = samples.unionByName(s), catalogues.unionByName(c)
    return samples, catalogues.dropDuplicates(sorted(catalogues.columns))
