"""Stages of a job: tables that are published whole or not at all.

A stage is written to a folder of its own attempt, read back and held against
what was written; only then a small file, moved into place, names that attempt
as the stage's result.  Readers follow that file, so what a killed run leaves
is never seen, and a rerun finds either a complete stage, which it keeps, or
none.  A failure leaves a receipt, which a later success replaces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .bundle import digest


def staged(folder: str, stage: str, tables: dict[str, DataFrame]) -> dict:
    """Write an attempt and read it back; returns what the stage's file will say."""
    spark, attempt = next(iter(tables.values())).sparkSession, uuid.uuid4().hex
    at = f"{folder}/{stage}-{attempt}"
    entries = {}
    for name, df in sorted(tables.items()):
        df.write.mode("errorifexists").parquet(f"{at}/{name}")
        rows, sha = digest(spark.read.parquet(f"{at}/{name}"))
        entries[name] = {"rows": rows, "digest": sha, "columns": df.columns}
    listing = files.listed(spark, at)
    count, sha = digest(listing)
    listing.write.mode("errorifexists").json(f"{folder}/_{stage}-{attempt}")
    return {"status": "complete", "stage": stage, "attempt": attempt, "tables": entries, "files": {"rows": count, "digest": sha}}


def publish(folder: str, stage: str, work: Callable[[], dict[str, DataFrame]], check: Callable[[dict[str, DataFrame]], DataFrame] | None = None) -> dict:
    """The stage's record: that of a complete stage that is there already, else of a new attempt at ``work``.

    ``check`` gives (problem, n) rows for the tables; any row is a failure.  Errors become a receipt of status "failed".
    """
    spark = SparkSession.getActiveSession()
    done = files.get_json(spark, folder, f"{stage}.json")
    if done and done["status"] == "complete" and not damage(spark, folder, done).limit(1).count():
        return done
    try:
        tables = work()
        record = staged(folder, stage, tables)
        if check:
            found = check({name: spark.read.parquet(f"{folder}/{stage}-{record['attempt']}/{name}") for name in tables})
            wrong = [f"{r['problem']}: {r['n']}" for r in found.limit(100).collect()]
            if wrong:
                raise ValueError("; ".join(sorted(wrong)))
    except Exception as error:  # noqa: BLE001  whatever stopped the work is what the receipt says
        record = {"status": "failed", "stage": stage, "error": f"{type(error).__name__}: {error}"[:1000]}
    files.put_json(folder, f"{stage}.json", record)
    return record


def damage(spark: SparkSession, folder: str, record: dict) -> DataFrame:
    """(path, problem): files of a complete stage that are not as they were published."""
    stage, attempt = record["stage"], record["attempt"]
    listing = spark.read.schema(files.ENTRY).json(f"{folder}/_{stage}-{attempt}")
    found = files.checked(spark, f"{folder}/{stage}-{attempt}", listing).where("problem is not null")
    if digest(listing.select("path", "bytes", "sha256")) != (record["files"]["rows"], record["files"]["digest"]):
        found = found.unionByName(spark.createDataFrame([(f"_{stage}-{attempt}", "listing_differs")], "path string, problem string"))
    return found


def stage_tables(spark: SparkSession, folder: str, stage: str) -> dict[str, DataFrame]:
    """The tables of a complete stage; a stage that failed or was never published is an error."""
    record = files.get_json(spark, folder, f"{stage}.json")
    if not record or record["status"] != "complete":
        raise ValueError(f"stage {stage} is not complete" + (f": {record['error']}" if record else ""))
    return {name: spark.read.parquet(f"{folder}/{stage}-{record['attempt']}/{name}") for name in record["tables"]}


def tree_result_problems(tree: DataFrame, samples: DataFrame, alignment: DataFrame, claimed: DataFrame) -> DataFrame:
    """(problem, n): what of a tree stage's result does not follow from its inputs.

    ``tree`` (node, parent, sample_id), ``samples`` (sample_id and metadata),
    ``alignment`` (sample_id, seq), ``claimed`` (sample_id, the same metadata,
    callable): tips must be the samples, each once, metadata equal to what was
    given, sequences of one length, and callable sites what the sequences say.
    """
    inner = tree.select(F.col("parent").alias("node")).distinct()
    tips = tree.join(inner, "node", "left_anti").select("sample_id")
    ids = samples.select("sample_id")
    same = [c for c in samples.columns if c != "sample_id"]
    given, told = samples.alias("g"), claimed.alias("t")
    differ = F.lit(False)
    for c in same:
        differ = differ | ~F.col(f"g.{c}").eqNullSafe(F.col(f"t.{c}"))
    sites = alignment.select("sample_id", F.length(F.regexp_replace(F.upper("seq"), "[^ACGT]", "")).alias("sites"))
    count = lambda df: df.agg(F.count("*").alias("n"))
    found = {
        "tip_without_sample": count(tips.join(ids, "sample_id", "left_anti")),
        "sample_without_tip": count(ids.join(tips, "sample_id", "left_anti")),
        "repeated_tip": count(tips.groupBy("sample_id").agg(F.count("*").alias("c")).where("c > 1")),
        "metadata_differs": count(given.join(told, "sample_id").where(differ)),
        "metadata_missing": count(ids.join(claimed, "sample_id", "left_anti")),
        "lengths_differ": alignment.agg(F.greatest(F.count_distinct(F.length("seq")) - 1, F.lit(0)).cast("bigint").alias("n")),
        "callable_sites_differ": count(claimed.join(sites, "sample_id", "left").where(~F.col("callable").cast("bigint").eqNullSafe(F.col("sites").cast("bigint")))),
    }
    out = None
    for name, rows in found.items():
        rows = rows.select(F.lit(name).alias("problem"), F.col("n").cast("bigint").alias("n"))
        out = rows if out is None else out.unionByName(rows)
    return out.where("n > 0")
