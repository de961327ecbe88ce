"""Datasets prepared sample by sample, merged into one cohort with a proof.

A member that is not complete blocks the whole merger and is named.  Equal
catalogues, by the digest of what they say, are one.  The proof holds what was
merged against the members it came from, row by row and both ways, so a
changed, lost or added row names its sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def catalogue_digests(loci: DataFrame) -> DataFrame:
    """(member, scheme, version, catalogue): the digest of each member's catalogue (member, scheme, version, locus)."""
    listed = F.array_join(F.sort_array(F.collect_set("locus")), "\x1f")
    return loci.groupBy("member", "scheme", "version").agg(F.sha2(F.concat_ws("\x1e", "scheme", "version", listed), 256).alias("catalogue"))


def merger_problems(planned: DataFrame, status: DataFrame, samples: DataFrame, calls: DataFrame, loci: DataFrame) -> DataFrame:
    """(member, problem) of what blocks a merger.

    ``planned`` are (sample_id), ``status`` (member, status), ``samples``
    (member, sample_id, ...), ``calls`` (member, sample_id, scheme, version,
    locus, allele), ``loci`` as above.
    """
    told = lambda df, problem: df.select(F.col("member").cast("string").alias("member"), F.lit(problem).alias("problem"))
    one = samples.groupBy("sample_id").agg(F.count("*").alias("n"), F.min("member").alias("member"))
    found = told(status.where("status is null or status != 'complete'"), "incomplete")
    found = found.unionByName(told(planned.join(samples.select("sample_id"), "sample_id", "left_anti").select(F.col("sample_id").alias("member")), "planned_but_missing"))
    found = found.unionByName(told(samples.join(planned, "sample_id", "left_anti"), "not_planned"))
    found = found.unionByName(told(one.where("n > 1"), "repeated_sample"))
    found = found.unionByName(told(samples.join(status.select("member"), "member", "left_anti"), "without_status"))
    outside = calls.join(loci.select("member", "scheme", "version", "locus").distinct(), ["member", "scheme", "version", "locus"], "left_anti")
    found = found.unionByName(told(outside.select("member").distinct(), "call_outside_catalogue"))
    return found.distinct()


def merged(samples: DataFrame, calls: DataFrame, loci: DataFrame) -> dict[str, DataFrame]:
    """samples, calls (with the digest of their catalogue) and catalogues (catalogue, scheme, version, locus), each catalogue once."""
    digests = catalogue_digests(loci)
    first = digests.groupBy("catalogue", "scheme", "version").agg(F.min("member").alias("member"))
    return {
        "samples": samples.drop("member"),
        "calls": calls.join(digests, ["member", "scheme", "version"]).select("sample_id", "catalogue", "locus", "allele"),
        "catalogues": loci.distinct().join(first, ["member", "scheme", "version"]).select("catalogue", "scheme", "version", "locus"),
    }


def differences(one: DataFrame, other: DataFrame, key: Column) -> DataFrame:
    """(name, only_first, only_second): how many rows of each key only one side has, repeats counted."""
    columns = sorted(one.columns)
    if columns != sorted(other.columns):
        raise ValueError(f"columns differ: {columns} and {sorted(other.columns)}")
    row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    side = lambda df, sign: df.select(key.cast("string").alias("name"), row.alias("row"), F.lit(sign).alias("sign"))
    net = side(one, 1).unionByName(side(other, -1)).groupBy("name", "row").agg(F.sum("sign").alias("n")).where("n != 0")
    return net.groupBy("name").agg(F.sum(F.greatest("n", F.lit(0))).alias("only_first"), F.sum(F.greatest(-F.col("n"), F.lit(0))).alias("only_second"))


def proof(cohort: dict[str, DataFrame], samples: DataFrame, calls: DataFrame, loci: DataFrame, free: list[str] | None = None) -> DataFrame:
    """(table, name, only_merged, only_members): where a merged cohort and its members disagree; no row is a proof.

    ``free`` names sample columns that a merger may change.
    """
    want, kept = merged(samples, calls, loci), [c for c in cohort["samples"].columns if c not in (free or [])]
    out = None
    for table, name in (("samples", "sample_id"), ("calls", "sample_id"), ("catalogues", "catalogue")):
        columns = kept if table == "samples" else cohort[table].columns
        rows = differences(cohort[table].select(columns), want[table].select(columns), F.col(name)).select(F.lit(table).alias("table"), "name", F.col("only_first").alias("only_merged"), F.col("only_second").alias("only_members"))
        out = rows if out is None else out.unionByName(rows)
    return out
