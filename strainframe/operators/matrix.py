"""Categorical matrices: profiles as codes of a vocabulary, and their rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import numbered

# Fixed value: identifiers that are safe in file names.
SAFE = "^[A-Za-z0-9][A-Za-z0-9._-]*$"


def coded(calls: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(vocabulary, codes): alleles numbered from 1 by where they are first seen in ``order``; 0 is no call.

    The first place of each allele is one aggregate; numbers come from the
    sorted first places, a table of distinct alleles.
    """
    place = F.struct(*order)
    first = calls.where("allele is not null").groupBy("allele").agg(F.min(place).alias("_first"))
    vocabulary = numbered(first, ["_first"], "code").select("code", "allele")
    codes = calls.join(vocabulary, "allele", "left").select(*(c for c in calls.columns if c != "allele"), F.coalesce("code", F.lit(0)).alias("code"))
    return vocabulary, codes


def matrix_problems(samples: DataFrame, loci: DataFrame, vocabulary: DataFrame, codes: DataFrame) -> DataFrame:
    """(problem, n): what breaks the rules of a matrix given as (sample_id), (locus), (code, allele) and (sample_id, locus, code)."""
    repeated = lambda df, key: df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("n"))
    size = vocabulary.agg(F.count("*").alias("size"))
    found = {
        "repeated_sample": repeated(samples, "sample_id"),
        "unsafe_sample": samples.where(~F.coalesce(F.col("sample_id").cast("string").rlike(SAFE), F.lit(False))).agg(F.count("*").alias("n")),
        "repeated_category": repeated(vocabulary, "allele"),
        "missing_category": vocabulary.where("allele is null or trim(allele) = ''").agg(F.count("*").alias("n")),
        "code_out_of_range": codes.join(F.broadcast(size)).where("code is null or code < 0 or code > size").agg(F.count("*").alias("n")),
        "unknown_sample": codes.join(samples.select("sample_id").distinct(), "sample_id", "left_anti").agg(F.count("*").alias("n")),
        "unknown_locus": codes.join(loci.select("locus").distinct(), "locus", "left_anti").agg(F.count("*").alias("n")),
        "repeated_cell": codes.groupBy("sample_id", "locus").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("n")),
    }
    out = None
    for name, rows in found.items():
        rows = rows.select(F.lit(name).alias("problem"), "n")
        out = rows if out is None else out.unionByName(rows)
    return out.where("n > 0")


def lineage_groups(samples: DataFrame) -> DataFrame:
    """(species, lineage, samples, first): samples grouped by species and lineage, each group to be analysed by itself."""
    return samples.groupBy("species", "lineage").agg(F.count("*").alias("samples"), F.min("sample_id").alias("first"))
