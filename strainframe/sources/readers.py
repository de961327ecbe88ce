"""Readers of typing, metadata, sequence and tool files, through Spark's own sources.

Paths may be anything Spark can read.  Rows that break a rule come back in an
error table, or with a status; nothing is dropped silently.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.dates import bounds_start
from ..functions.scalars import one_of, text


def header_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A CSV file with a header: names and values trimmed, everything text, a byte order mark tolerated."""
    raw = spark.read.option("header", True).option("sep", sep).option("mode", "FAILFAST").option("multiLine", True).csv(path)
    return raw.select(*(F.trim(F.col(f"`{c}`")).alias(c.replace("﻿", "").strip()) for c in raw.columns))


def folded_names(df: DataFrame) -> DataFrame:
    """Column names in lower case without signs, so that spellings of a header agree."""
    return df.toDF(*("".join(ch for ch in c.lower() if ch.isalnum()) for c in df.columns))


def accession_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct accessions of a plain file; blank lines and comments after # are left out."""
    return spark.read.text(path).select(F.trim(F.regexp_replace("value", "#.*$", "")).alias("accession")).where("accession != ''").distinct()


def study_metadata(spark: SparkSession, path: str, required: list[str], dates: list[str] | None = None, files: tuple[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, errors): ids must be safe and unique, and required fields filled; an absent column is an error of its own.

    ``dates`` names columns that are blank or a year, month or day; ``files``
    a column whose values must be among the paths (path) of a listing.
    """
    raw = header_csv(spark, path)
    for c in [*required, *(dates or []), *([files[0]] if files else [])]:
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    n = raw.groupBy("sample_id").agg(F.count("*").alias("_n"))
    counted = raw.join(n, "sample_id", "left")
    if files:
        counted = counted.join(files[1].select(F.col("path").alias("_path")).distinct(), F.col(files[0]) == F.col("_path"), "left")
    why = F.when(~F.coalesce(F.col("sample_id").rlike(r"^[A-Za-z0-9_.-]+$"), F.lit(False)), "unsafe_sample_id").when(F.col("_n") > 1, "repeated_sample_id")
    for c in required:
        why = why.when(F.coalesce(F.col(c), F.lit("")) == "", f"missing_{c}")
    for c in dates or []:
        why = why.when((F.coalesce(F.col(c), F.lit("")) != "") & bounds_start(F.col(c)).isNull(), f"invalid_{c}")
    if files:
        why = why.when((F.coalesce(F.col(files[0]), F.lit("")) != "") & F.col("_path").isNull(), "file_not_found")
    judged = counted.withColumn("error", why.otherwise(F.lit(None))).drop("_n", "_path")
    return judged.where("error is null").drop("error"), judged.where("error is not null").select("sample_id", "error")


def lineage_export(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(file_sha256, id, code) of lineage exports, and (file, problem).

    A file is a JSON list of objects, or comma or tab separated lines below a
    header.  Names are compared in lower case without signs, so spellings of
    "source genome id" and "LIN code" agree; each row keeps the digest of its
    whole file.  A file is one row's text.
    """
    top = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.sha2("content", 256).alias("file_sha256"), F.decode("content", "UTF-8").alias("text"))
    folded_ = lambda name: F.regexp_replace(F.lower(name), "[^a-z0-9]", "")
    lines = F.filter(F.split(F.col("text"), r"\r?\n"), lambda x: F.trim(x) != "")
    objects = F.from_json("text", "array<map<string, string>>")
    item = lambda line, o: F.struct(line.cast("string").alias("line"), o.cast("map<string, string>").alias("o"))
    none = F.lit(None)
    is_json = F.trim("text").startswith("[")
    items = F.when(is_json, F.transform(objects, lambda o: item(none, o))).otherwise(F.transform(F.slice(lines, F.lit(2), F.size(lines)), lambda x: item(x, none)))
    # A file is cut once, below the rows made of it, and a line where it has a row of its own; else the file would be cut again for each line.
    each = top.select("path", "file_sha256", F.when(~is_json, F.try_element_at(lines, F.lit(1))).alias("first"), items.alias("items"))
    each = each.select("path", "file_sha256", "first", F.explode_outer("items").alias("item"))
    sep = F.when(F.col("first").contains("\t"), "\t").otherwise(",")
    cells = lambda line: F.transform(F.split(line, sep), lambda x: F.trim(x))
    head = cells(F.col("first"))
    table = F.map_from_arrays(F.transform(head, folded_), F.slice(F.concat(cells(F.col("item.line")), F.array_repeat(F.lit(""), F.size(head))), F.lit(1), F.size(head)))
    folded = F.map_from_entries(F.transform(F.map_entries("item.o"), lambda e: F.struct(folded_(e["key"]).alias("key"), e["value"].alias("value"))))
    each = each.select("path", "file_sha256", F.when(F.col("item.line").isNotNull(), table).otherwise(folded).alias("row"))
    each = each.select("path", "file_sha256", F.try_element_at("row", F.lit("sourcegenomeid")).alias("id"), F.try_element_at("row", F.lit("lincode")).alias("code"))
    good = (F.coalesce("id", F.lit("")) != "") & F.col("code").isNotNull()
    return each.where(good).select("file_sha256", "id", "code"), each.where(~good).select(F.col("path").alias("file"), F.lit("no_id_or_code").alias("problem")).distinct()


def allele_export(df: DataFrame, sample: str, locus: str, allele: str) -> DataFrame:
    """(sample_id, locus, allele, status) of long rows: missing tokens are blank, repeats that disagree are ambiguous."""
    token = F.when(~one_of(text(F.col(allele)), V.NO_ALLELE), text(F.col(allele)))
    found = df.select(text(F.col(sample)).alias("sample_id"), text(F.col(locus)).alias("locus"), token.alias("allele")).groupBy("sample_id", "locus").agg(F.count_distinct("allele").alias("_n"), F.min("allele").alias("allele"))
    return found.select("sample_id", "locus", F.when(F.col("_n") == 1, F.col("allele")).alias("allele"), F.when(F.col("_n") == 0, "missing").when(F.col("_n") > 1, "ambiguous").otherwise("called").alias("status"))


def hierarchy_export(df: DataFrame, sample: str, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sample_id, level, cluster) of the ``HC...`` columns of a wide table, blanks left out, 0 kept; and ids that were asked but are absent, or present but not asked."""
    levels = [c for c in df.columns if c.startswith("HC") and c[2:].isdigit()]
    long = df.select(F.col(sample).alias("sample_id"), *levels).unpivot(["sample_id"], levels, "level", "cluster").where(text(F.col("cluster")) != "")
    ids = df.select(F.col(sample).alias("sample_id")).distinct()
    odd = asked.select("sample_id").join(ids, "sample_id", "left_anti").withColumn("problem", F.lit("absent")).unionByName(ids.join(asked, "sample_id", "left_anti").withColumn("problem", F.lit("not_asked")))
    return long, odd


def typing_results(df: DataFrame) -> DataFrame:
    """(sample_id, locus, allele, status) of typing envelopes (sample_id, genes array, code text joined by ``_``): several hits (``a|b``) are ambiguous."""
    each = df.select("sample_id", F.explode(F.arrays_zip("genes", F.split("code", "_").alias("codes"))).alias("z")).select("sample_id", F.col("z.genes").alias("locus"), F.col("z.codes").alias("hit"))
    status = F.when(F.col("hit").isNull() | one_of(text(F.col("hit")), V.NO_ALLELE), "missing").when(F.col("hit").contains("|"), "ambiguous").otherwise("called")
    return each.select("sample_id", "locus", F.when(status == "called", F.col("hit")).alias("allele"), status.alias("status"))


def best_match_prefix(df: DataFrame) -> DataFrame:
    """(sample_id, prefix, matches): the components in which all best matches (sample_id, codes array of arrays) agree."""
    first = F.element_at("codes", 1)
    agree = F.transform(first, lambda x, i: F.forall("codes", lambda k: F.coalesce(F.get(k, i) == x, F.lit(False))))
    length = F.aggregate(agree, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, x: F.struct((a["n"] + F.when(a["on"] & x, 1).otherwise(0)).alias("n"), (a["on"] & x).alias("on")), lambda a: a["n"])
    return df.select("sample_id", F.concat_ws("_", F.slice(first, F.lit(1), length)).alias("prefix"), F.size("codes").cast("bigint").alias("matches"))


def locus_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(scheme_id, scheme_version, complete, ordinal, locus) of catalogue JSON; ``complete`` must be stated."""
    raw = spark.read.option("multiLine", True).schema("scheme_id string, scheme_version string, complete boolean, loci array<string>").json(path)
    return raw.where(F.assert_true(F.col("complete").isNotNull(), F.lit("a catalogue must state whether it is complete")).isNull()).select("scheme_id", "scheme_version", "complete", F.posexplode("loci").alias("ordinal", "locus"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(path, ordinal, name, sequence) of FASTA files, plain or gzip: a file is one task's row, records stream out of it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for where, content in batch.itertuples(index=False, name=None):
                raw = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                out, name, parts = [], None, []
                for line in raw.decode("ascii").splitlines():
                    if line.startswith(">"):
                        if name is not None:
                            out.append((where, len(out), name, "".join(parts)))
                        name, parts = (line[1:].split() or [""])[0], []
                    elif line.strip():
                        parts.append(line.strip())
                if name is not None:
                    out.append((where, len(out), name, "".join(parts)))
                yield pd.DataFrame(out, columns=["path", "ordinal", "name", "sequence"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, ordinal int, name string, sequence string")


def alignment_violations(records: DataFrame) -> DataFrame:
    """(path, problem, n): repeated or empty names, empty sequences, and unequal lengths of each file."""
    per = records.groupBy("path").agg((F.count("*") - F.count_distinct("name")).alias("repeated_name"), F.count_if(F.col("name") == "").alias("empty_name"), F.count_if(F.length("sequence") == 0).alias("empty_sequence"), (F.count_distinct(F.length("sequence")) - 1).alias("unequal_length"))
    return per.unpivot(["path"], ["repeated_name", "empty_name", "empty_sequence", "unequal_length"], "problem", "n").where("n > 0")


def dna_catalogue(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(alleles, errors) of (locus, allele, dna): keys must be unique and sequences of A, C, G and T only."""
    n = df.groupBy("locus", "allele").agg(F.count("*").alias("_n"))
    judged = df.join(n, ["locus", "allele"]).withColumn("error", F.when(F.col("_n") > 1, "repeated_key").when(~F.upper("dna").rlike("^[ACGT]+$"), "not_dna"))
    return judged.where("error is null").select("locus", "allele", F.upper("dna").alias("dna")), judged.where("error is not null").select("locus", "allele", "error").distinct()


def region_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tool's tab separated table with a header."""
    return spark.read.option("header", True).option("sep", "\t").schema(schema).csv(path)
