"""Outputs of external programs, and compressed exports, read with their cross-checks.

What a program says in two places must agree; rows that break a rule come back
with the problem.
"""

from __future__ import annotations

import csv
import gzip
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What a window's record in the log begins with, and how it says its test's result.
WINDOW_MARK = "Checking for recombination at "
NORMAL_TEST = r"PHI \(Normal\):\s*(\S+)"
NUMBER = r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"


def window_profile(spark: SparkSession, table: str, log: str, planned: DataFrame) -> DataFrame:
    """(start, end, p, problem) of each planned window (start, end), and of windows that only the outputs have.

    ``table`` is a CSV of (centre, probability) lines without a header, ``log``
    the console's text; each of its records is a row, wherever files are cut.
    The log says whether a test was done; the table has its probability more
    exactly, which must agree with the log's to 0.6 %.
    """
    said = spark.read.option("lineSep", WINDOW_MARK).text(log).select(F.regexp_extract("value", r"^(\d+) between (\d+) and (\d+)", 0).alias("head"), "value").where("head != ''")
    part = lambda i: F.regexp_extract("value", r"^(\d+) between (\d+) and (\d+)", i).cast("bigint")
    said = said.select(part(1).alias("centre"), part(2).alias("start"), part(3).alias("end"), F.nullif(F.regexp_extract("value", NORMAL_TEST, 1), F.lit("")).alias("reported"))
    values = spark.read.schema("centre string, p string").option("ignoreLeadingWhiteSpace", True).csv(table).select(F.col("centre").try_cast("bigint").alias("centre"), F.col("p").try_cast("double").alias("exact"), F.lit(True).alias("listed"))
    once = lambda df: df.groupBy("centre").agg(*(F.min(c).alias(c) for c in df.columns if c != "centre"), F.count("*").alias("n"))
    plan = planned.select("start", "end", (F.col("start") + F.floor((F.col("end") - F.col("start")) / 2)).cast("bigint").alias("centre"))
    logged = once(said).select("centre", F.col("start").alias("log_start"), F.col("end").alias("log_end"), "reported", F.col("n").alias("log_n"))
    both = plan.join(logged, "centre", "full").join(once(values).withColumnRenamed("n", "table_n"), "centre", "full")
    rounded = F.col("reported").try_cast("double")
    done = ~(F.col("reported") == "--") & ~F.lower("reported").rlike("nan|inf")
    close = F.abs(F.col("exact") - rounded) <= F.greatest(0.006 * F.greatest(F.abs("exact"), F.abs(rounded)), F.lit(1e-300))
    problem = (
        F.when(F.col("start").isNull(), "not_planned")
        .when(F.col("log_start").isNull() | F.col("listed").isNull(), "not_covered")
        .when((F.col("log_n") > 1) | (F.col("table_n") > 1), "repeated")
        .when((F.col("log_start") != F.col("start")) | (F.col("log_end") != F.col("end")), "coordinates_disagree")
        .when(F.col("reported").isNull(), "no_status")
        .when(done & (F.col("exact").isNull() | rounded.isNull() | F.isnan("exact") | ~F.col("exact").between(0, 1)), "invalid_probability")
        .when(done & ~close, "probabilities_disagree")
    )
    return both.select(F.coalesce("start", "log_start").alias("start"), F.coalesce("end", "log_end").alias("end"), F.when(problem.isNull() & done, F.col("exact")).alias("p"), problem.alias("problem"))


def character_map(spark: SparkSession, path: str) -> DataFrame:
    """(code, state): the lines below "Character to attribute mapping:" up to a blank one; a malformed or repeated code is an error."""
    text = spark.read.text(path, wholetext=True)
    body = F.regexp_extract("value", r"(?s)Character to attribute mapping:[ \t]*\r?\n(.*?)(?:\r?\n[ \t]*\r?\n|\r?\n?$)", 1)
    lines = text.select(F.explode(F.split(body, r"\r?\n")).alias("line")).where("trim(line) != ''")
    found = lines.select(F.regexp_extract("line", r"^\s*(\S+):\s*(.+?)\s*$", 1).alias("code"), F.regexp_extract("line", r"^\s*(\S+):\s*(.+?)\s*$", 2).alias("state"))
    per = found.groupBy("code").agg(F.count("*").alias("n"), F.min("state").alias("state"))
    return per.where(F.assert_true((F.col("n") == 1) & (F.col("code") != ""), F.lit("malformed or repeated code")).isNull()).select("code", "state")


def ancestral_states(spark: SparkSession, table: str, mapping: str) -> tuple[DataFrame, DataFrame]:
    """(node, state, probability) of a table of confidences by coded character, and (node, problem).

    The table's first column is ``#name``, its others are codes of the map.
    """
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(table)
    name, codes = raw.columns[0], raw.columns[1:]
    if name.strip() != "#name" or not codes:
        raise ValueError("malformed header of the confidence table")
    known = character_map(spark, mapping)
    rows = raw.toDF("node", *codes)
    n = rows.groupBy("node").agg(F.count("*").alias("_n"))
    values = [F.col(f"`{code}`").try_cast("double") for code in codes]
    bad = F.greatest(*(F.coalesce(v.isNull() | F.isnan(v) | ~v.between(0, 1), F.lit(True)).cast("int") for v in [*values, F.lit(0.0)])) == 1
    why = F.when(F.coalesce(F.trim("node"), F.lit("")) == "", "no_name").when(F.col("_n") > 1, "repeated_node").when(bad, "invalid_probability")
    judged = rows.join(n, rows["node"].eqNullSafe(n["node"])).drop(n["node"]).withColumn("problem", why)
    # A code for each state: few.
    long = judged.where("problem is null").select("node", F.explode(F.map_from_arrays(F.array(*map(F.lit, codes)), F.array(*values))).alias("code", "probability"))
    met = long.join(known, "code", "left")
    unmapped = spark.createDataFrame([(code,) for code in codes], "code string").join(known, "code", "left_anti").select(F.col("code").alias("node"), F.lit("unmapped_code").alias("problem"))
    return met.where("state is not null").select("node", "state", "probability"), judged.where("problem is not null").select("node", "problem").distinct().unionByName(unmapped)


def clock_fits(spark: SparkSession, path: str) -> DataFrame:
    """(file, rate, rate_sd, r_squared, low, high, problem) of clock reports; the interval is rate +- 1.96 standard deviations."""
    text = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file"), "value")
    one = lambda pattern: F.regexp_extract("value", pattern, 1).try_cast("double")
    rate, sd, r2 = one(rf"(?m)rate:\s*({NUMBER})"), one(rf"(?m)rate:\s*{NUMBER}\s*\+/-\s*({NUMBER})"), one(rf"(?m)r\^2:\s*({NUMBER})")
    return text.select("file", rate.alias("rate"), sd.alias("rate_sd"), r2.alias("r_squared"), (rate - 1.96 * sd).alias("low"), (rate + 1.96 * sd).alias("high"), F.when(rate.isNull() | r2.isNull(), "not_a_clock_report").when(sd.isNull(), "no_uncertainty").alias("problem"))


def node_dates(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(node, estimate, low, high) of a table with columns node, numeric_date, lower_bound and upper_bound, and (node, problem)."""
    raw = spark.read.option("header", True).csv(path)
    absent = {"node", "numeric_date", "lower_bound", "upper_bound"} - set(raw.columns)
    if absent:
        raise ValueError(f"columns missing: {sorted(absent)}")
    number = lambda c: F.when(~F.isnan(F.col(c).try_cast("double")) & (F.abs(F.col(c).try_cast("double")) < float("inf")), F.col(c).try_cast("double"))
    given = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) != ""
    n = raw.groupBy("node").agg(F.count("*").alias("_n"))
    low, high, point = number("lower_bound"), number("upper_bound"), number("numeric_date")
    why = (
        F.when(F.coalesce(F.col("node"), F.lit("")) == "", "no_node").when(F.col("_n") > 1, "repeated_node").when(point.isNull(), "invalid_date")
        .when((given("lower_bound") & low.isNull()) | (given("upper_bound") & high.isNull()), "invalid_bound").when(given("lower_bound") != given("upper_bound"), "half_an_interval")
        .when(low.isNotNull() & ~point.between(low, high), "date_outside_interval")
    )
    judged = raw.join(n, raw["node"].eqNullSafe(n["node"])).drop(n["node"]).withColumn("problem", why)
    return judged.where("problem is null").select("node", point.alias("estimate"), low.alias("low"), high.alias("high")), judged.where("problem is not null").select("node", "problem").distinct()


def export_content(content: bytes, most: int) -> tuple[io.TextIOBase | None, str | None]:
    """The text of an export that is plain, gzip, or a zip file with one member of at most ``most`` bytes."""
    try:
        if content[:2] == b"\x1f\x8b":
            content = gzip.GzipFile(fileobj=io.BytesIO(content)).read(most + 1)
            if len(content) > most:
                return None, "too_large"
        if content[:2] == b"PK":
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                members = [m for m in archive.infolist() if not m.is_dir()]
                if len(members) != 1:
                    return None, "not_one_member"
                if members[0].file_size > most:
                    return None, "too_large"
                content = archive.read(members[0])
        return io.StringIO(content.decode("utf-8-sig")), None
    except (OSError, EOFError, zipfile.BadZipFile, UnicodeDecodeError):
        return None, "unreadable"


def long_export(spark: SparkSession, path: str, columns: tuple[str, str, str] = ("Genome ID", "Gene", "Allele ID"), most: int = 200_000_000, requested: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(file, genome, locus, allele) of long allele exports, and (file, name, problem); genomes that were not ``requested`` (genome) are a problem.

    Files are read whole, one a row, so ``most`` bounds what a task holds.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in batch.itertuples(index=False, name=None):
                stream, problem = export_content(content, most)
                reader = csv.DictReader(stream) if stream else None
                if reader is not None and not set(columns) <= set(reader.fieldnames or []):
                    reader, problem = None, "unsupported_columns"
                if reader is None:
                    yield pd.DataFrame({"file": [file], "genome": [None], "locus": [None], "allele": [None], "problem": [problem]})
                    continue
                held: list[tuple] = []
                for row in reader:
                    held.append((file, *(row[c] for c in columns), None))
                    if len(held) == 50_000:
                        yield pd.DataFrame(held, columns=["file", "genome", "locus", "allele", "problem"])
                        held = []
                yield pd.DataFrame(held, columns=["file", "genome", "locus", "allele", "problem"])

    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content").mapInPandas(run, "file string, genome string, locus string, allele string, problem string")
    token = F.trim("allele")
    missing = F.coalesce(token, F.lit("")).isin("", "0", "-", "?", "None", "null")
    valid = missing | token.rlike("^0*[1-9][0-9]*$") | token.rlike("^[0-9a-fA-F]{40}$")
    wrong = F.coalesce("problem", F.when(F.coalesce("locus", F.lit("")) == "", "no_locus").when(~valid, "unsupported_allele"))
    judged = rows.withColumn("problem", wrong)
    if requested is not None:
        asked = requested.select("genome").distinct().withColumn("_asked", F.lit(True))
        judged = judged.join(asked, "genome", "left").withColumn("problem", F.coalesce("problem", F.when(F.col("_asked").isNull(), "not_requested"))).drop("_asked")
    good = judged.where("problem is null").select("file", "genome", "locus", F.when(~missing, F.when(token.rlike("^[0-9]+$"), F.regexp_replace(token, "^0+", "")).otherwise(F.lower(token))).alias("allele"))
    return good, judged.where("problem is not null").select("file", F.col("genome").alias("name"), "problem").distinct()


def named(column: Column) -> Column:
    """The last part of a path."""
    return F.element_at(F.split(column, "/"), -1)
