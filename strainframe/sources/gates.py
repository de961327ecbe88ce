"""Sources that are checked as they are read: assemblies, archives of assemblies, allele indexes, evidence in JSON.

Every file, member or row that fails gives a row with its problem; nothing is
dropped silently.
"""

from __future__ import annotations

import gzip
import io
import json
import math
import re
import sqlite3
import zipfile
from collections.abc import Iterator
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys whose values are credentials, and the letters of nucleotide sequences.
SECRET_KEYS = ("api_key", "apikey", "token", "access_token", "password", "authorization", "credentials", "secret", "client_secret")
BASES = b"ACGTRYSWKMBDHVNacgtryswkmbdhvn"

#: The largest member of an archive that is unpacked, in bytes.
MEMBER_BYTES = 100_000_000


def assembly_problem(content: bytes) -> tuple[int, int, str | None]:
    """Contigs, bases, and what is wrong with a FASTA file (plain or gzip), if anything."""
    if content[:2] == b"\x1f\x8b":
        try:
            content = gzip.decompress(content)
        except (OSError, EOFError):
            return 0, 0, "corrupt_gzip"
    if not content.isascii():
        return 0, 0, "not_ascii"
    lines = [line.strip() for line in content.splitlines()]
    if not lines or not lines[0].startswith(b">"):
        return 0, 0, "not_fasta"
    lengths: list[int] = []
    for line in filter(None, lines):
        if line.startswith(b">"):
            lengths.append(0)
        elif line.translate(None, BASES):
            return 0, 0, "invalid_characters"
        else:
            lengths[-1] += len(line)
    return len(lengths), sum(lengths), None if all(lengths) else "empty_contig"


def assemblies(spark: SparkSession, path: str) -> DataFrame:
    """(path, contigs, bases, problem), one row for each file."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [(where, *assembly_problem(bytes(raw))) for where, raw in zip(frame["path"], frame["content"], strict=True)]
            yield pd.DataFrame(found, columns=["path", "contigs", "bases", "problem"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, contigs long, bases long, problem string")


def archive_members(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(path, member, source, contigs, bases, problem) of the files in zip archives, joined to ``wanted`` (stem, source) by exact stem only."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for where, raw in zip(frame["path"], frame["content"], strict=True):
                yield pd.DataFrame(list(members(where, bytes(raw))), columns=["path", "member", "stem", "contigs", "bases", "problem"])

    def members(where: str, raw: bytes) -> Iterator[tuple]:
        try:
            archive = zipfile.ZipFile(io.BytesIO(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw))
        except (zipfile.BadZipFile, OSError, EOFError):
            yield where, None, None, 0, 0, "not_zip"
            return
        for member in archive.infolist():
            if not member.is_dir():
                stem = re.sub(r"(?i)\.(fasta|fna|fa)(\.gz)?$", "", PurePosixPath(member.filename).name)
                yield where, member.filename, stem, *((0, 0, "too_large") if member.file_size > MEMBER_BYTES else assembly_problem(archive.read(member)))

    found = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, member string, stem string, contigs long, bases long, problem string")
    again = found.where("stem is not null").groupBy("path", "stem").agg(F.count("*").alias("_n"))
    joined = found.join(again, ["path", "stem"], "left").join(wanted.select("stem", "source"), "stem", "left")
    problem = F.when(F.col("stem").isNull(), F.col("problem")).when(F.col("source").isNull(), "not_requested").when(F.col("_n") > 1, "repeated_id").otherwise(F.col("problem"))
    return joined.select("path", "member", "source", "contigs", "bases", problem.alias("problem"))


def allele_index(spark: SparkSession, path: str, loci: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(alleles, problems) of SQLite index files; see ``alleles_of``."""
    return alleles_of(spark.read.format("binaryFile").load(path).select("path", "content"), loci)


def alleles_of(files: DataFrame, loci: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(alleles, problems) of SQLite indexes (path, content): forward rows (locus, number, sha1) of table ``alleles``; one wrong row makes its key a problem."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for where, raw in zip(frame["path"], frame["content"], strict=True):
                with sqlite3.connect(":memory:") as index:
                    index.deserialize(bytes(raw))
                    rows = index.execute("SELECT gene, CAST(st AS TEXT), hash FROM alleles WHERE reverse = 0")
                    while some := rows.fetchmany(50_000):
                        yield pd.DataFrame([(where, *r) for r in some], columns=["path", "locus", "number", "sha1"])
                index.close()

    rows = files.select("path", "content").mapInPandas(run, "path string, locus string, number string, sha1 string")
    known = rows.join(loci.select("locus").distinct().withColumn("_known", F.lit(True)), "locus", "left")
    versions = known.groupBy("path", "locus", "number").agg(F.count_distinct("sha1").alias("_versions"), F.first("_known").alias("_known"), F.min("sha1").alias("sha1"), F.bool_and(F.coalesce(F.col("sha1").rlike("^[0-9a-f]{40}$"), F.lit(False))).alias("_hex"))
    problem = F.when(F.col("_known").isNull(), "unknown_locus").when(~F.col("_hex"), "invalid_digest").when(~F.coalesce(F.col("number").rlike("^0*[1-9][0-9]*$"), F.lit(False)), "invalid_number").when(F.col("_versions") > 1, "conflicting_sequences")
    judged = versions.withColumn("problem", problem)
    return judged.where("problem is null").select("locus", "number", "sha1"), judged.where("problem is not null").select("locus", "number", "problem")


def evidence_problem(text: str | None) -> str | None:
    """What keeps a JSON text from being portable evidence: no JSON, numbers that are not finite, or a credential's key at any depth."""
    if text is None:
        return "missing"
    try:
        open_ = [json.loads(text)]
    except ValueError:
        return "not_json"
    while open_:
        value = open_.pop()
        if isinstance(value, dict):
            if any(key.casefold().replace("-", "_") in SECRET_KEYS for key in value):
                return "secret_key"
            open_ += value.values()
        elif isinstance(value, list):
            open_ += value
        elif isinstance(value, float) and not math.isfinite(value):
            return "not_finite"
    return None


def evidence_problems(column: Column) -> Column:
    """``evidence_problem`` of every row, a batch at a time."""

    @F.pandas_udf("string")
    def run(texts):  # noqa: ANN001, ANN202
        return texts.map(evidence_problem)

    return run(column)
