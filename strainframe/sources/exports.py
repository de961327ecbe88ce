"""Exports of public typing, index pages of schemes, and the allele files they list.

A typing export is used whole or not at all: one row that breaks a rule keeps
its file's other rows out too, and every such row comes back with its problem.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from .gates import BASES
from .records import RECORD, as_type, field, prefixed

# The kinds of assignment a row may carry, allele calls that stand for none, and names of allele files.
KINDS = ("cgmlst", "hiercc", "cglin")
NO_CALL = ("", "0", "?", "-")
ALLELE_FILE = r"([A-Za-z0-9][A-Za-z0-9_.-]*)\.fasta\.gz"

#: The most loci of a scheme, and the most bytes an allele file may unpack to.
SCHEME_LOCI = 10_000
ALLELE_BYTES = 256 * 1024**2

TEXTS = "map<string, string>"
SHA1, SHA256 = "^[0-9a-fA-F]{40}$", "^[0-9a-fA-F]{64}$"


def is_text(name: str) -> Column:
    """Whether a field is a text that is not blank."""
    kind = F.schema_of_variant(F.try_element_at("record", F.lit(name)))
    return F.coalesce((kind == "STRING") & (S.text(field(name)) != ""), F.lit(False))


def is_map(name: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_element_at("record", F.lit(name))).startswith("OBJECT"), F.lit(False))


def profile_parts() -> tuple[Column, Column, Column, Column]:
    """(problem, loci, calls, novel calls) of a row's profile."""
    none = F.create_map().cast(TEXTS)
    loci = field("cgmlst_loci", "array<string>")
    given = F.coalesce(field("cgmlst_profile", TEXTS), none)
    called = F.map_filter(given, lambda _, v: ~S.text(v).isin(*NO_CALL))
    novel = F.coalesce(field("cgmlst_novel_alleles", TEXTS), none)
    stray = lambda m: F.size(F.array_except(F.map_keys(m), loci)) > 0
    absent = F.coalesce(F.schema_of_variant(F.try_element_at("record", F.lit("cgmlst_novel_alleles"))) == "VOID", F.lit(True))
    problem = (
        F.when(loci.isNull() | (F.size(loci) == 0) | F.exists(loci, lambda x: x.isNull() | (x == "")) | (F.size(F.array_distinct(loci)) != F.size(loci)), "no_locus_universe")
        .when(~is_map("cgmlst_profile") | stray(given), "undeclared_loci")
        .when(F.exists(F.map_values(called), lambda v: S.comparable_allele(v).isNull()), "invalid_allele")
        .when((~is_map("cgmlst_novel_alleles") & ~absent) | stray(novel) | F.arrays_overlap(F.map_keys(novel), F.map_keys(called)), "invalid_novel_loci")
        .when(F.exists(F.map_values(novel), lambda v: ~F.coalesce(v.rlike(SHA1), F.lit(False))), "invalid_novel_allele")
    )
    return problem, loci, F.transform_values(called, lambda _, v: S.comparable_allele(v)), F.transform_values(novel, lambda _, v: F.lower(v))


def cluster_parts() -> tuple[Column, Column]:
    """(problem, entries level and cluster) of a row's hierarchical clusters; levels without leading zeros."""
    number = lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")
    given = F.map_entries(F.coalesce(field("hiercc_codes", TEXTS), F.create_map().cast(TEXTS)))
    entries = F.transform(given, lambda e: F.struct(F.concat(F.lit("HC"), number(F.regexp_extract(e["key"], "([0-9]+)$", 1))).alias("key"), number(S.text(e["value"])).alias("value")))
    problem = (
        F.when(~is_map("hiercc_codes"), "no_codes")
        .when(F.exists(given, lambda e: ~F.coalesce(e["key"].rlike("^(HC|d)[0-9]+$") & S.text(e["value"]).rlike("^[0-9]+$"), F.lit(False))), "invalid_code")
        .when(F.size(F.array_distinct(F.transform(entries, lambda e: e["key"]))) != F.size(entries), "repeated_level")
    )
    return problem, entries


def public_typing(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(assignments, problems) of JSON exports, each a list of rows or an object with ``assignments``.

    ``assignments`` have one row for each kind of a source row: (file,
    source_genome_id, export_sha256, ordinal from 1, kind, scheme, version,
    database_sha256, source, status, loci, calls, novel, called_fraction,
    code).  The export's digest names the file, never the typing database.
    ``problems`` are (file, ordinal, kind, problem), ordinal null for whole files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    top = files.select(F.col("path").alias("file"), F.sha2("content", 256).alias("export_sha256"), F.try_parse_json(F.col("content").cast("string")).alias("v"))
    listed = F.coalesce(as_type(F.col("v"), "array<variant>"), as_type(F.try_element_at(as_type(F.col("v"), RECORD), F.lit("assignments")), "array<variant>"))
    parts = top.select("file", "export_sha256", listed.alias("rows"), F.when(F.col("v").isNull(), "not_json").when(listed.isNull() | (F.size(listed) == 0), "no_assignments").alias("problem"))
    each = parts.where("problem is null").select("file", "export_sha256", F.posexplode("rows").alias("at", "v"))
    each = each.select("file", "export_sha256", (F.col("at") + 1).alias("ordinal"), as_type(F.col("v"), RECORD).alias("record"))
    profile_problem, loci, calls, novel = profile_parts()
    cluster_problem, clusters = cluster_parts()
    raw = S.text(field("cglin_raw"))
    many = F.size(calls) + F.size(novel)
    own = {
        "cgmlst": (profile_problem, F.when(many > 0, "resolved").otherwise("unassigned"), loci, calls, novel, many / F.size(loci), None),
        "hiercc": (cluster_problem, F.when(F.size(clusters) > 0, "resolved").otherwise("unassigned"), None, F.map_from_entries(F.when(cluster_problem.isNull(), clusters)), None, None, None),
        "cglin": (F.lit(None).cast("string"), None, None, None, None, None, F.when(S.lineage_status(raw).isin("complete", "partial") & ~F.coalesce(field("cglin_status") == "conflict", F.lit(False)), raw)),
    }

    def entry(kind: str) -> Column:
        problem, status, loci, calls, novel, share, code = own[kind]
        sha = field(f"{kind}_database_sha256")
        scope = F.when(~(is_text(f"{kind}_scheme") & is_text(f"{kind}_scheme_version")), "no_scope").when(sha.isNotNull() & ~sha.rlike(SHA256), "invalid_fingerprint")
        declared = F.when(field(f"{kind}_status") != "", field(f"{kind}_status"))
        state = F.coalesce(declared, status) if status is not None else F.when(declared == "conflict", declared).otherwise(S.lineage_status(raw))
        columns = {
            "kind": F.lit(kind), "problem": F.coalesce(scope, problem), "scheme": S.text(field(f"{kind}_scheme")), "version": S.text(field(f"{kind}_scheme_version")), "database_sha256": F.lower(sha),
            "source": F.coalesce(F.when(field(f"{kind}_source") != "", field(f"{kind}_source")), F.lit("imported_public_typing")), "status": state,
            "loci": F.lit(None).cast("array<string>") if loci is None else loci, "calls": F.lit(None).cast(TEXTS) if calls is None else calls, "novel": F.lit(None).cast(TEXTS) if novel is None else novel,
            "called_fraction": F.lit(None).cast("double") if share is None else share, "code": F.lit(None).cast("string") if code is None else code,
        }
        return F.when(F.size(prefixed(f"{kind}_")) > 0, F.struct(*(v.alias(k) for k, v in columns.items())))

    ident = field("source_genome_id")
    exact = is_text("source_genome_id") & ~ident.rlike(r"^\s|\s$")
    judged = each.select("file", "export_sha256", "ordinal", ident.alias("source_genome_id"), F.when(F.col("record").isNull(), "not_an_object").when(~exact, "no_source_id").alias("wrong"), F.array_compact(F.array(*map(entry, KINDS))).alias("found"))
    judged = judged.withColumn("wrong", F.coalesce("wrong", F.when(F.size("found") == 0, "no_assignment")))
    kinds = judged.where("wrong is null").select("file", "export_sha256", "ordinal", "source_genome_id", F.explode("found").alias("e")).select("file", "source_genome_id", "export_sha256", "ordinal", "e.*")
    problems = reduce(
        DataFrame.unionByName,
        [
            parts.where("problem is not null").select("file", F.lit(None).cast("int").alias("ordinal"), F.lit(None).cast("string").alias("kind"), "problem"),
            judged.where("wrong is not null").select("file", "ordinal", F.lit(None).cast("string").alias("kind"), F.col("wrong").alias("problem")),
            kinds.where("problem is not null").select("file", "ordinal", "kind", "problem"),
        ],
    )
    return kinds.where("problem is null").drop("problem").join(problems.select("file").distinct(), "file", "left_anti"), problems


def scheme_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(allele files, problems) of index pages that link one allele file a line, its size in bytes at the line's end.

    ``allele files`` are (file, locus, filename, bytes), without those of a page
    with any problem; ``problems`` are (file, locus, problem).  A page without
    a line is empty and has no row of either kind.
    """
    lines = spark.read.text(path, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file"), "value")
    name = F.regexp_extract("value", r'<a\s+href="([^"]+)"', 1)
    size = F.regexp_extract(F.regexp_replace("value", "<[^>]+>", ""), r"\s(\d+)\s*$", 1)
    links = lines.select("file", F.when(name.rlike(f"^{ALLELE_FILE}$"), name).alias("filename"), size.alias("size"))
    links = links.select("file", "filename", F.regexp_extract("filename", f"^{ALLELE_FILE}$", 1).alias("locus"), F.col("size").try_cast("bigint").alias("bytes"))
    loci = links.where("filename is not null").groupBy("file", "locus").agg(F.count("*").alias("rows"), F.min("filename").alias("filename"), F.min(F.coalesce("bytes", F.lit(0))).alias("bytes"))
    pages = links.groupBy("file").agg(F.count("filename").alias("rows"))
    whole = pages.select("file", F.lit(None).cast("string").alias("locus"), F.when(F.col("rows") == 0, "no_loci").when(F.col("rows") > SCHEME_LOCI, "too_many_loci").alias("problem"))
    single = loci.select("file", "locus", F.when(F.col("bytes") <= 0, "missing_size").when(F.col("rows") > 1, "repeated_locus").alias("problem"))
    problems = whole.unionByName(single).where("problem is not null")
    return loci.join(problems.select("file").distinct(), "file", "left_anti").select("file", "locus", "filename", "bytes"), problems


def allele_file_problem(content: bytes, most: int = ALLELE_BYTES) -> tuple[int, int, str | None]:
    """Alleles, unpacked bytes, and what is wrong with a gzip FASTA file of alleles, if anything; never unpacks more than ``most``."""
    unpacked = zlib.decompressobj(wbits=31)
    try:
        text = unpacked.decompress(content, most + 1)
    except zlib.error:
        return 0, 0, "corrupt_gzip"
    if len(text) > most:
        return 0, 0, "too_large"
    if not unpacked.eof:
        return 0, 0, "corrupt_gzip"
    if not text.isascii():
        return 0, 0, "not_ascii"
    first, *records = (b"\n" + text.replace(b"\r\n", b"\n")).split(b"\n>")
    if first.strip():
        return 0, 0, "not_fasta"
    names = set()
    for record in records:
        head, _, sequence = record.partition(b"\n")
        name, letters = head.split()[:1], b"".join(sequence.split())
        if not name or name[0] in names:
            return 0, 0, "repeated_or_no_name"
        names.add(name[0])
        if not letters:
            return 0, 0, "empty_allele"
        if letters.translate(None, BASES):
            return 0, 0, "invalid_characters"
    return len(names), len(text), None if names else "empty"


def allele_files(files: DataFrame) -> DataFrame:
    """(path, alleles, bytes, problem) of allele files (path, content)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [(where, *allele_file_problem(bytes(raw))) for where, raw in zip(frame["path"], frame["content"], strict=True)]
            yield pd.DataFrame(found, columns=["path", "alleles", "bytes", "problem"])

    return files.select("path", "content").mapInPandas(run, "path string, alleles long, bytes long, problem string")
