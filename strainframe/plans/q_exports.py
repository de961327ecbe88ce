"""Queries over typing exports, scheme indexes, allele files, and the rules that guard a step."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import guards as G
from ..operators import validate as X
from ..sources import exports as E
from .q_sources import place
from .registry import query

c = F.col


def supplier(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/supplier.parquet")


def kind_of(path: str) -> Column:
    return F.regexp_extract(path, "kind=([0-9]+)", 1).cast("bigint")


@query("""WITH s AS (SELECT s_suppkey k, s_suppkey % 5 AS kind, s_suppkey // 500 AS part FROM supplier), n AS (SELECT *, row_number() OVER (PARTITION BY kind, part ORDER BY k) AS place FROM s)
 SELECT kind, 'cgmlst' AS typed, 'resolved' outcome, count(*) n, sum(2 + (k % 3 = 0)::INT)::BIGINT AS calls FROM s WHERE kind = 0 GROUP BY 1
 UNION ALL SELECT kind, 'hiercc', CASE WHEN k % 2 = 0 THEN 'resolved' ELSE 'unassigned' END, count(*), sum(CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END)::BIGINT FROM s WHERE kind = 1 GROUP BY 1, 3
 UNION ALL SELECT kind, 'cglin', CASE WHEN k % 3 = 0 THEN 'conflict' ELSE 'partial' END, count(*), sum(CASE WHEN k % 3 = 0 THEN 0 ELSE 1 END)::BIGINT FROM s WHERE kind = 2 GROUP BY 1, 3
 UNION ALL SELECT kind, 'cgmlst', 'invalid_allele', count(*), NULL FROM n WHERE kind = 3 AND place = 1 GROUP BY 1
 UNION ALL SELECT kind, NULL, 'not_json', count(DISTINCT part), NULL FROM s WHERE kind = 4 GROUP BY 1""")
def s15_public_typing(spark: SparkSession, sf: str) -> DataFrame:
    """Exports of up to 100 rows: profiles, clusters in an envelope, lineage codes, one wrong row in a file, and no JSON."""
    at, k = place(spark, "typing"), c("s_suppkey")
    rows = supplier(spark, sf).select(k, (k % 5).alias("kind"), F.floor(k / 500).alias("part"))
    ident = F.concat(F.lit("g"), k.cast("string")).alias("source_genome_id")
    scope = lambda name: (F.lit("scheme").alias(f"{name}_scheme"), F.lit("1").alias(f"{name}_scheme_version"))
    profile = F.create_map(F.lit("l1"), F.lit("007"), F.lit("l2"), F.sha1(k.cast("string")), F.lit("l3"), F.when(k % 3 == 0, "2").otherwise(" ? "))
    first = F.lit(True).alias("first")
    rows = rows.join(rows.groupBy("kind", "part").agg(F.min("s_suppkey").alias("s_suppkey")).select("s_suppkey", first), "s_suppkey", "left")
    wrong = F.create_map(F.lit("l1"), F.when(c("first"), "00").otherwise("1"))
    loci = F.array(F.lit("l1"), F.lit("l2"), F.lit("l3")).alias("cgmlst_loci")
    bodies = [
        F.to_json(F.struct(ident, *scope("cgmlst"), loci, profile.alias("cgmlst_profile"))),
        F.to_json(F.struct(ident, *scope("hiercc"), F.when(k % 2 == 0, F.create_map(F.lit("d010"), k.cast("string"))).otherwise(F.create_map().cast(E.TEXTS)).alias("hiercc_codes"))),
        F.to_json(F.struct(ident, *scope("cglin"), F.lit("1_2_3").alias("cglin_raw"), F.when(k % 3 == 0, "conflict").alias("cglin_status"))),
        F.to_json(F.struct(ident, *scope("cgmlst"), loci, wrong.alias("cgmlst_profile"))),
        F.lit("{"),
    ]
    body = F.element_at(F.array(*bodies), (c("kind") + 1).cast("int"))
    files = rows.groupBy("kind", "part").agg(F.concat(F.lit("["), F.array_join(F.collect_list(body), ","), F.lit("]")).alias("all"))
    value = F.when(c("kind") == 1, F.concat(F.lit('{"assignments": '), c("all"), F.lit("}"))).otherwise(c("all"))
    files.select("kind", "part", value.alias("value")).repartition("kind", "part").write.partitionBy("kind", "part").text(at)
    good, bad = E.public_typing(spark, at)
    calls = F.coalesce(F.size("calls"), F.lit(0)) + F.when(c("code").isNotNull(), 1).otherwise(0)
    calls = F.when(c("kind") == "cglin", F.when(c("code").isNotNull(), 1).otherwise(0)).otherwise(calls)
    every = good.select("file", c("kind").alias("typed"), c("status").alias("outcome"), calls.cast("bigint").alias("calls")).unionByName(bad.select("file", c("kind").alias("typed"), c("problem").alias("outcome"), F.lit(None).cast("bigint").alias("calls")))
    return every.groupBy(kind_of("file").alias("kind"), "typed", "outcome").agg(F.count("*").alias("n"), F.sum("calls").alias("calls"))


@query("""WITH s AS (SELECT s_suppkey k, s_nationkey AS kind FROM supplier)
 SELECT kind, NULL problem, count(*) files, sum(k + 1)::BIGINT bytes FROM s WHERE kind % 3 = 0 GROUP BY 1
 UNION ALL SELECT kind, 'missing_size', count(*), NULL FROM s WHERE kind % 3 = 1 GROUP BY 1 UNION ALL SELECT kind, 'repeated_locus', count(*), NULL FROM s WHERE kind % 3 = 2 GROUP BY 1""")
def s28_scheme_index(spark: SparkSession, sf: str) -> DataFrame:
    """An index page for each nation; one in three lacks sizes, one repeats each locus."""
    at, k = place(spark, "index"), c("s_suppkey").cast("string")
    name = F.concat(F.lit("L"), k, F.lit(".fasta.gz"))
    line = F.concat(F.lit('<a href="'), name, F.lit('">'), name, F.lit("</a>  01-Jan-2024  "), F.when(c("s_nationkey") % 3 == 1, "-").otherwise((c("s_suppkey") + 1).cast("string")))
    lines = F.when(c("s_nationkey") % 3 == 2, F.array(line, line)).otherwise(F.array(line, F.lit('<a href="../">up</a> 5')))
    supplier(spark, sf).select(c("s_nationkey").alias("kind"), F.explode(lines).alias("value")).repartition("kind").write.partitionBy("kind").text(at)
    good, bad = E.scheme_index(spark, at)
    every = good.select("file", F.lit(None).cast("string").alias("problem"), "bytes").unionByName(bad.select("file", "problem", F.lit(None).cast("bigint").alias("bytes")))
    return every.groupBy(kind_of("file").alias("kind"), "problem").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


@query("""SELECT [NULL, 'corrupt_gzip', 'repeated_or_no_name', 'empty_allele', 'invalid_characters', 'not_fasta'][s_suppkey % 6 + 1] problem, count(*) files, sum(CASE WHEN s_suppkey % 6 = 0 THEN 2 ELSE 0 END)::BIGINT alleles FROM supplier GROUP BY 1""")
def s28_allele_files(spark: SparkSession, sf: str) -> DataFrame:
    """A gzip FASTA file of alleles for each supplier, five of six of them broken."""
    k = c("s_suppkey") % 6
    text = F.when(k == 2, ">a\nAC\n>a\nGT\n").when(k == 3, ">a\n>b\nGT\n").when(k == 4, ">a\nA!\n").when(k == 5, "ACGT\n").otherwise(">a\nAC\n>b x\nGT\n")

    def pack(frames):  # noqa: ANN001, ANN202
        for f in frames:
            raw = [gzip.compress(t.encode()) for t in f["text"]]
            yield pd.DataFrame({"path": f["path"], "content": [r[:-9] if cut else r for r, cut in zip(raw, f["cut"], strict=True)]})

    files = supplier(spark, sf).select(c("s_suppkey").cast("string").alias("path"), text.alias("text"), (k == 1).alias("cut")).mapInPandas(pack, "path string, content binary")
    return E.allele_files(files).groupBy("problem").agg(F.count("*").alias("files"), F.sum("alleles").alias("alleles"))


@query("""SELECT p_partkey AS id, (p_partkey % 7 <> 0 AND p_partkey % 2 = 0) AS cgmlst, (p_partkey % 7 <> 0 AND p_partkey % 3 = 0 AND p_partkey % 5 = 0) AS lincodes, (p_partkey % 7 <> 0 AND p_partkey % 3 = 1 AND p_partkey % 4 <> 0 AND p_partkey % 5 <> 0) AS hiercc FROM part""")
def v10_export_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    k = c("p_partkey")
    rows = spark.read.parquet(f"{sf}/part.parquet").select(
        k.alias("id"), F.when(k % 7 != 0, k.cast("string")).otherwise("x1").alias("numeric_source_id"), F.when(k % 3 == 0, "Klebsiella pneumoniae").when(k % 3 == 1, "Escherichia COLI").alias("species"),
        F.when(k % 4 != 0, "562").otherwise("28901").alias("organism_id"), F.when(k % 2 == 1, True).alias("has_profile"), F.when(k % 5 != 0, "1_2").alias("lineage"), (k % 5 == 0).alias("has_clusters"),
    )
    return rows.select("id", *(rule.alias(name) for name, rule in G.export_eligible().items()))


@query("""SELECT sample_id, CASE sample_id % 5 WHEN 1 THEN 'not_aligned' WHEN 2 THEN 'not_in_input' WHEN 3 THEN 'invalid_letters' WHEN 4 THEN 'changed_sequence' END problem FROM (SELECT p_partkey sample_id FROM part) WHERE sample_id % 5 <> 0 UNION ALL SELECT NULL, 'unequal_widths'""")
def v11_alignment_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that are lost, new, not nucleotides or changed, in an alignment of several widths."""
    k = c("sample_id")
    rows = spark.read.parquet(f"{sf}/part.parquet").select(c("p_partkey").alias("sample_id"))
    aligned = rows.where(k % 5 != 1).select(k, F.when(k % 5 == 3, "ACN-T").when(k % 5 == 4, "AC-GG").otherwise(F.when(k % 2 == 0, "AC-GT").otherwise("AC--GT")).alias("seq"))
    return G.alignment_problems(aligned, rows.where(k % 5 != 2).select(k, F.lit("ACGT").alias("seq")))


@query("""SELECT CASE WHEN k % 6 = 1 OR k % 6 = 2 THEN 'unverified' WHEN k % 6 = 3 OR k % 10 = 0 THEN 'scope_mismatch' WHEN k % 6 = 4 THEN 'no_checksum' END problem, count(*) n FROM (SELECT p_partkey k FROM part) GROUP BY 1""")
def v11_source_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Details of another source, not public ones, of another species or type, and without a checksum."""
    k, name = c("p_partkey"), c("p_partkey").cast("string")
    row = F.struct(F.lit("562").alias("organism_id"), F.lit("Escherichia coli").alias("species"), F.lit(None).cast("string").alias("mlst_scheme"), F.when(k % 10 == 0, "11").otherwise("10").alias("mlst_st"))
    detail = F.struct(
        F.when(k % 6 == 1, "other").otherwise(name).alias("uuid"), F.when(k % 6 == 2, "PRIVATE").when(k % 2 == 0, "PUBLIC").alias("access"), F.lit("562").alias("organism_id"), F.when(k % 6 == 3, "Salmonella enterica").otherwise("escherichia coli").alias("species"),
        F.lit("9").alias("mlst"), F.lit("10").alias("mlst2"), F.when(k % 6 != 4, F.sha1(name)).alias("checksum"),
    )
    return spark.read.parquet(f"{sf}/part.parquet").select(G.identity_problem(name, row, detail).alias("problem")).groupBy("problem").agg(F.count("*").alias("n"))


@query("""SELECT rule, count(*) n FROM (SELECT unnest([CASE WHEN k % 4 = 3 THEN 'unknown_method' END, CASE WHEN k % 300 < 200 THEN 'window_below_200' END, CASE WHEN k % 50 > k % 300 OR k % 50 = 0 THEN 'step_outside_window' END, CASE WHEN k % 12 = 0 OR k % 12 = 11 THEN 'threshold_outside' END,
 CASE WHEN k % 2000 BETWEEN 1 AND 999 THEN 'few_replicates' END, CASE WHEN k % 12 < 5 OR k % 12 = 11 THEN 'unsupported_level' END]) AS rule FROM (SELECT p_partkey k FROM part)) WHERE rule IS NOT NULL GROUP BY 1""")
def v13_option_rules(spark: SparkSession, sf: str) -> DataFrame:
    k = c("p_partkey")
    method = F.element_at(F.array(*map(F.lit, (*G.RECOMBINATION, "other"))), (k % 4 + 1).cast("int"))
    options = spark.read.parquet(f"{sf}/part.parquet").select(k, method.alias("method"), (k % 300).alias("window"), (k % 50).alias("step"), (k % 12 / 10).alias("threshold"), (k % 2000).alias("replicates"), (k % 12).alias("level"))
    return X.violations(options, "p_partkey", G.option_rules()).groupBy("rule").agg(F.count("*").alias("n"))
