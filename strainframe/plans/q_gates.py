"""Queries over checked sources and categorical matrices."""

from __future__ import annotations

import os
import sqlite3
import tempfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import matrix as M
from ..sources import files, gates
from ..sources.shared import checkpointed
from .q_sources import place
from .registry import query
from .views import sequences, view

c = F.col


@query("""SELECT s_suppkey % 5 AS kind, CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'invalid_characters' WHEN 2 THEN 'empty_contig' WHEN 3 THEN 'not_fasta' ELSE 'not_ascii' END problem, count(*) files, sum(CASE WHEN s_suppkey % 5 = 0 THEN 64 ELSE 0 END)::BIGINT bases
 FROM supplier GROUP BY 1, 2""")
def s29_fasta_gate(spark: SparkSession, sf: str) -> DataFrame:
    """One file for each sequence, four of five of them broken in some way."""
    at, k = place(spark, "assemblies"), c("sample_id") % 5
    lines = F.when(k == 0, F.concat(F.lit(">a\n"), F.translate("seq", "-", "N"), F.lit("\n"))).when(k == 1, F.concat(F.lit(">a\nACGT*"), c("seq"))).when(k == 2, F.concat(F.lit(">a\n>b\n"), c("seq"))).when(k == 3, c("seq")).otherwise(F.concat(F.lit(">a\n"), F.lit("é"), c("seq")))
    # A folder for each thousand, so that neither writing nor listing has a step for each file in the driver.
    path = F.concat(F.floor(c("sample_id") / 1000).cast("string"), F.lit("/"), c("sample_id").cast("string"), F.lit(".fasta"))
    rows = sequences(spark, sf).select(path.alias("path"), F.encode(F.concat(lines, F.lit("\n")), "UTF-8").alias("content"))
    checkpointed(files.put_all(rows.repartition(max(8, rows.count() // 1000), "path"), at))
    found = gates.assemblies(spark, f"{at}/*").withColumn("kind", F.regexp_extract("path", "([0-9]+)\\.fasta$", 1).cast("bigint") % 5)
    return found.groupBy("kind", "problem").agg(F.count("*").alias("files"), F.sum(F.when(c("problem").isNull(), c("bases")).otherwise(0)).alias("bases"))


@query("""SELECT CASE WHEN s_nationkey % 9 = 8 THEN 'unknown_locus' WHEN s_suppkey % 10 = 1 THEN 'invalid_digest' WHEN s_suppkey = 0 THEN 'invalid_number' WHEN s_suppkey % 6 = 0 THEN 'conflicting_sequences' END problem, count(*) alleles FROM supplier GROUP BY 1""")
def s22_allele_index(spark: SparkSession, sf: str) -> DataFrame:
    """An SQLite index written by one task for each locus, with wrong and reverse rows, read back."""
    at, k = place(spark, "index"), c("s_suppkey")
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select(F.concat(F.lit("l"), c("s_nationkey").cast("string")).alias("gene"), k.alias("st"), F.when(k % 10 == 1, "short").otherwise(F.sha1(k.cast("string"))).alias("hash"), F.lit(0).alias("reverse"))
    every = rows.unionByName(rows.where("st % 6 = 0").withColumn("hash", F.when(c("hash") == "short", c("hash")).otherwise(F.sha1(F.concat(c("st").cast("string"), F.lit("x")))))).unionByName(rows.withColumn("reverse", F.lit(1)))

    def write(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
        with tempfile.TemporaryDirectory() as folder:
            path = os.path.join(folder, "alleles.db")
            with sqlite3.connect(path) as index:
                table[["gene", "st", "hash", "reverse"]].to_sql("alleles", index, index=False)
            index.close()
            with open(path, "rb") as f:
                return pd.DataFrame({"gene": [key[0]], "content": [f.read()]})

    # The index's bytes travel as a row; Spark has no writer of binary files, so the rows stand for the files.
    indexes = every.groupBy("gene").applyInPandas(write, "gene string, content binary")
    indexes.write.parquet(at)
    loci = rows.where("cast(substring(gene, 2) as int) % 9 != 8").select(c("gene").alias("locus"))
    good, bad = gates.alleles_of(spark.read.parquet(at).withColumnRenamed("gene", "path"), loci)
    return good.select(F.lit(None).cast("string").alias("problem")).unionByName(bad.select("problem")).groupBy("problem").agg(F.count("*").alias("alleles"))


@query("""SELECT CASE event_id % 6 WHEN 0 THEN 'missing' WHEN 1 THEN 'secret_key' WHEN 2 THEN 'not_finite' WHEN 3 THEN 'not_json' END problem, count(*) n FROM events GROUP BY 1""")
def f34_evidence_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence with a credential deep inside, an infinite number, or no JSON at all."""
    k = c("event_id") % 6
    text = F.when(k == 1, F.concat(F.lit('{"a": [{"Client-Secret": '), F.col("event_id").cast("string"), F.lit("}]}"))).when(k == 2, F.lit('{"a": [1, {"b": -Infinity}]}')).when(k == 3, F.lit("{a: 1}")).when(k > 3, F.concat(F.lit('{"a": '), F.col("event_id").cast("string"), F.lit(', "tokens": 3}')))
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", text.alias("text"))
    return events.withColumn("problem", gates.evidence_problems(c("text"))).groupBy("problem").agg(F.count("*").alias("n"))


FIRST_SEEN = """f AS (SELECT allele, min((sample_id, locus)) p FROM @dense_calls WHERE allele IS NOT NULL GROUP BY 1), v AS (SELECT allele, row_number() OVER (ORDER BY p) code FROM f)"""


@query(f"WITH {FIRST_SEEN} SELECT allele, code FROM v")
def w11_first_seen_codes(spark: SparkSession, sf: str) -> DataFrame:
    return M.coded(view(spark, sf, "dense_calls").select("sample_id", "locus", "allele"), ["sample_id", "locus"])[0].select("allele", c("code").cast("bigint").alias("code"))


@query(f"""WITH {FIRST_SEEN}, k AS (SELECT sample_id, locus, coalesce(code, 0) + CASE WHEN sample_id % 11 = 0 THEN 100000 ELSE 0 END code FROM @dense_calls LEFT JOIN v USING (allele)), s AS (SELECT s_suppkey sample_id FROM supplier WHERE s_suppkey % 13 <> 0)
 SELECT problem, n FROM (SELECT 'code_out_of_range' problem, count(*) n FROM k WHERE code > (SELECT count(*) FROM v) UNION ALL SELECT 'unknown_sample', count(*) FROM k WHERE sample_id NOT IN (SELECT sample_id FROM s)
 UNION ALL SELECT 'repeated_category', 1) WHERE n > 0""")
def v03_matrix_rules(spark: SparkSession, sf: str) -> DataFrame:
    """A coded matrix with codes beyond its vocabulary, cells of samples it does not list, and one category twice."""
    calls = view(spark, sf, "dense_calls").select("sample_id", "locus", "allele")
    vocabulary, codes = M.coded(calls, ["sample_id", "locus"])
    spoiled = codes.withColumn("code", c("code") + F.when(c("sample_id") % 11 == 0, 100_000).otherwise(0))
    samples = spark.read.parquet(f"{sf}/supplier.parquet").where("s_suppkey % 13 != 0").select(c("s_suppkey").alias("sample_id"))
    first = vocabulary.where("code = 1")
    twice = vocabulary.unionByName(first)
    found = M.matrix_problems(samples, calls.select("locus").distinct(), twice, spoiled)
    return found.select("problem", "n")


@query("SELECT species, lineage, count(*) samples, min(sample_id) AS first FROM @samples GROUP BY 1, 2")
def b09_lineage_groups(spark: SparkSession, sf: str) -> DataFrame:
    return M.lineage_groups(view(spark, sf, "samples"))
