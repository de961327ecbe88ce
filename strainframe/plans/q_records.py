"""Queries from frozen records to a dataset, and over distance evidence in files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import records as R
from .q_sources import place
from .registry import query
from .views import view

c = F.col
HASH = "repeat('c', 40)"


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """(id, body): a record of every sample, with missing, blocked and contradictory parts, as a struct whose nulls are absent fields."""
    k = c("sample_id")
    has = k % 8 != 7
    odd = lambda x: F.when(k % 16 == 9, F.array(F.lit(x))).otherwise(F.array().cast("array<string>"))
    profile = F.map_from_arrays(F.concat(F.array(F.lit("l1"), F.lit("l2")), odd("zz")), F.concat(F.array((k % 9).cast("string"), F.lit("5")), odd("1")))
    novel = F.when(has & (k % 12 == 0), F.create_map(F.lit("l2"), F.expr(HASH))).when(has & (k % 12 == 6), F.create_map(F.lit("l3"), F.expr(HASH)))
    date = F.element_at(F.array(*map(F.lit, ("2001", "2001-02", "2001-02-03", "", "2001-13"))), (k % 5 + 1).cast("int"))
    body = F.struct(
        F.concat(F.lit("s"), k.cast("string")).alias("sample_id"), F.when(c("role") == "input", "local").otherwise("context").alias("origin"), c("species"), F.when(k % 3 == 0, c("country")).alias("country"), date.alias("collection_date"),
        F.when(k % 4 == 0, F.concat(F.lit("SRR"), k.cast("string"))).alias("run_accession"), (k % 6 == 1).alias("identity_resolved"), (k % 10 == 3).alias("identity_conflict"), F.concat(F.lit("p"), (k % 50).cast("string")).alias("patient_id"),
        c("scheme").alias("cgmlst_scheme"), c("version").alias("cgmlst_scheme_version"), c("database_sha256").alias("cgmlst_database_sha256"), F.when(k % 11 == 4, "failed").alias("cgmlst_status"),
        F.when(has, profile).alias("cgmlst_profile"), novel.alias("cgmlst_novel_alleles"), F.when(k % 14 == 3, F.array(F.lit("l1"))).alias("cgmlst_ambiguous_loci"),
        F.when(k % 2 == 0, c("lineage")).alias("cglin_raw"), F.when(k % 5 == 0, F.create_map(F.lit("HC10"), (k % 7).cast("string"))).alias("hiercc_codes"),
    )
    return view(spark, sf, "samples").select(k.alias("id"), body.alias("body"))


def records(spark: SparkSession, sf: str) -> DataFrame:
    """The records, parsed from their own JSON."""
    return raw(spark, sf).select(R.as_type(F.parse_json(F.to_json("body")), R.RECORD).alias("record"))


def catalogues(spark: SparkSession) -> DataFrame:
    loci = "array('l1', 'l2', 'l3') loci"
    return spark.sql(f"SELECT 'scheme' scheme_id, '1' scheme_version, cast(NULL AS string) database_version, cast(NULL AS string) database_sha256, {loci} UNION ALL SELECT 'scheme', '1', 'x', repeat('A', 64), {loci} UNION ALL SELECT 'scheme', '2', NULL, NULL, {loci}")


@query("""SELECT 's' || s_suppkey sample_id, 1 + 1 + (s_suppkey % 3 = 0)::INT AS present, s_suppkey % 3 = 0 AS has_country, CASE WHEN s_suppkey % 6 <> 0 AND s_suppkey % 3 = 0 THEN s_suppkey::VARCHAR END country, s_suppkey * 2 AS extra FROM supplier""")
def s03_restored_samples(spark: SparkSession, sf: str) -> DataFrame:
    """A flat table written and restored: a null field stays apart from an absent one."""
    at, k = place(spark, "table"), c("s_suppkey")
    name = F.concat(F.lit('{"sample_id": "s'), k.cast("string"), F.lit('", "host": null'))
    country = F.when(k % 3 == 0, F.concat(F.lit(', "country": '), F.when(k % 6 == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), k.cast("string"), F.lit('"'))))).otherwise("")
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select(R.as_type(F.parse_json(F.concat(name, country, F.lit(', "extra": '), (k * 2).cast("string"), F.lit("}"))), R.RECORD).alias("record"))
    R.stored(rows).write.parquet(at)
    back = R.restored(spark.read.parquet(at))[0]
    present = F.size(F.array_intersect(F.map_keys("record"), F.array(*map(F.lit, R.SAMPLE_COLUMNS))))
    return back.select(R.field("sample_id").alias("sample_id"), present.alias("present"), F.map_contains_key("record", "country").alias("has_country"), R.field("country").alias("country"), R.field("extra", "bigint").alias("extra"))


@query("""WITH k AS (SELECT s_suppkey % 5 AS kind, s_suppkey // 500 AS part, s_suppkey % 3 = 0 bad FROM supplier)
 SELECT kind, CASE WHEN kind = 3 AND bad THEN 'no_sample_id' END problem, count(*) n FROM k WHERE kind IN (0, 1, 3) GROUP BY 1, 2 UNION ALL SELECT kind, CASE kind WHEN 2 THEN 'unknown_section' ELSE 'not_json' END, count(DISTINCT part) FROM k WHERE kind IN (2, 4) GROUP BY 1, 2""")
def s04_frozen_records(spark: SparkSession, sf: str) -> DataFrame:
    """Files of lists, of objects, with an unknown section, with records without a name, and no JSON."""
    at, k = place(spark, "frozen"), c("id")
    kind = k % 5
    body = F.when((kind == 3) & (k % 3 == 0), F.to_json(F.struct(F.lit(1).alias("sample_id")))).otherwise(F.to_json("body"))
    files = raw(spark, sf).select(kind.alias("kind"), F.floor(k / 500).alias("part"), body.alias("one")).groupBy("kind", "part").agg(F.concat(F.lit("["), F.array_join(F.collect_list("one"), ","), F.lit("]")).alias("all"))
    value = F.when(c("kind") == 1, F.concat(F.lit('{"records": '), c("all"), F.lit(', "conflicts": []}'))).when(c("kind") == 2, F.concat(F.lit('{"records": '), c("all"), F.lit(', "queries": []}'))).when(c("kind") == 4, F.concat(F.lit("{"), c("all"))).otherwise(c("all"))
    files.select("kind", "part", value.alias("value")).repartition("kind", "part").write.partitionBy("kind", "part").text(at)
    good, bad = R.frozen_records(spark, at)
    every = good.select("file", F.lit(None).cast("string").alias("problem")).unionByName(bad.select("file", "problem"))
    return every.groupBy(F.regexp_extract("file", "kind=([0-9]+)", 1).cast("bigint").alias("kind"), "problem").agg(F.count("*").alias("n"))


JUDGED = """k AS (SELECT sample_id s, sample_id % 8 <> 7 has, scheme = 'scheme' AND ((version = '1' AND database_sha256 IN ('', repeat('a', 64))) OR (version = '2' AND database_sha256 = '')) fits FROM @samples),
 j AS (SELECT s, has, fits, CASE WHEN NOT fits AND has THEN 'no_catalogue' WHEN NOT fits THEN NULL WHEN has AND s % 12 = 0 THEN 'called_and_novel' WHEN has AND s % 14 = 3 THEN 'ambiguous_and_called' WHEN has AND s % 16 = 9 AND s % 11 <> 4 THEN 'unknown_locus' END problem FROM k)"""


@query(f"WITH {JUDGED} SELECT coalesce(problem, 'member') AS outcome, count(*) n FROM j WHERE fits OR problem IS NOT NULL GROUP BY 1")
def s05_dataset_members(spark: SparkSession, sf: str) -> DataFrame:
    members, _, problems = R.profiles(records(spark, sf), catalogues(spark))
    return members.select(F.lit("member").alias("outcome")).unionByName(problems.select(c("problem").alias("outcome"))).groupBy("outcome").agg(F.count("*").alias("n"))


@query(f"""WITH {JUDGED}, g AS (SELECT s FROM j WHERE fits AND problem IS NULL AND has AND s % 11 <> 4) SELECT 's' || s sample_id, 'l1' locus, (s % 9)::VARCHAR allele FROM g WHERE s % 9 <> 0 UNION ALL SELECT 's' || s, 'l2', '5' FROM g UNION ALL SELECT 's' || s, 'l3', repeat('c', 40) FROM g WHERE s % 12 = 6""")
def s05_dataset_calls(spark: SparkSession, sf: str) -> DataFrame:
    return R.profiles(records(spark, sf), catalogues(spark))[1]


@query("""SELECT 's' || sample_id sample_id, CASE WHEN role <> 'input' AND sample_id % 4 = 0 THEN 'SRR' || sample_id ELSE 's' || sample_id END AS label, role, CASE WHEN sample_id % 3 = 0 THEN country END country,
 CASE sample_id % 5 WHEN 0 THEN '2001-01-01' WHEN 1 THEN '2001-02-01' WHEN 2 THEN '2001-02-03' END date_start, CASE sample_id % 5 WHEN 0 THEN '2001-12-31' WHEN 1 THEN '2001-02-28' WHEN 2 THEN '2001-02-03' END date_end,
 ['year', 'month', 'day', 'missing', 'invalid'][sample_id % 5 + 1] date_precision, ['2001', '2001-02', '2001-02-03', '', '2001-13'][sample_id % 5 + 1] date_raw, 'p' || (sample_id % 50) patient FROM @samples""")
def s06_canonical_samples(spark: SparkSession, sf: str) -> DataFrame:
    patient = F.get_json_object("extras", "$.patient_id")
    return R.samples(records(spark, sf)).select("sample_id", "label", "role", "country", "date_start", "date_end", "date_precision", "date_raw", patient.alias("patient"))


@query("""SELECT 'cglin' AS "table", 'unverified' status, count(*) n, count(*) filled FROM @samples WHERE sample_id % 2 = 0 UNION ALL SELECT 'hiercc', 'unverified', count(*), count(*) FROM @samples WHERE sample_id % 5 = 0
 UNION ALL SELECT 'crosswalk', CASE WHEN sample_id % 10 = 3 THEN 'ambiguous' WHEN sample_id % 6 = 1 THEN 'resolved' ELSE 'unresolved' END, count(*), count(*) FILTER (sample_id % 4 = 0) FROM @samples GROUP BY 1, 2
 UNION ALL SELECT 'retrieval', CASE WHEN sample_id % 11 = 4 THEN 'failed' ELSE 'unavailable' END, count(*), count(*) FILTER (sample_id % 14 = 3) FROM @samples GROUP BY 1, 2""")
def s07_derived_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Lineages, crosswalk and retrieval by status, with how many carry an assignment, a run, or ambiguous loci."""
    r = records(spark, sf)

    def counted(df: DataFrame, table: Column, status: str, value: Column) -> DataFrame:
        return df.groupBy(table.alias("table"), c(status).alias("status")).agg(F.count("*").alias("n"), F.count(value).alias("filled"))

    found = counted(R.lineages(r), c("kind"), "resolution_status", c("assignment"))
    found = found.unionByName(counted(R.crosswalk(r), F.lit("crosswalk"), "resolution_status", F.get_json_object("identity", "$.run_accession")))
    return found.unionByName(counted(R.retrieval(r), F.lit("retrieval"), "status", F.get_json_object("evidence", "$.cgmlst_ambiguous_loci")))


@query("""SELECT problem, n FROM (SELECT CASE s_suppkey % 9 WHEN 1 THEN 'self_pair' WHEN 2 THEN 'invalid_count' WHEN 3 THEN 'other_catalogue' WHEN 4 THEN 'count_out_of_range' WHEN 5 THEN 'overlap_disagrees' WHEN 6 THEN 'distance_disagrees' WHEN 7 THEN 'repeated_pair' END problem, sum(CASE WHEN s_suppkey % 9 = 7 THEN 2 ELSE 1 END)::BIGINT n FROM supplier GROUP BY 1) WHERE problem IS NOT NULL""")
def s23_v05_distance_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence in files of up to 500 pairs, a pair for each supplier, most of them wrong in some way; one pair in nine lacks its distance."""
    at, k = place(spark, "distances"), c("s_suppkey")
    m = k % 9
    pair = F.struct(
        F.concat(F.lit("a"), k.cast("string")).alias("sample_id_1"), F.when(m == 1, F.concat(F.lit("a"), k.cast("string"))).otherwise(F.concat(F.lit("b"), k.cast("string"))).alias("sample_id_2"),
        F.when(m == 2, 1.5).when(m == 4, 25.0).otherwise(5.0).alias("allele_differences"), F.lit(20).alias("shared_called_loci"), F.when(m == 3, 30).otherwise(25).alias("scheme_loci"),
        F.when(m == 5, 0.9).otherwise(0.8).alias("call_overlap"), F.when(m == 6, 0.5).when(m == 8, None).otherwise(0.25).alias("distance"),
    )
    turned = pair.withField("sample_id_1", pair["sample_id_2"]).withField("sample_id_2", pair["sample_id_1"])
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select(F.floor(k / 500).alias("part"), F.explode(F.when(m == 7, F.array(pair, turned)).otherwise(F.array(pair))).alias("p"))
    files = rows.groupBy("part").agg(F.to_json(F.struct(F.lit("cgmlst").alias("method"), F.lit("share of differing loci").alias("distance_definition"), F.collect_list("p").alias("records"))).alias("value"))
    files.repartition("part").write.partitionBy("part").text(at)
    pairs, broken = R.distance_evidence(spark, at, "cgmlst", "share of differing loci")
    return R.distance_problems(pairs, 25).select("problem").unionByName(broken.select("problem")).groupBy("problem").agg(F.count("*").alias("n"))
