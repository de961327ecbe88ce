"""Queries that go through files: sources, sinks, validators and captured streams."""

from __future__ import annotations

import gzip
import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import scalars as S
from ..operators import compare as R
from ..operators import validate as X
from ..sources import bundle, cohorts, files, newick, readers, stages, tools
from ..sources.shared import checkpoint_folder, checkpointed
from ..streaming import capture
from .q_aggregates import rounded
from .registry import query
from .views import sequences, view

c = F.col


def place(spark: SparkSession, label: str) -> str:
    """A new folder that all executors see."""
    return f"{checkpoint_folder(spark)}/{label}-{uuid.uuid4().hex}"


@query("SELECT sample_id, role, st FROM @samples")
def s01_k01_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """Tables written as a bundle and read back with their digests checked."""
    at = place(spark, "bundle")
    bundle.write_bundle({"samples": view(spark, sf, "samples"), "calls": view(spark, sf, "calls")}, at)
    return bundle.read_bundle(spark, at)["samples"].select("sample_id", "role", "st")


@query("""SELECT problem, count(*) * CASE WHEN problem = 'repeated' THEN 2 ELSE 1 END n FROM (SELECT unnest(CASE s_suppkey % 10 WHEN 1 THEN ['digest_differs'] WHEN 2 THEN ['size_differs'] WHEN 3 THEN ['repeated'] WHEN 4 THEN ['escapes', 'unlisted'] WHEN 5 THEN ['not_relative', 'unlisted'] WHEN 6 THEN ['missing'] WHEN 7 THEN ['unlisted'] WHEN 8 THEN ['no_digest'] ELSE [NULL] END) problem FROM supplier) GROUP BY problem""")
def s02_artifact_check(spark: SparkSession, sf: str) -> DataFrame:
    """A file for each supplier; most are changed after the manifest was made, or their entries are."""
    at, k = place(spark, "artifacts"), c("s_suppkey")
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select(k, (k % 10).alias("kind"), F.concat(F.lit("d"), (k % 7).cast("string"), F.lit("/"), k.cast("string"), F.lit(".txt")).alias("path"), F.encode(F.concat("s_name", F.lit("-"), k.cast("string")), "UTF-8").alias("content"))
    manifest = checkpointed(files.put_all(rows.where("kind != 6"), at)).join(rows.select("path", "kind"), "path", "right")
    absent = F.sha2("path", 256)
    manifest = manifest.withColumn("sha256", F.when(c("kind") == 6, absent).when(c("kind") == 8, "none").otherwise(c("sha256"))).withColumn("bytes", F.coalesce("bytes", F.lit(3)))
    changed = F.when(c("kind") == 4, F.concat(F.lit("../"), c("path"))).when(c("kind") == 5, F.concat(F.lit("/"), c("path"))).otherwise(c("path"))
    entries = manifest.where("kind != 7").withColumn("path", changed).withColumn("copy", F.explode(F.when(c("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    flipped = F.when(c("kind") == 1, F.encode(F.concat(F.reverse(F.decode("content", "UTF-8"))), "UTF-8")).otherwise(F.encode(F.lit("x"), "UTF-8"))
    checkpointed(files.put_all(rows.where("kind in (1, 2)").withColumn("content", flipped), at))
    return files.checked(spark, at, entries.select("path", "bytes", "sha256")).groupBy("problem").agg(F.count("*").alias("n"))


@query("""SELECT 'good' AS stage, 'complete' status, count(*) AS "rows", 0 AS damaged FROM @samples UNION ALL SELECT 'broken', 'failed', NULL, 0 UNION ALL SELECT 'unsound', 'failed', NULL, 0 UNION ALL SELECT 'resumed', 'complete', count(*), 0 FROM @samples UNION ALL SELECT 'damaged', 'complete', count(*), 1 FROM @samples""")
def k10_stage_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Stages that succeed, fail, do not pass their check, were killed before they were published, and are damaged afterwards."""
    at = place(spark, "stages")
    samples = view(spark, sf, "samples").select("sample_id", "role")

    def broken() -> dict[str, DataFrame]:
        return {"samples": samples.withColumn("x", F.raise_error(F.lit("no such tool")))}

    records = {"good": stages.publish(at, "good", lambda: {"samples": samples}), "broken": stages.publish(at, "broken", broken)}
    records["unsound"] = stages.publish(at, "unsound", lambda: {"samples": samples}, lambda t: t["samples"].agg(F.count("*").alias("n")).select(F.lit("too_many").alias("problem"), "n"))
    stages.staged(at, "resumed", {"samples": samples})  # what a run leaves that is killed before it publishes
    records["resumed"] = stages.publish(at, "resumed", lambda: {"samples": samples})
    again = stages.publish(at, "good", broken)
    records["damaged"] = stages.publish(at, "damaged", lambda: {"samples": samples})
    files.put(f"{at}/damaged-{records['damaged']['attempt']}", "extra.txt", b"x")
    out = None
    for name, record in records.items():
        whole = record["status"] == "complete" and (name != "good" or again == record)
        damaged = stages.damage(spark, at, record).count() if whole else 0
        rows = stages.stage_tables(spark, at, name)["samples"].agg(F.count("*").alias("rows")) if whole else spark.range(1).select(F.lit(None).cast("bigint").alias("rows"))
        one = rows.select(F.lit(name).alias("stage"), F.lit(record["status"]).alias("status"), "rows", F.lit(damaged).alias("damaged"))
        out = one if out is None else out.unionByName(one)
    return out


@query("""SELECT problem, n FROM (SELECT CASE s_suppkey % 8 WHEN 1 THEN 'sample_without_tip' WHEN 3 THEN 'metadata_differs' WHEN 5 THEN 'callable_sites_differ' WHEN 6 THEN 'metadata_missing' END problem, count(*) n FROM supplier GROUP BY 1 UNION ALL SELECT 'repeated_tip', count(*) FROM supplier WHERE s_suppkey % 8 = 2 UNION ALL SELECT 'tip_without_sample', count(*) FROM supplier WHERE s_suppkey % 8 = 4) WHERE problem IS NOT NULL AND n > 0""")
def v07_tree_result(spark: SparkSession, sf: str) -> DataFrame:
    """A tree stage whose tips, metadata and callable sites are wrong for most samples."""
    k = c("sample_id") % 8
    samples = view(spark, sf, "samples").select("sample_id", "country", F.col("st"))
    alignment = sequences(spark, sf)
    tips = samples.where(k != 1).select(F.explode(F.when(k == 2, F.array(F.lit("a"), F.lit("b"))).when(k == 4, F.array(F.lit("a"), F.lit("x"))).otherwise(F.array(F.lit("a")))).alias("v"), "sample_id")
    tips = tips.select(F.concat(c("v"), c("sample_id").cast("string")).alias("node"), F.lit("root").alias("parent"), F.when(c("v") == "x", -1 - c("sample_id")).otherwise(c("sample_id")).alias("sample_id"))
    root = spark.range(1).select(F.lit("root").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(None).cast("bigint").alias("sample_id"))
    sites = alignment.select("sample_id", F.length(F.regexp_replace("seq", "N", "")).alias("callable"))
    claimed = samples.where(k != 6).withColumn("country", F.when(k == 3, F.concat("country", F.lit("?"))).otherwise(c("country"))).join(sites, "sample_id").withColumn("callable", c("callable") + F.when(k == 5, 1).otherwise(0))
    return stages.tree_result_problems(root.unionByName(tips), samples, alignment, claimed)


@query("""SELECT sample_id::VARCHAR sample_id, locus, CASE WHEN sample_id % 9 = 0 AND allele::INT % 2 = 0 THEN NULL WHEN allele::INT % 6 = 0 THEN NULL ELSE allele END allele, CASE WHEN sample_id % 9 = 0 AND allele::INT % 2 = 0 THEN CASE WHEN allele::INT % 6 = 0 THEN 'called' ELSE 'ambiguous' END WHEN allele::INT % 6 = 0 THEN 'missing' ELSE 'called' END status FROM @calls""".replace("CASE WHEN sample_id % 9 = 0 AND allele::INT % 2 = 0 THEN NULL WHEN allele::INT % 6 = 0 THEN NULL ELSE allele END", "CASE WHEN sample_id % 9 = 0 AND allele::INT % 2 = 0 THEN CASE WHEN allele::INT % 6 = 0 THEN '77' END WHEN allele::INT % 6 = 0 THEN NULL ELSE allele END"))
def s12_long_allele_export(spark: SparkSession, sf: str) -> DataFrame:
    """Calls written as CSV with missing tokens and contradictory repeats, read back."""
    at = place(spark, "export")
    calls = view(spark, sf, "calls")
    token = F.when(c("allele").cast("int") % 6 == 0, " ? ").otherwise(c("allele"))
    rows = calls.select(c("sample_id").cast("string").alias("Genome ID"), c("locus").alias("Gene"), token.alias("Allele ID"))
    again = calls.where("sample_id % 9 = 0 and cast(allele as int) % 2 = 0").select(c("sample_id").cast("string").alias("Genome ID"), c("locus").alias("Gene"), F.lit("77").alias("Allele ID"))
    rows.unionByName(again).write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(at)
    return readers.allele_export(readers.header_csv(spark, at), "Genome ID", "Gene", "Allele ID")


@query("SELECT s_suppkey::VARCHAR sample_id, level, cluster::VARCHAR \"cluster\" FROM (SELECT s_suppkey, 'HC0' AS level, s_suppkey % 5 AS cluster FROM supplier UNION ALL SELECT s_suppkey, 'HC10', s_suppkey % 3 FROM supplier WHERE s_suppkey % 4 <> 0)")
def s13_wide_hierarchy_export(spark: SparkSession, sf: str) -> DataFrame:
    at = place(spark, "wide")
    k = c("s_suppkey")
    spark.read.parquet(f"{sf}/supplier.parquet").select(k.cast("string").alias("Genome ID"), (k % 5).alias("HC0"), F.when(k % 4 != 0, k % 3).alias("HC10"), c("s_name").alias("HCname")).write.option("header", True).option("compression", "gzip").csv(at)
    wide = readers.header_csv(spark, at)
    return readers.hierarchy_export(wide, "Genome ID", wide.select(c("Genome ID").alias("sample_id")))[0]


@query("""SELECT s_suppkey::VARCHAR sourcegenomeid, s_suppkey % 7 || '_' || s_nationkey lincode FROM supplier""")
def s14_fuzzy_headers(spark: SparkSession, sf: str) -> DataFrame:
    at = place(spark, "lin")
    spark.read.parquet(f"{sf}/supplier.parquet").select(c("s_suppkey").cast("string").alias("Source genome_ID"), F.concat((c("s_suppkey") % 7).cast("string"), F.lit("_"), c("s_nationkey").cast("string")).alias("LIN code")).write.option("header", True).option("sep", "\t").csv(at)
    return readers.folded_names(readers.header_csv(spark, at, "\t"))


@query("""WITH k AS (SELECT sample_id, unnest(['g1', 'g2', 'g3']) locus, unnest([(sample_id % 9)::VARCHAR, CASE WHEN sample_id % 5 = 0 THEN '3|4' ELSE '3' END, CASE WHEN sample_id % 4 = 0 THEN '?' ELSE '8' END]) hit FROM @samples) SELECT sample_id, locus, CASE WHEN hit NOT IN ('0', '?') AND NOT contains(hit, '|') THEN hit END allele, CASE WHEN hit IN ('0', '?') THEN 'missing' WHEN contains(hit, '|') THEN 'ambiguous' ELSE 'called' END status FROM k""")
def s26_typing_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    k = c("sample_id")
    code = F.concat_ws("_", (k % 9).cast("string"), F.when(k % 5 == 0, "3|4").otherwise("3"), F.when(k % 4 == 0, "?").otherwise("8"))
    return readers.typing_results(view(spark, sf, "samples").select("sample_id", F.array(F.lit("g1"), F.lit("g2"), F.lit("g3")).alias("genes"), code.alias("code")))


@query("""SELECT sample_id, CASE WHEN sample_id % 3 = 0 THEN '1_2_3' WHEN sample_id % 3 = 1 THEN '1' ELSE '' END prefix, 2::BIGINT AS matches FROM @samples""")
def s27_best_match_prefix(spark: SparkSession, sf: str) -> DataFrame:
    k = c("sample_id")
    array = lambda *x: F.array(*map(F.lit, x))
    second = F.when(k % 3 == 0, array("1", "2", "3")).when(k % 3 == 1, array("1", "9", "3")).otherwise(array("4", "2", "3"))
    return readers.best_match_prefix(view(spark, sf, "samples").select("sample_id", F.array(array("1", "2", "3"), second).alias("codes")))


@query("SELECT 'brands' scheme_id, '1' scheme_version, true complete, count(DISTINCT p_brand) loci FROM part")
def s08_locus_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    at = place(spark, "catalogue")
    spark.read.parquet(f"{sf}/part.parquet").agg(F.sort_array(F.collect_set("p_brand")).alias("loci")).select(F.lit("brands").alias("scheme_id"), F.lit("1").alias("scheme_version"), F.lit(True).alias("complete"), "loci").write.json(at)
    return readers.locus_catalogue(spark, at).groupBy("scheme_id", "scheme_version", "complete").agg(F.count("*").alias("loci"))


@query("SELECT concat('c', s_suppkey % 5) AS name, count(*) records, sum(64)::BIGINT total FROM supplier GROUP BY 1")
def s19_s20_fasta(spark: SparkSession, sf: str) -> DataFrame:
    """Sequences written as FASTA text and read back."""
    at = place(spark, "fasta")
    s = sequences(spark, sf)
    s.select(F.concat(F.lit(">c"), (c("sample_id") % 5).cast("string"), F.lit(" note\n"), F.substring("seq", 1, 40), F.lit("\n"), F.substring("seq", 41, 24)).alias("value")).write.text(at)
    return readers.fasta(spark, at).groupBy("name").agg(F.count("*").alias("records"), F.sum(F.length("sequence")).alias("total"))


@query("SELECT \"rule\", n FROM (SELECT 'not_dna' AS \"rule\", count(*) n FROM supplier WHERE s_suppkey % 6 = 0 AND s_suppkey % 10 <> 0 UNION ALL SELECT 'repeated_key', count(*) FROM supplier WHERE s_suppkey % 10 = 0)")
def s21_dna_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    k = c("s_suppkey")
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select(k.cast("string").alias("allele"), F.lit("l").alias("locus"), F.when(k % 6 == 0, "ACGN").otherwise("acgt").alias("dna"))
    errors = readers.dna_catalogue(rows.unionByName(rows.where("cast(allele as bigint) % 10 = 0")))[1]
    return errors.groupBy(c("error").alias("rule")).agg(F.count("*").alias("n"))


@query("SELECT node, parent, round(length, 9) AS length FROM @tree")
def s24_k09_newick(spark: SparkSession, sf: str) -> DataFrame:
    """The fixed tree written as Newick and read back."""
    t = view(spark, sf, "tree").withColumn("tree", F.lit("fixed"))
    return newick.read_trees(newick.write_trees(t)).select("node", "parent", "length")


@query("SELECT record, start_at, end_at, p FROM @windows")
def s25_tool_table(spark: SparkSession, sf: str) -> DataFrame:
    at = place(spark, "tool")
    view(spark, sf, "windows").select("record", "start_at", "end_at", "p").write.option("header", True).option("sep", "\t").csv(at)
    return readers.region_table(spark, at, "record bigint, start_at bigint, end_at bigint, p double")


@query("SELECT DISTINCT sample_accession accession FROM @identities")
def s11_accession_list(spark: SparkSession, sf: str) -> DataFrame:
    at = place(spark, "accessions")
    view(spark, sf, "identities").select(F.concat(F.lit("  "), c("sample_accession"), F.lit(" # seen")).alias("value")).union(spark.sql("select '# only a comment'")).write.text(at)
    return readers.accession_list(spark, at)


@query("""WITH r AS (SELECT CASE WHEN s_suppkey % 9 = 0 THEN 'bad id ' || s_suppkey ELSE 's' || (s_suppkey - s_suppkey % 20 // 19) END sample_id, CASE WHEN s_suppkey % 7 <> 0 THEN s_name END species FROM supplier), n AS (SELECT *, count(*) OVER (PARTITION BY sample_id) n FROM r) SELECT sample_id, CASE WHEN contains(sample_id, ' ') THEN 'unsafe_sample_id' WHEN n > 1 THEN 'repeated_sample_id' ELSE 'missing_species' END error FROM n WHERE contains(sample_id, ' ') OR n > 1 OR species IS NULL""")
def s10_study_metadata(spark: SparkSession, sf: str) -> DataFrame:
    at = place(spark, "metadata")
    k = c("s_suppkey")
    name = F.when(k % 9 == 0, F.concat(F.lit("bad id "), k.cast("string"))).otherwise(F.concat(F.lit("s"), (k - F.floor((k % 20) / 19)).cast("string")))
    spark.read.parquet(f"{sf}/supplier.parquet").select(name.alias("sample_id"), F.when(k % 7 != 0, c("s_name")).alias("species")).write.option("header", True).csv(at)
    return readers.study_metadata(spark, at, ["species"])[1]


@query("SELECT sample_id, locus, allele FROM @calls")
def k02_nested_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles as maps written as JSON cells of a CSV, and read back."""
    at = place(spark, "csv")
    bundle.nested_csv(view(spark, sf, "calls").groupBy("sample_id").agg(F.map_from_entries(F.collect_list(F.struct("locus", "allele"))).alias("profile")), at)
    back = spark.read.option("header", True).option("escape", '"').csv(at)
    return back.select(c("sample_id").cast("bigint").alias("sample_id"), F.explode(F.from_json("profile", "map<string,string>")).alias("locus", "allele"))


@query("""WITH x AS (SELECT sample_id, 'CC_' || substr(sha256(sample_id::VARCHAR), 1, 16) export_id, country FROM @samples)
 SELECT export_id, x.sample_id, x.country, coalesce('CC_' || substr(sha256(p.sample_id::VARCHAR), 1, 16), t.parent) parent, round(t.length, 9) AS length FROM x JOIN @tree t ON t.sample_id = x.sample_id LEFT JOIN @tree p ON p.node = t.parent""")
def k07_viewer_export(spark: SparkSession, sf: str) -> DataFrame:
    """A tree with its tips renamed to safe ids, the metadata and the map of ids, written and read back together."""
    samples, t = view(spark, sf, "samples"), view(spark, sf, "tree")
    ids = samples.select("sample_id", S.export_id(c("sample_id")).alias("export_id"))
    at = place(spark, "viewer")
    newick.write_trees(newick.renamed(t, ids).withColumn("tree", F.lit("fixed"))).select(c("newick").alias("value")).write.text(f"{at}/tree.nwk")
    samples.join(ids, "sample_id").select("export_id", "country").write.option("header", True).csv(f"{at}/metadata")
    ids.write.option("header", True).csv(f"{at}/ids")
    back = newick.read_trees(spark.read.text(f"{at}/tree.nwk").select(F.lit("fixed").alias("tree"), c("value").alias("newick")))
    named = lambda part: spark.read.option("header", True).csv(f"{at}/{part}")
    known = named("metadata").join(named("ids"), "export_id")
    return rounded(known.join(back.select(c("node").alias("export_id"), "parent", "length"), "export_id").select("export_id", c("sample_id").cast("bigint").alias("sample_id"), "country", "parent", "length"), "length")


SHUFFLED = """pt AS (SELECT sample_id, year(day) + (dayofyear(day) - 1) / CASE WHEN year(day) % 4 = 0 AND (year(day) % 100 <> 0 OR year(day) % 400 = 0) THEN 366.0::DOUBLE ELSE 365.0::DOUBLE END x, value y, day FROM @points),
 r AS (SELECT unnest(range(0, 6))::INT AS run), a AS (SELECT sample_id, run, x, row_number() OVER (PARTITION BY sample_id, run ORDER BY day) i FROM pt, r), b AS (SELECT sample_id, run, y, row_number() OVER (PARTITION BY sample_id, run ORDER BY CASE WHEN run = 0 THEN day::VARCHAR ELSE md5('3|' || run || '|' || day::VARCHAR) END) i FROM pt, r),
 f AS (SELECT sample_id, run, count(*) n, count(DISTINCT x) k, regr_slope(y, x) b, sqrt(greatest(0, regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x)) / regr_sxx(y, x) / nullif(count(*) - 2, 0)) se FROM a JOIN b USING (sample_id, run, i) GROUP BY 1, 2)"""


@query(f"""WITH {SHUFFLED} SELECT f.sample_id, f.run, round(f.b, 4) rate, f.b >= o.b exceeds, f.b - 1.96 * f.se <= o.b AND o.b <= f.b + 1.96 * f.se AS "overlaps" FROM f JOIN f o ON o.sample_id = f.sample_id AND o.run = 0 WHERE f.run > 0 AND f.n >= 3 AND f.k >= 3""")
def k12_randomisations(spark: SparkSession, sf: str) -> DataFrame:
    """Each sample's values dealt anew to its days five times: the slope of each deal, whether it reaches the observed one, and whether its interval holds it, through a CSV."""
    at = place(spark, "randomisations")
    p = view(spark, sf, "points").select("sample_id", "day", D.decimal_year(c("day")).alias("x"), c("value").alias("y"))
    R.randomised(p, ["sample_id"], "day", "x", "y", 5, 3).write.option("header", True).csv(at)
    back = spark.read.option("header", True).schema("sample_id bigint, run int, rate double, exceeds boolean, overlaps boolean").csv(at)
    return rounded(back.withColumn("rate", F.round("rate", 4)), "rate")


@query("""WITH r AS (SELECT o_orderkey id, CASE o_orderkey % 5 WHEN 0 THEN 'other' ELSE 'input' END AS role, o_orderdate::DATE s, CASE WHEN o_orderkey % 4 = 0 THEN (o_orderdate - INTERVAL 1 DAY)::DATE ELSE o_orderdate::DATE END e, CASE o_orderkey % 3 WHEN 0 THEN 'day' WHEN 1 THEN 'month' END p FROM orders)
 SELECT rule, count(*) n FROM (SELECT unnest([CASE WHEN role = 'other' THEN 'unknown_role' END, CASE WHEN s > e THEN 'reversed_dates' END, CASE WHEN p = 'day' AND s <> e THEN 'day_with_range' END, CASE WHEN p = 'month' AND (s <> date_trunc('month', s) OR e <> last_day(s)) THEN 'partial_month' END, CASE WHEN p IS NULL THEN 'date_without_precision' END]) AS rule FROM r) WHERE rule IS NOT NULL GROUP BY 1""")
def v01_sample_rules(spark: SparkSession, sf: str) -> DataFrame:
    k, day = c("o_orderkey"), c("o_orderdate").cast("date")
    rows = spark.read.parquet(f"{sf}/orders.parquet").select(k.alias("sample_id"), F.when(k % 5 == 0, "other").otherwise("input").alias("role"), day.alias("date_start"), F.when(k % 4 == 0, F.date_sub(day, 1)).otherwise(day).alias("date_end"), F.when(k % 3 == 0, "day").when(k % 3 == 1, "month").alias("date_precision"))
    return X.violations(rows, "sample_id", X.sample_rules()).groupBy("rule").agg(F.count("*").alias("n"))


@query("SELECT l_suppkey id, l_partkey, count(*) n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def v02_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    return X.repeated(spark.read.parquet(f"{sf}/lineitem.parquet").select(c("l_suppkey").alias("id"), "l_partkey"), "id", "l_partkey")


@query("SELECT DISTINCT o_custkey id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)")
def v02_dangling_references(spark: SparkSession, sf: str) -> DataFrame:
    return X.dangling(spark.read.parquet(f"{sf}/orders.parquet"), "o_custkey", spark.read.parquet(f"{sf}/customer.parquet").where("c_custkey % 3 = 0"), "c_custkey")


@query("""WITH b AS (SELECT s_suppkey % 4 AS "group", s_suppkey AS least, s_suppkey + 4 + CASE WHEN s_suppkey % 20 = 3 THEN 1 WHEN s_suppkey % 20 = 8 THEN -1 ELSE 0 END AS most FROM supplier), s AS (SELECT *, lag(most) OVER w l, lead(least) OVER w n FROM b WINDOW w AS (PARTITION BY "group" ORDER BY least, most)),
 v AS (SELECT "group", unnest([CASE WHEN least > l THEN 'gap' END, CASE WHEN least < l THEN 'overlap' END, CASE WHEN l IS NULL AND least <> 0 THEN 'wrong_begin' END, CASE WHEN n IS NULL AND most <> 100 THEN 'wrong_end' END]) AS "rule" FROM s) SELECT "group", "rule", count(*) n FROM v WHERE "rule" IS NOT NULL GROUP BY 1, 2""")
def v14_ordered_bins(spark: SparkSession, sf: str) -> DataFrame:
    k = c("s_suppkey")
    bins = spark.read.parquet(f"{sf}/supplier.parquet").select((k % 4).alias("group"), k.alias("least"), (k + 4 + F.when(k % 20 == 3, 1).when(k % 20 == 8, -1).otherwise(0)).alias("most"))
    return X.bins_violations(bins, 0, 100)


@query("""SELECT DISTINCT 'incomplete' AS what, 'm3' AS name, 1::BIGINT AS n FROM supplier WHERE s_suppkey % 5 = 3
 UNION ALL SELECT 'merged_samples', '', count(*) FROM supplier WHERE s_suppkey % 5 <> 3 UNION ALL SELECT 'merged_catalogues', '', count(DISTINCT s_suppkey % 5 % 2) FROM supplier WHERE s_suppkey % 5 <> 3
 UNION ALL SELECT 'samples', s_suppkey::VARCHAR, 2 FROM supplier WHERE s_suppkey % 5 <> 3 AND s_suppkey % 11 = 4 UNION ALL SELECT 'calls', s_suppkey::VARCHAR, 1 FROM supplier WHERE s_suppkey % 5 <> 3 AND s_suppkey % 13 = 6""")
def u06_merged_datasets(spark: SparkSession, sf: str) -> DataFrame:
    """Five members with two catalogues between them: one is incomplete and blocks; the others are merged, and rows changed afterwards name their sample."""
    k = c("s_suppkey")
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select(k.cast("string").alias("sample_id"), F.concat(F.lit("m"), (k % 5).cast("string")).alias("member"), "s_name", (k % 5 % 2).alias("kind"), k.alias("k"))
    status = rows.select("member").distinct().withColumn("status", F.when(c("member") == "m3", "running").otherwise("complete"))
    samples = rows.select("member", "sample_id", "s_name", F.concat(F.lit("/work/"), "sample_id").alias("assembly_reference"))
    scheme, version = F.lit("scheme").alias("scheme"), F.when(c("kind") == 0, "1").otherwise("2").alias("version")
    calls = rows.select("member", "sample_id", scheme, version, F.explode(F.array(F.lit("l1"), F.lit("l2"))).alias("locus"), (c("k") % 9).cast("string").alias("allele"))
    loci = rows.select("member", scheme, version, F.explode(F.array(F.lit("l1"), F.lit("l2"), F.lit("l3"))).alias("locus")).distinct()
    blocked = cohorts.merger_problems(samples.select("sample_id"), status, samples, calls, loci)
    out = blocked.select(c("problem").alias("what"), c("member").alias("name"), F.lit(1).cast("bigint").alias("n"))
    good = [df.join(status.where("status = 'complete'").select("member"), "member", "left_semi") for df in (samples, calls, loci)]
    cohort = {name: checkpointed(df) for name, df in cohorts.merged(*good).items()}
    count = lambda df, what: df.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), F.lit("").alias("name"), "n")
    out = out.unionByName(count(cohort["samples"], "merged_samples")).unionByName(count(cohort["catalogues"].select("catalogue").distinct(), "merged_catalogues"))
    number = c("sample_id").cast("bigint")
    cohort["samples"] = cohort["samples"].withColumn("s_name", F.when(number % 11 == 4, "changed").otherwise(c("s_name"))).withColumn("assembly_reference", F.concat(F.lit("copied/"), "sample_id"))
    cohort["calls"] = cohort["calls"].where(~((number % 13 == 6) & (c("locus") == "l2")))
    proof = cohorts.proof(cohort, *good, free=["assembly_reference"])
    return out.unionByName(proof.select(c("table").alias("what"), "name", (c("only_merged") + c("only_members")).alias("n")))


@query("""WITH k AS (SELECT s_suppkey, s_suppkey % 6 AS kind FROM supplier), f AS (SELECT kind, count(*) n FROM k GROUP BY 1)
 SELECT kind::BIGINT kind, NULL AS problem, 2 * n AS n FROM f WHERE kind < 3 UNION ALL SELECT kind::BIGINT, CASE kind WHEN 3 THEN 'not_one_member' WHEN 4 THEN 'unreadable' END, 1 FROM f WHERE kind IN (3, 4) UNION ALL SELECT kind::BIGINT, 'unsupported_allele', n FROM f WHERE kind = 5 UNION ALL SELECT kind::BIGINT, NULL, n FROM f WHERE kind = 5""")
def s12_compressed_exports(spark: SparkSession, sf: str) -> DataFrame:
    """Exports in six files: plain, gzip, zip, a zip of two members, a broken gzip, and one with a wrong allele for each genome."""
    at = place(spark, "exports")
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", (c("s_suppkey") % 6).alias("kind"))

    def write(part: pd.DataFrame) -> pd.DataFrame:
        kind = int(part["kind"].iloc[0])
        text = "Genome ID,Gene,Allele ID\n" + "".join(f"g{k},l1,{'?' if k % 2 else '007'}\ng{k},l2,{'none at all' if kind == 5 else k + 1}\n" for k in part["s_suppkey"])
        raw, packed = text.encode(), io.BytesIO()
        if kind in (2, 3):
            with zipfile.ZipFile(packed, "w") as archive:
                for i in range(kind - 1):
                    archive.writestr(f"{i}.csv", raw)
            raw = packed.getvalue()
        raw = gzip.compress(raw) if kind in (1, 4) else raw
        return pd.DataFrame({"path": [f"export-{kind}.bin"], "content": [raw[:-6] if kind == 4 else raw]})

    checkpointed(files.put_all(rows.groupBy("kind").applyInPandas(write, "path string, content binary"), at))
    asked = rows.select(F.concat(F.lit("g"), c("s_suppkey").cast("string")).alias("genome"))
    good, bad = tools.long_export(spark, at, requested=asked)
    every = good.select("file", F.lit(None).cast("string").alias("problem")).unionByName(bad.select("file", "problem"))
    return every.groupBy(F.regexp_extract("file", "export-([0-9])", 1).cast("bigint").alias("kind"), "problem").agg(F.count("*").alias("n"))


@query("""SELECT start_at AS "start", end_at AS "end", CASE WHEN id % 8 = 0 OR id % 11 IN (1, 2, 3, 4, 5) THEN NULL ELSE round(p, 9) END AS p, CASE id % 11 WHEN 1 THEN 'not_covered' WHEN 2 THEN 'coordinates_disagree' WHEN 3 THEN 'no_status' WHEN 4 THEN CASE WHEN id % 8 <> 0 THEN 'probabilities_disagree' END WHEN 5 THEN CASE WHEN id % 8 <> 0 THEN 'invalid_probability' END END AS problem FROM @windows""")
def s25_window_profile(spark: SparkSession, sf: str) -> DataFrame:
    """A profile of windows as table and log; most kinds of disagreement between them."""
    table, log, k = place(spark, "profile"), place(spark, "log"), c("id")
    w = view(spark, sf, "windows").withColumn("centre", c("start_at") + 60).withColumn("kind", k % 11)
    value = F.when(c("kind") == 5, "2.5").when(c("p").isNull(), "1e-310").otherwise(c("p").cast("string"))
    w.where("kind != 1").select(F.concat_ws(", ", c("centre").cast("string"), value).alias("value")).write.text(table)
    said = F.when(c("p").isNull(), "--").when(c("kind") == 4, F.format_number(c("p") / 2 + 0.5 + F.when(c("p") > 0.9, -0.4).otherwise(0), 6)).otherwise(F.format_string("%.4e", c("p")))
    line = F.concat(F.lit(tools.WINDOW_MARK), c("centre").cast("string"), F.lit(" between "), (c("start_at") - F.when(c("kind") == 2, 1).otherwise(0)).cast("string"), F.lit(" and "), c("end_at").cast("string"), F.lit("\nsites: 12\n"), F.when(c("kind") == 3, "").otherwise(F.concat(F.lit("PHI (Normal):   "), said, F.lit("\n"))))
    w.select(line.alias("value")).write.text(log)
    found = tools.window_profile(spark, table, log, w.select(c("start_at").alias("start"), c("end_at").alias("end")))
    return rounded(found, "p")


@query("""SELECT 'state' AS what, 'n' || s_suppkey node, state, round(CASE state WHEN 'North' THEN (s_suppkey % 10) / 10.0 ELSE 1 - (s_suppkey % 10) / 10.0 END, 6) probability FROM supplier, (SELECT 'North' state UNION ALL SELECT 'Far South') WHERE s_suppkey % 7 <> 3 AND s_suppkey % 7 <> 5
 UNION ALL SELECT 'invalid_probability', 'n' || s_suppkey, NULL, NULL FROM supplier WHERE s_suppkey % 7 = 3 UNION ALL SELECT 'repeated_node', 'n' || s_suppkey, NULL, NULL FROM supplier WHERE s_suppkey % 7 = 5 UNION ALL SELECT 'unmapped_code', 'C', NULL, NULL""")
def s25_ancestral_states(spark: SparkSession, sf: str) -> DataFrame:
    """Confidences by coded character with the text that maps the codes; nodes with wrong rows and a code without a state."""
    table, mapping, k = place(spark, "confidence"), place(spark, "map"), c("s_suppkey")
    share = (k % 10) / 10.0
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select(F.concat(F.lit("n"), k.cast("string")).alias("#name"), F.when(k % 7 == 3, "1.5").otherwise(share.cast("string")).alias("A"), (1 - share).cast("string").alias("B"), F.lit("0.0").alias("C"), k)
    rows.withColumn("copy", F.explode(F.when(k % 7 == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).select("#name", "A", "B", "C").write.option("header", True).csv(table)
    spark.createDataFrame([("Settings: none\n\nCharacter to attribute mapping:\n  A: North\n  B: Far South\n\nother: text\n",)], "value string").coalesce(1).write.text(mapping)
    good, bad = tools.ancestral_states(spark, table, mapping)
    none = F.lit(None)
    return rounded(good.select(F.lit("state").alias("what"), "node", "state", F.round("probability", 6).alias("probability")).unionByName(bad.select(c("problem").alias("what"), "node", none.cast("string").alias("state"), none.cast("double").alias("probability"))), "probability")


@query("""WITH k AS (SELECT s_suppkey k, s_suppkey % 8 AS kind FROM supplier) SELECT 'n' || k node, CASE WHEN kind IN (0, 1, 7) THEN 1990.0 + k END::DOUBLE AS estimate, CASE WHEN kind IN (0, 7) THEN 1985.0 + k END::DOUBLE low, CASE WHEN kind IN (0, 7) THEN 1995.0 + k END::DOUBLE high, CASE kind WHEN 2 THEN 'half_an_interval' WHEN 3 THEN 'date_outside_interval' WHEN 4 THEN 'invalid_date' WHEN 5 THEN 'invalid_bound' WHEN 6 THEN 'repeated_node' END problem FROM k""")
def s25_node_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates of nodes with and without intervals, and with wrong ones."""
    at, k = place(spark, "node-dates"), c("s_suppkey")
    m = k % 8
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select(F.concat(F.lit("n"), k.cast("string")).alias("node"), F.when(m == 4, "nan").otherwise((1990.0 + k).cast("string")).alias("numeric_date"), F.when(m.isin(1, 4), None).when(m == 3, (1991.0 + k).cast("string")).otherwise((1985.0 + k).cast("string")).alias("lower_bound"), F.when(m.isin(1, 2, 4), None).when(m == 5, "x").otherwise((1995.0 + k).cast("string")).alias("upper_bound"), m.alias("m"))
    rows.withColumn("copy", F.explode(F.when(c("m") == 6, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("copy", "m").write.option("header", True).csv(at)
    good, bad = tools.node_dates(spark, at)
    none = F.lit(None)
    return good.withColumn("problem", none.cast("string")).unionByName(bad.select("node", *(none.cast("double").alias(x) for x in ("estimate", "low", "high")), "problem"))


@query("""WITH k AS (SELECT s_suppkey k, s_suppkey % 4 AS kind FROM supplier) SELECT k, CASE WHEN kind <> 3 THEN round((k + 1) / 1000.0, 9) END rate, CASE WHEN kind < 2 THEN round((k + 1) / 10000.0, 9) END rate_sd, CASE WHEN kind <> 2 THEN 0.25 END r_squared, CASE kind WHEN 2 THEN 'not_a_clock_report' WHEN 3 THEN 'not_a_clock_report' END problem FROM k""")
def s25_clock_reports(spark: SparkSession, sf: str) -> DataFrame:
    """A report for each supplier, some without a rate or its fit."""
    at, k = place(spark, "clock"), c("s_suppkey")
    rate = F.when(k % 4 != 3, F.concat(F.lit(" --rate:\t"), F.format_string("%.6e", (k + 1) / 1000.0), F.when(k % 4 < 2, F.concat(F.lit(" +/- "), F.format_string("%.6e", (k + 1) / 10000.0), F.lit(" (one std-dev)"))).otherwise(""), F.lit("\n"))).otherwise("")
    text = F.concat(F.lit("Root-Tip-Regression:\n"), rate, F.when(k % 4 != 2, " --r^2:\t0.25\n").otherwise(""))
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select(F.concat(F.lit("r"), k.cast("string"), F.lit(".txt")).alias("path"), F.encode(text, "UTF-8").alias("content"))
    checkpointed(files.put_all(rows, at))
    found = tools.clock_fits(spark, at)
    return rounded(found.select(F.regexp_extract("file", "r([0-9]+)[.]txt$", 1).cast("bigint").alias("k"), "rate", "rate_sd", "r_squared", "problem"), "rate", "rate_sd")


@query("SELECT event_id, event_type FROM events")
def u01_captured_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Records captured from a stream of files, batch by batch; what an attempt left that was never committed is not read."""
    source, target, state = place(spark, "in"), place(spark, "captured"), place(spark, "state")
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type")
    events.repartition(3).write.json(source)
    events.where("event_id % 2 = 0").write.parquet(f"{target}/rows/stream-0-killed")
    capture.captured(capture.stream_of(spark, source, "event_id bigint, event_type string"), target, state)
    return capture.committed(spark, target).select("event_id", "event_type")


@query("SELECT 'input' AS source, count(*) n, count(DISTINCT country) countries FROM @samples WHERE role = 'input' UNION ALL SELECT 'context', count(*), count(DISTINCT country) FROM samples WHERE role <> 'input'")
def u01_appended_records(spark: SparkSession, sf: str) -> DataFrame:
    """Input and context records, each from a stream of its own, appended to one table; the context comes in two runs."""
    target, samples = place(spark, "appended"), view(spark, sf, "samples").select("sample_id", "role", "country")
    for name, parts in (("input", ["role = 'input'"]), ("context", ["role != 'input' and sample_id % 2 = 0", "role != 'input' and sample_id % 2 = 1"])):
        source, state = place(spark, "in"), place(spark, "state")
        for i, part in enumerate(parts):
            samples.where(part).write.json(f"{source}/part={i}")
            capture.captured(capture.stream_of(spark, f"{source}/*", "sample_id bigint, role string, country string"), target, state, name)
    return capture.committed(spark, target).groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("country").alias("countries"))


@query("""WITH k AS (SELECT s_suppkey // 4 AS f, count(*) n, bool_or(s_suppkey % 4 = 1) one, bool_or(s_suppkey % 4 = 2) two, bool_or(s_suppkey % 4 = 3) three FROM supplier GROUP BY 1)
 SELECT problem, count(*) files, sum(m)::BIGINT n FROM (SELECT 'repeated_name' problem, 1 m FROM k WHERE f % 4 = 1 AND one UNION ALL SELECT 'empty_sequence', 1 FROM k WHERE f % 4 = 2 AND two UNION ALL SELECT 'unequal_length', 1 FROM k WHERE f % 4 = 2 AND two AND n > 1 UNION ALL SELECT 'unequal_length', 1 FROM k WHERE f % 4 = 3 AND three AND n > 1) GROUP BY 1""")
def s20_alignment_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Alignments of up to four sequences: sound ones, and ones with a repeated name, an empty sequence or another length."""
    at, k = place(spark, "alignments"), c("sample_id")
    kind = F.floor(k / 4) % 4
    name = F.when((kind == 1) & (k % 4 == 1), (k - 1)).otherwise(k)
    seq = F.when((kind == 2) & (k % 4 == 2), "").when((kind == 3) & (k % 4 == 3), F.concat("seq", F.lit("A"))).otherwise(c("seq"))
    one = sequences(spark, sf).select(F.floor(k / 4).alias("file"), F.concat(F.lit(">s"), name.cast("string"), F.lit("\n"), seq, F.lit("\n")).alias("one"))
    rows = one.groupBy("file").agg(F.array_join(F.sort_array(F.collect_list("one")), "").alias("body"))
    checkpointed(files.put_all(rows.select(F.concat(F.lit("a"), c("file").cast("string"), F.lit(".fasta")).alias("path"), F.encode("body", "UTF-8").alias("content")), at))
    return readers.alignment_violations(readers.fasta(spark, at)).groupBy("problem").agg(F.count("*").alias("files"), F.sum("n").alias("n"))


@query("""SELECT s_suppkey::VARCHAR id, s_suppkey % 7 || '_' || s_nationkey code FROM supplier""")
def s14_lineage_export(spark: SparkSession, sf: str) -> DataFrame:
    """Lineage codes from JSON and tab separated files whose headers are spelled differently, each with its file's digest."""
    at, k = place(spark, "lineages"), c("s_suppkey")
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select(k, F.concat((k % 7).cast("string"), F.lit("_"), c("s_nationkey").cast("string")).alias("code"))
    body = F.to_json(F.collect_list(F.struct(k.cast("string").alias("Source genome_ID"), c("code").alias("LIN code"))))
    table = F.concat(F.lit("source-genome-id\tLINcode\n"), F.array_join(F.collect_list(F.concat_ws("\t", k.cast("string"), "code")), "\n"))
    some = rows.where(k % 2 == 0).agg(body.alias("b")).select(F.lit("a.json").alias("path"), "b").unionByName(rows.where(k % 2 == 1).agg(table.alias("b")).select(F.lit("b.tsv").alias("path"), "b"))
    checkpointed(files.put_all(some.select("path", F.encode("b", "UTF-8").alias("content")), at))
    found, bad = readers.lineage_export(spark, at)
    digests = files.listed(spark, at).select(F.col("sha256").alias("file_sha256"))
    whole = found.join(digests, "file_sha256", "left_semi")
    return whole.select("id", "code").unionByName(bad.select(F.col("problem").alias("id"), F.lit("").alias("code")))


@query("""WITH k AS (SELECT s_suppkey k, s_suppkey % 6 AS kind FROM supplier) SELECT 's' || k sample_id, CASE kind WHEN 1 THEN 'missing_species' WHEN 2 THEN 'invalid_collection_date' WHEN 3 THEN 'file_not_found' WHEN 4 THEN 'missing_assembly' END error FROM k WHERE kind BETWEEN 1 AND 4""")
def s10_study_files_and_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Study metadata with several required columns, dates in the study's grammar, and assemblies that must be there."""
    at, there, k = place(spark, "study"), place(spark, "assemblies"), c("s_suppkey")
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select(k, (k % 6).alias("kind"))
    fasta = F.concat(F.lit("a"), k.cast("string"), F.lit(".fasta"))
    checkpointed(files.put_all(rows.where("kind != 3").select(fasta.alias("path"), F.encode(F.lit(">a\nACGT\n"), "UTF-8").alias("content")), there))
    date = F.element_at(F.array(*map(F.lit, ("2001", "2001-02", "2001-02-03", ""))), (k % 4 + 1).cast("int"))
    told = rows.select(F.concat(F.lit("s"), k.cast("string")).alias("sample_id"), F.when(c("kind") != 1, "Species one").alias("species"), F.when(c("kind") == 2, "2001-13").otherwise(date).alias("collection_date"), F.when(c("kind") != 4, fasta).alias("assembly"))
    told.write.option("header", True).csv(at)
    return readers.study_metadata(spark, at, ["species", "assembly"], dates=["collection_date"], files=("assembly", files.listed(spark, there).select("path")))[1]


@query("SELECT date_trunc('hour', ts)::VARCHAR begins, event_type, count(*) n, round(sum(value), 6) total FROM events GROUP BY 1, 2")
def u02_windowed_events(spark: SparkSession, sf: str) -> DataFrame:
    found = capture.windowed_counts(spark.read.parquet(f"{sf}/events.parquet"), "ts", "1 hour", "1 hour")
    return found.select(F.date_format("begins", "yyyy-MM-dd HH:mm:ss").alias("begins"), "event_type", "n", F.round("total", 6).alias("total"))


@query("SELECT sample_id, locus, count(DISTINCT allele) alleles FROM @hits GROUP BY 1, 2")
def s15_event_calls(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "hits").groupBy("sample_id", "locus").agg(F.count_distinct("allele").alias("alleles"))


