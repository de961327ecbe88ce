"""Queries over scalar rules, identity joins and scopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import scalars as S
from ..operators import identity as I
from ..operators import pairs as P
from .q_aggregates import rounded
from .registry import query
from .views import TODAY, sequences, view

c = F.col


@query("""WITH v AS (SELECT o_orderkey id, CASE o_orderkey % 8 WHEN 0 THEN ' 0012 ' WHEN 1 THEN '0' WHEN 2 THEN md5(o_orderkey::VARCHAR) || 'ABCDEF01' WHEN 3 THEN 'n/a' WHEN 4 THEN '' WHEN 5 THEN 'novel-' || o_orderkey WHEN 6 THEN NULL ELSE o_orderkey::VARCHAR END raw FROM orders)
 SELECT id, CASE WHEN lower(trim(coalesce(raw,''))) NOT IN ('','0','-','?','none','null','unknown','na','n/a') THEN trim(raw) END stored,
 CASE WHEN regexp_full_match(trim(raw), '[0-9a-fA-F]{40}') THEN lower(trim(raw)) WHEN regexp_full_match(trim(raw), '[0-9]+') AND ltrim(trim(raw), '0') <> '' THEN ltrim(trim(raw), '0') END compared FROM v""")
def f01_f02_alleles(spark: SparkSession, sf: str) -> DataFrame:
    k = c("o_orderkey")
    raw = F.when(k % 8 == 0, " 0012 ").when(k % 8 == 1, "0").when(k % 8 == 2, F.concat(F.md5(k.cast("string").cast("binary")), F.lit("ABCDEF01"))).when(k % 8 == 3, "n/a").when(k % 8 == 4, "").when(k % 8 == 5, F.concat(F.lit("novel-"), k.cast("string"))).when(k % 8 == 7, k.cast("string"))
    return spark.read.parquet(f"{sf}/orders.parquet").select(k.alias("id"), S.model_allele(raw).alias("stored"), S.comparable_allele(raw).alias("compared"))


@query("""WITH t AS (SELECT s_suppkey id, s_suppkey % 5 = 0 blocked, s_suppkey % 3 = 0 clash, s_suppkey % 7 = 0 wide FROM supplier) SELECT id, CASE WHEN NOT blocked AND NOT clash THEN 3 END::BIGINT calls, CASE WHEN NOT blocked AND NOT clash AND NOT wide THEN 'a,b,c,d' END loci FROM t""")
def f03_f04_profiles(spark: SparkSession, sf: str) -> DataFrame:
    k = c("s_suppkey")
    called = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))
    novel = F.when(k % 3 == 0, F.create_map(F.lit("b"), F.lit("9"))).otherwise(F.create_map(F.lit("c"), F.lit("9")))
    declared = F.when(k % 7 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("d"), F.lit("c"), F.lit("b"), F.lit("a")))
    profile = S.effective_profile(F.when(k % 5 == 0, "conflict").otherwise("resolved"), called, novel)
    return spark.read.parquet(f"{sf}/supplier.parquet").select(k.alias("id"), profile.alias("p"), declared.alias("d")).select("id", F.when(c("p").isNotNull(), F.size("p")).cast("bigint").alias("calls"), F.when(c("p").isNotNull(), F.array_join(S.locus_universe(c("d"), c("p")), ",")).alias("loci"))


@query("""SELECT sample_id, CASE WHEN scheme <> 'unknown' THEN scheme || '|' || version END scope, CASE WHEN scheme <> 'unknown' AND database_sha256 <> '' THEN scheme || '|sha256:' || database_sha256 END by_fingerprint FROM @samples""")
def f05_typing_scope(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "samples").select("sample_id", S.typing_scope(c("scheme"), c("version"), c("database_sha256")).alias("scope"), S.typing_scope(c("scheme"), F.lit("?"), c("database_sha256")).alias("by_fingerprint"))


@query("""WITH s AS (SELECT sample_id, CASE WHEN scheme <> 'unknown' THEN scheme || '|' || version END scope, database_sha256 sha FROM @samples) SELECT a.sample_id a, b.sample_id b, a.scope IS NOT DISTINCT FROM b.scope AND NOT (a.sha <> '' AND b.sha <> '' AND a.sha <> b.sha) compatible FROM s a JOIN s b ON a.sample_id < b.sample_id""")
def f06_compatible_typing(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples").select("sample_id", S.typing_scope(c("scheme"), c("version"), F.lit("")).alias("scope"), "database_sha256")
    return P.tiled(s).select(c("p.sample_id").alias("a"), c("q.sample_id").alias("b"), S.compatible_typing(c("p.scope"), c("q.scope"), c("p.database_sha256"), c("q.database_sha256")).alias("compatible"))


@query("""WITH p AS (SELECT sample_id, lineage, sample_id % 6 <> 5 AND sample_id % 8 = 0 bad, [x for x in string_split(lineage, '_') if regexp_full_match(x, '[0-9]+')] n FROM @samples)
 SELECT sample_id, CASE WHEN bad THEN 'malformed' ELSE 'partial' END status, CASE WHEN bad THEN 0 ELSE len(n) END::BIGINT depth, CASE WHEN bad OR len(n) < 4 THEN '' ELSE '["s","1",[' || array_to_string(n[1:4], ',') || ']]' END group_4 FROM p""")
def f07_f08_lineage_codes(spark: SparkSession, sf: str) -> DataFrame:
    parts = S.lineage_components(c("lineage"))
    return view(spark, sf, "samples").select("sample_id", S.lineage_status(c("lineage")).alias("status"), F.size(parts).cast("bigint").alias("depth"), S.lineage_group(F.lit("s"), F.lit("1"), parts, 4).alias("group_4"))


@query("""WITH p AS (SELECT sample_id, CASE WHEN sample_id % 6 <> 5 AND sample_id % 8 = 0 THEN [] ELSE [x for x in string_split(lineage, '_') if regexp_full_match(x, '[0-9]+')] END n FROM @samples),
 k AS (SELECT a.sample_id a, b.sample_id b, a.n x, b.n y, least(len(a.n), len(b.n)) m, coalesce(list_min([i for i in range(1, 6) if i > least(len(a.n), len(b.n)) OR a.n[i] <> b.n[i]]) - 1, 5) d FROM p a JOIN p b ON a.sample_id < b.sample_id)
 SELECT a, b, CASE WHEN m < 3 THEN 'Unresolved LIN3 prefix' WHEN x[1:3] = y[1:3] THEN 'Same LIN3 prefix' ELSE 'Different LIN3 prefixes' END relation, CASE WHEN m = 0 THEN 'Not assessed' WHEN d = m THEN '≥' || d ELSE d::VARCHAR END AS depth FROM k""")
def f28_prefix_relation(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples").select("sample_id", S.lineage_components(c("lineage")).alias("n"))
    return P.prefix_pairs(s, 3)


@query("""SELECT sample_id, CASE WHEN scheme <> 'unknown' AND sample_id % 5 <> 1 AND sample_id % 3 <> 2 THEN scheme || '|' || version || '|' || sample_id END AS "key" FROM @samples""")
def f11_hierarchy_key(spark: SparkSession, sf: str) -> DataFrame:
    k = c("sample_id")
    return view(spark, sf, "samples").select("sample_id", S.hierarchy_key(S.typing_scope(c("scheme"), c("version"), F.lit("")), F.when(k % 5 == 1, "Conflict").otherwise("resolved"), F.when(k % 3 == 2, F.concat(F.lit("new"), k.cast("string"))).otherwise(k.cast("string"))).alias("key"))


@query("""SELECT id, array_to_string(list_sort(list_distinct([x for x in ['SAMN' || (id % 400), 'SRR' || split_part(run_accession, 'SRR', 2), 'GCA_' || id || '.1'] if x IS NOT NULL])), ';') strong, CASE WHEN id % 4 = 0 THEN 'study' WHEN id % 4 = 1 THEN 'run' WHEN id % 4 = 2 THEN 'biosample' ELSE 'other' END kind FROM @identities""")
def f13_f14_accessions(spark: SparkSession, sf: str) -> DataFrame:
    k = c("id")
    one = F.when(k % 4 == 0, F.concat(F.lit("PRJNA"), k.cast("string"))).when(k % 4 == 1, c("run_accession")).when(k % 4 == 2, c("sample_accession")).otherwise("isolate")
    named = F.concat(F.lit("gca_"), k.cast("string"), F.lit(".1; PRJNA5, plain"))
    return view(spark, sf, "identities").select("id", F.array_join(S.strong_accessions(c("sample_accession"), F.lower(c("run_accession")), named), ";").alias("strong"), S.accession_kind(one).alias("kind"))


@query("""SELECT sample_id, CASE WHEN sample_id % 4 = 3 THEN NULL WHEN sample_id % 4 = 0 THEN 'Germany' ELSE trim(n) END country FROM (SELECT sample_id, country n FROM @samples) s""".replace("trim(n)", "CASE WHEN n = 'unknown' THEN NULL ELSE n END"))
def f15_f16_country(spark: SparkSession, sf: str) -> DataFrame:
    k = c("sample_id")
    lookup = F.create_map(F.lit("DE"), F.lit("Germany"), F.lit("DEUTSCHLAND"), F.lit("Germany"))
    raw = F.when(k % 4 == 3, F.lit("not provided")).when(k % 8 == 0, F.lit("DE")).when(k % 8 == 4, F.lit("DE - deutschland")).when(k % 4 == 1, F.concat(c("country"), F.lit(": somewhere"))).otherwise(c("country"))
    return view(spark, sf, "samples").select("sample_id", S.country_name(raw, lookup).alias("country"))


START = "CASE WHEN regexp_full_match(raw, '\\d{4}') THEN try_cast(raw || '-01-01' AS DATE) WHEN regexp_full_match(raw, '\\d{4}-\\d{2}') THEN try_cast(raw || '-01' AS DATE) WHEN regexp_full_match(raw, '\\d{4}-\\d{2}-\\d{2}') THEN try_cast(raw AS DATE) WHEN raw LIKE '%/%' THEN try_cast(split_part(raw, '/', 1) || '-01-01' AS DATE) END"
END = "CASE WHEN regexp_full_match(raw, '\\d{4}') THEN try_cast(raw || '-12-31' AS DATE) WHEN regexp_full_match(raw, '\\d{4}-\\d{2}') THEN last_day(try_cast(raw || '-01' AS DATE)) WHEN regexp_full_match(raw, '\\d{4}-\\d{2}-\\d{2}') THEN try_cast(raw AS DATE) WHEN raw LIKE '%/%' THEN try_cast(split_part(raw, '/', 2) || '-12-31' AS DATE) END"
PRECISION = "CASE WHEN raw IN ('', 'not collected') THEN 'missing' WHEN s IS NULL OR e IS NULL THEN 'invalid' WHEN raw LIKE '%/%' THEN 'interval' WHEN length(raw) = 4 THEN 'year' WHEN length(raw) = 7 THEN 'month' ELSE 'day' END"
YEAR = "(year({0}) + (dayofyear({0}) - 1) / CASE WHEN year({0}) % 4 = 0 AND (year({0}) % 100 <> 0 OR year({0}) % 400 = 0) THEN 366.0::DOUBLE ELSE 365.0::DOUBLE END)"


@query(f"WITH b AS (SELECT id, raw, {START} s, {END} e FROM @dates) SELECT id, s::VARCHAR AS start_day, e::VARCHAR AS end_day, {PRECISION} AS precision FROM b")
def f17_f18_date_bounds(spark: SparkSession, sf: str) -> DataFrame:
    start, end, precision = D.ingest(c("raw"))
    return view(spark, sf, "dates").select("id", start.cast("string").alias("start_day"), end.cast("string").alias("end_day"), precision.alias("precision"))


@query(f"""WITH b AS (SELECT id, raw, {START} s, {END} e FROM @dates), k AS (SELECT *, {PRECISION} p FROM b) SELECT (min(s) FILTER (p NOT IN ('missing', 'invalid')))::VARCHAR first_day, (max(e) FILTER (p NOT IN ('missing', 'invalid')))::VARCHAR last_day,
 count(*) FILTER (p = 'year') AS "years", count(*) FILTER (p = 'month') AS "months", count(*) FILTER (p = 'day') AS "days", count(*) FILTER (p = 'interval') AS "intervals", count(*) FILTER (p = 'missing') AS missing, count(*) FILTER (p = 'invalid') AS invalid FROM k""")
def a33_date_summary(spark: SparkSession, sf: str) -> DataFrame:
    """All dates: the first and last day that any can mean, and how many there are of each precision, blanks and errors too."""
    start, end, precision = D.ingest(c("raw"))
    counts = [F.count_if(c("p") == k).alias(f"{k}s" if k not in ("missing", "invalid") else k) for k in ("year", "month", "day", "interval", "missing", "invalid")]
    return view(spark, sf, "dates").select(start.alias("s"), end.alias("e"), precision.alias("p")).agg(F.min("s").cast("string").alias("first_day"), F.max("e").cast("string").alias("last_day"), *counts)


@query(f"""WITH b AS (SELECT id, raw, {START} s, {END} e FROM @dates), k AS (SELECT *, {PRECISION} p FROM b) SELECT id, CASE WHEN p IN ('missing', 'invalid') THEN p WHEN s > DATE '{TODAY}' THEN 'future' ELSE 'valid' END status, round({YEAR.format('s')}, 9) year_min, round({YEAR.format('e')}, 9) year_max, round(({YEAR.format('s')} + {YEAR.format('e')}) / 2, 9) midpoint FROM k""")
def f19_sample_interval(spark: SparkSession, sf: str) -> DataFrame:
    found = view(spark, sf, "dates").select("id", D.canonical(c("raw"), today=TODAY).alias("d")).select("id", "d.status", "d.year_min", "d.year_max", "d.midpoint")
    return rounded(found, "year_min", "year_max", "midpoint")


@query(f"""SELECT id, year(s)::BIGINT AS legacy_year FROM (SELECT id, raw, CASE WHEN raw NOT LIKE '%/%' THEN {START} END s FROM @dates) WHERE s <= DATE '1999-12-31' OR s IS NULL UNION ALL SELECT id, NULL FROM (SELECT id, raw, CASE WHEN raw NOT LIKE '%/%' THEN {START} END s FROM dates) WHERE s > DATE '1999-12-31'""")
def f20_legacy_year(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "dates").select("id", D.legacy_year(c("raw"), "1999-12-31").cast("bigint").alias("legacy_year"))


@query("""SELECT id, CASE id % 4 WHEN 0 THEN 1999.25 WHEN 1 THEN 1998 WHEN 2 THEN 1997.0 ELSE 2000.0 END::DOUBLE lower, CASE id % 4 WHEN 0 THEN 1999.25 WHEN 1 THEN 1999.5 WHEN 2 THEN 1997 + 364 / 365.0::DOUBLE ELSE 2000 + 30 / 366.0::DOUBLE END upper, CASE id % 4 WHEN 0 THEN 'numeric' WHEN 1 THEN 'interval' WHEN 2 THEN 'year' ELSE 'month' END AS precision FROM @dates""".replace(" upper,", " AS upper_,").replace(" lower,", " AS lower_,").replace("2000 + 30 / 366.0::DOUBLE END", "2000 + 30 / 366.0::DOUBLE END"))
def f21_clock_dates(spark: SparkSession, sf: str) -> DataFrame:
    k = c("id") % 4
    raw = F.when(k == 0, "1999.25").when(k == 1, "[1998:1999.5]").when(k == 2, "1997-XX-XX").otherwise("2000-01-XX")
    return view(spark, sf, "dates").select("id", D.clock_bounds(raw, TODAY).alias("d")).select("id", c("d.year_min").alias("lower_"), c("d.year_max").alias("upper_"), "d.precision")


def in_order(dates: DataFrame) -> DataFrame:
    """Each date with the one before it, ``y``.

    Ranges of ids are windows of their own; the first date of a range gets the last of the nearest range before it, so
    no task holds more than a range and the table of ranges' last dates.
    """
    span = 4096
    block = dates.withColumn("_b", F.floor(c("id") / span))
    inside = block.withColumn("_y", F.lag("raw").over(Window.partitionBy("_b").orderBy("id"))).withColumn("_i", F.row_number().over(Window.partitionBy("_b").orderBy("id")))
    last = block.groupBy("_b").agg(F.max_by("raw", "id").alias("_last"))
    before = last.select("_b", F.lag("_last").over(Window.orderBy("_b")).alias("_before"))
    return inside.join(before, "_b").select("id", "raw", F.when(c("_i") == 1, c("_before")).otherwise(c("_y")).alias("y"))


@query("""WITH p AS (SELECT id, raw x, lag(raw) OVER (ORDER BY id) y FROM @dates) SELECT id, CASE WHEN regexp_matches(x, '^\\d{4}-\\d{2}') AND regexp_matches(y, '^\\d{4}-\\d{2}') AND x[1:7] = y[1:7] THEN 'same_month' WHEN regexp_matches(x, '^\\d{4}') AND regexp_matches(y, '^\\d{4}') AND x[1:4] = y[1:4] THEN 'same_year' WHEN regexp_matches(x, '^\\d{4}') AND regexp_matches(y, '^\\d{4}') THEN 'between_years' ELSE 'date_unavailable' END period FROM p""")
def f23_period_comparison(spark: SparkSession, sf: str) -> DataFrame:
    rows = in_order(view(spark, sf, "dates"))
    return rows.select("id", D.period_comparison(c("raw"), c("y")).alias("period"))


@query("""SELECT id, CASE WHEN id % 10 = 0 THEN 'id' || id WHEN id % 3 = 0 THEN run_accession WHEN id % 3 = 1 THEN sample_accession ELSE 'strain ' || id END label FROM @identities""")
def f24_labels(spark: SparkSession, sf: str) -> DataFrame:
    k = c("id")
    values = F.when(k % 3 == 0, F.array("run_accession", "sample_accession")).when(k % 3 == 1, F.array("sample_accession", F.lit("other"))).otherwise(F.array(F.lit("other")))
    return view(spark, sf, "identities").select("id", S.sample_label(F.concat(F.lit("id"), k.cast("string")), k % 10 == 0, values, F.concat(F.lit("strain "), k.cast("string"))).alias("label"))


@query("""SELECT sample_id, CASE sample_id % 5 WHEN 0 THEN 'Homo sapiens' WHEN 1 THEN NULL WHEN 2 THEN 'Bos taurus' ELSE 'Gallus gallus' END host, CASE WHEN country = 'unknown' THEN 'Unknown country' ELSE country END || ' / ' || region region, CASE WHEN city <> '' THEN CASE WHEN country = 'unknown' THEN 'Unknown country' ELSE country END || ' / ' || region || ' / ' || city END city FROM @samples""")
def f25_states(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "samples").select("sample_id", S.host_state(c("host")).alias("host"), S.place_state(c("country"), c("region"), c("city"), "region").alias("region"), S.place_state(c("country"), c("region"), c("city"), "city").alias("city"))


@query("""SELECT sample_id, sample_id % 10 = 0 AS input, 'species one' species_key, substr(sha256(coalesce(st, '') || '|' || version), 1, 12) AS block, 'CC_' || substr(sha256(sample_id::VARCHAR), 1, 16) AS export_id FROM @samples""")
def f27_f30_keys(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "samples").select("sample_id", S.is_input(c("role"), F.lit("context")).alias("input"), S.species_key(c("species")).alias("species_key"), S.digest12(c("st"), c("version")).alias("block"), S.export_id(c("sample_id")).alias("export_id"))


@query("""WITH t AS (SELECT a.sample_id a, b.sample_id b, unnest(range(1, 65)) i, a.seq x, b.seq y FROM @sequences a JOIN @sequences b ON a.sample_id + 1 = b.sample_id) SELECT a, b, sum(CASE WHEN x[i] <> 'N' AND y[i] <> 'N' THEN 1 ELSE 0 END)::BIGINT sites, sum(CASE WHEN x[i] <> 'N' AND y[i] <> 'N' AND x[i] <> y[i] THEN 1 ELSE 0 END)::BIGINT snps FROM t GROUP BY 1, 2""")
def f31_sequence_stats(spark: SparkSession, sf: str) -> DataFrame:
    s = sequences(spark, sf)
    x, y = s.alias("x"), s.alias("y")
    return x.join(y, c("x.sample_id") + 1 == c("y.sample_id")).select(c("x.sample_id").alias("a"), c("y.sample_id").alias("b"), S.called_bases(c("x.seq"), c("y.seq")).cast("bigint").alias("sites"), S.base_differences(c("x.seq"), c("y.seq")).cast("bigint").alias("snps"))


@query("""WITH a AS (SELECT s_suppkey src, s_nationkey || '-' || (s_suppkey % 3) code FROM supplier UNION ALL SELECT s_suppkey, s_nationkey || '-0' FROM supplier WHERE s_suppkey % 4 = 0),
 j AS (SELECT c_custkey id, count(*) matches, count(DISTINCT code) k, min(code) v FROM (SELECT c_custkey, unnest([c_custkey, c_custkey + 1000]) src FROM customer) x JOIN a USING (src) GROUP BY 1)
 SELECT c_custkey id, coalesce(matches, 0) matches, CASE WHEN matches IS NULL THEN 'missing' WHEN k > 1 THEN 'conflict' ELSE 'assigned' END status, CASE WHEN k = 1 THEN v END code FROM customer LEFT JOIN j ON j.id = c_custkey""")
def j06_annotated_lineages(spark: SparkSession, sf: str) -> DataFrame:
    s = spark.read.parquet(f"{sf}/supplier.parquet")
    code = lambda x: F.concat(c("s_nationkey").cast("string"), F.lit("-"), x.cast("string"))
    given = s.select(c("s_suppkey").alias("src"), code(c("s_suppkey") % 3).alias("code")).unionByName(s.where("s_suppkey % 4 = 0").select(c("s_suppkey").alias("src"), code(F.lit(0)).alias("code")))
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(c("c_custkey").alias("id"))
    return I.annotate(rows, F.array("id", c("id") + 1000), given, "src", c("code"), "code")


@query("""WITH f AS (SELECT sample_id, CASE WHEN sample_id % 3 = 0 THEN sample_id % 5 END direct FROM @samples WHERE role = 'input'), x AS (SELECT sample_id, list_sort(list_distinct(list(src))) e FROM (SELECT sample_id, sample_id + 1 src FROM @samples s1 WHERE sample_id % 4 = 0 UNION ALL SELECT sample_id, sample_id + 2 FROM @samples s2 WHERE sample_id % 8 = 0) GROUP BY 1),
 acc AS (SELECT s.sample_id, list_sort(list_distinct(list(c_custkey))) a FROM @samples s JOIN customer ON c_custkey % 97 = s.sample_id % 101 GROUP BY 1),
 m AS (SELECT f.sample_id, direct, coalesce(e, []) e, coalesce(a, []) a, list_sort(list_distinct(list_concat(CASE WHEN e IS NOT NULL THEN e ELSE coalesce(a, []) END, CASE WHEN direct IS NOT NULL THEN [direct] ELSE [] END))) m FROM f LEFT JOIN x USING (sample_id) LEFT JOIN acc USING (sample_id)),
 st AS (SELECT *, CASE WHEN (len(e) > 0 AND len(a) > 0 AND e <> a) OR (direct IS NOT NULL AND len(a) > 0 AND NOT list_contains(a, direct)) THEN 'conflict' WHEN len(m) = 0 THEN 'missing' WHEN len(m) > 1 THEN 'ambiguous' WHEN m[1] NOT IN (SELECT c_custkey FROM customer) THEN 'unavailable' ELSE 'matched' END status FROM m)
 SELECT sample_id, status, len(m)::BIGINT candidates, CASE WHEN status = 'matched' THEN m[1] END source_id FROM st""")
def j08_focal_resolution(spark: SparkSession, sf: str) -> DataFrame:
    s, k = view(spark, sf, "samples"), c("sample_id")
    cust = spark.read.parquet(f"{sf}/customer.parquet").select(c("c_custkey").alias("source_id"))
    focal = s.where("role = 'input'").select("sample_id", (k % 101).alias("accession"), F.when(k % 3 == 0, k % 5).alias("direct_id"))
    links = s.where("sample_id % 4 = 0").select("sample_id", (k + 1).alias("source_id")).unionByName(s.where("sample_id % 8 = 0").select("sample_id", (k + 2).alias("source_id")))
    return I.resolve_focal(focal, links, cust.select((c("source_id") % 97).alias("accession"), "source_id"), cust)


@query("""WITH w AS (SELECT DISTINCT sample_accession AS alias FROM @identities WHERE id % 5 = 0 UNION SELECT 'SAMN999999'), k AS (SELECT w.alias, count(DISTINCT id) n, min(id) id FROM w LEFT JOIN @identities i ON i.sample_accession = w.alias AND i.id % 2 = 0 GROUP BY 1) SELECT alias, n candidates, CASE n WHEN 1 THEN 'found' WHEN 0 THEN 'missing' ELSE 'ambiguous' END status, CASE WHEN n = 1 THEN id END candidate FROM k""")
def j09_exactly_one(spark: SparkSession, sf: str) -> DataFrame:
    i = view(spark, sf, "identities")
    wanted = i.where("id % 5 = 0").select(c("sample_accession").alias("alias")).distinct().union(spark.sql("select 'SAMN999999'"))
    return I.exactly_one(wanted, i.where("id % 2 = 0").select(c("sample_accession").alias("alias"), c("id").alias("candidate")))


@query("""SELECT sample_id, version, CASE WHEN sample_id % 3 = 0 AND version = '1' THEN 'typed ' || sample_id ELSE st END st, CASE WHEN sample_id % 3 = 0 THEN CASE WHEN version = '1' THEN 'typed' ELSE 'guard_differs' END ELSE 'kept' END overlay FROM @samples""")
def j10_typing_overlay(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples")
    typed = s.where("sample_id % 3 = 0").select("sample_id", F.lit("1").alias("version"), F.concat(F.lit("typed "), c("sample_id").cast("string")).alias("st"))
    return I.overlay(s.select("sample_id", "version", "st"), typed, "sample_id", "version", ["st"])


@query("""WITH k AS (SELECT sample_id, role, coalesce(st, '') || '/' || region AS block FROM @samples) SELECT sample_id, role, block FROM k WHERE block IN (SELECT block FROM k WHERE role = 'input')""")
def j11_context_in_input_blocks(spark: SparkSession, sf: str) -> DataFrame:
    k = view(spark, sf, "samples").select("sample_id", "role", F.concat(F.coalesce("st", F.lit("")), F.lit("/"), c("region")).alias("block"))
    return k.join(k.where("role = 'input'").select("block").distinct(), "block", "left_semi").select("sample_id", "role", "block")


@query("""WITH s AS (SELECT sample_id, role, CASE WHEN scheme <> 'unknown' THEN version END v, database_sha256 sha, split_part(lineage, '_', 1) || split_part(lineage, '_', 2) l FROM @samples) SELECT DISTINCT k.sample_id FROM s k JOIN s i ON i.role = 'input' AND k.role = 'context' AND k.v = i.v AND k.l = i.l AND NOT (k.sha <> '' AND i.sha <> '' AND k.sha <> i.sha)""")
def j12_lineage_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples").where("scheme != 'unknown'").select("sample_id", "role", "version", F.slice(F.split("lineage", "_"), 1, 2).alias("prefix"), c("database_sha256").alias("sha"))
    k, i = s.where("role = 'context'").alias("k"), s.where("role = 'input'").alias("i")
    return k.join(i, (c("k.version") == c("i.version")) & (c("k.prefix") == c("i.prefix")) & ((c("k.sha") == "") | (c("i.sha") == "") | (c("k.sha") == c("i.sha"))), "left_semi").select("sample_id")


@query("""WITH known AS (SELECT DISTINCT sample_accession a FROM @identities WHERE id % 10 = 0 UNION SELECT run_accession FROM @identities i2 WHERE id % 10 = 0) SELECT id, CASE WHEN sample_accession IN (SELECT a FROM known) OR run_accession IN (SELECT a FROM known) THEN 'already_present_exact_identity' WHEN country IS NULL THEN 'profile_unavailable' WHEN quality < 0 THEN 'incompatible_profile_scope' END reason FROM @identities i3 WHERE id % 10 <> 0""")
def j13_ordered_exclusions(spark: SparkSession, sf: str) -> DataFrame:
    i = view(spark, sf, "identities").withColumn("aliases", F.array("sample_accession", "run_accession"))
    return I.without_known(i.where("id % 10 != 0"), i.where("id % 10 = 0"), [("profile_unavailable", c("country").isNull()), ("incompatible_profile_scope", c("quality") < 0)])


@query("""SELECT sample_id, locus, CASE WHEN allele::INT % 7 = 0 THEN md5(allele) || 'abcdef01' WHEN allele::INT % 5 <> 0 THEN sha1(locus || allele) END sha1, CASE WHEN allele::INT % 7 = 0 THEN 'hash' WHEN allele::INT % 5 <> 0 THEN 'translated' ELSE 'unsupported' END status FROM @dense_calls""")
def j14_translated_alleles(spark: SparkSession, sf: str) -> DataFrame:
    calls = view(spark, sf, "dense_calls")
    index = calls.where("cast(allele as int) % 5 != 0").select("locus", c("allele").alias("number"), F.sha1(F.concat("locus", "allele")).alias("sha1")).distinct()
    given = calls.withColumn("allele", F.when(c("allele").cast("int") % 7 == 0, F.upper(F.concat(F.md5("allele"), F.lit("abcdef01")))).otherwise(c("allele")))
    return I.translated(given, index)


DNA = "translate(md5(locus || allele), '0123456789abcdef', 'ACGTACGTACGTACGN')"


@query(f"""WITH k AS (SELECT sample_id, locus, allele, {DNA} dna FROM @calls), u AS (SELECT a.sample_id a, b.sample_id b, a.locus, a.dna x, b.dna y, unnest(range(1, 33)) i FROM k a JOIN k b ON a.locus = b.locus AND a.sample_id < b.sample_id)
 SELECT a, b, count(DISTINCT locus) loci, 0::BIGINT missing_loci, sum(CASE WHEN x[i] <> 'N' AND y[i] <> 'N' THEN 1 ELSE 0 END)::BIGINT sites, sum(CASE WHEN x[i] <> 'N' AND y[i] <> 'N' AND x[i] <> y[i] THEN 1 ELSE 0 END)::BIGINT snps, round(sum(CASE WHEN x[i] <> 'N' AND y[i] <> 'N' AND x[i] <> y[i] THEN 1 ELSE 0 END)::DOUBLE / sum(CASE WHEN x[i] <> 'N' AND y[i] <> 'N' THEN 1 ELSE 0 END), 9) distance FROM u GROUP BY 1, 2""")
def j15_direct_dna(spark: SparkSession, sf: str) -> DataFrame:
    calls = view(spark, sf, "calls")
    alleles = calls.select("locus", "allele").distinct().withColumn("dna", F.translate(F.md5(F.concat("locus", "allele")), "0123456789abcdef", "ACGTACGTACGTACGN"))
    return rounded(I.dna_distances(calls, I.allele_pair_stats(alleles)), "distance")


@query("""WITH RECURSIVE l AS (SELECT id, unnest([sample_accession, run_accession]) a FROM @identities), e AS (SELECT DISTINCT x.id x, y.id y FROM l x JOIN l y ON x.a = y.a), r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x) SELECT x id, min(y) unit FROM r GROUP BY 1""")
def t11_connected_units(spark: SparkSession, sf: str) -> DataFrame:
    i = view(spark, sf, "identities")
    return I.connected(i.select("id", F.explode(F.array("sample_accession", "run_accession")).alias("alias")))


@query("""WITH RECURSIVE l AS (SELECT id, unnest([sample_accession, run_accession]) a FROM @identities), e AS (SELECT DISTINCT x.id x, y.id y FROM l x JOIN l y ON x.a = y.a), r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x), u AS (SELECT x id, min(y) unit FROM r GROUP BY 1)
 SELECT unit, count(*) records, arg_max(id, {'q': quality, 'i': -id}) representative, count(DISTINCT country) countries, count(DISTINCT country) > 1 country_conflict, CASE WHEN count(DISTINCT sample_accession) > 1 THEN 'conflicting_samples' WHEN count(*) > 1 THEN 'duplicate' ELSE 'retained' END reason FROM @identities JOIN u USING (id) GROUP BY 1""")
def a12_unit_summary(spark: SparkSession, sf: str) -> DataFrame:
    i = view(spark, sf, "identities")
    return I.units(i, I.connected(i.select("id", F.explode(F.array("sample_accession", "run_accession")).alias("alias"))))
