"""Queries over aggregates, windows and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import scalars as S
from ..functions import vocabulary as V
from ..operators import aggregates as A
from ..operators import pairs as P
from . import q_pairs as Q
from .registry import query
from .views import OVERLAP, TODAY, sequences, view

R9 = lambda c: F.round(F.col(c) if isinstance(c, str) else c, 9)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 9) for c in columns})


def dated(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as records of customers' nations, with the year of the older rule."""
    return view(spark, sf, "dates").select((F.col("id") % 25).alias("group"), D.legacy_year(F.col("raw"), TODAY).cast("bigint").alias("year"), F.when(F.col("id") % 4 > 0, F.concat(F.lit("p"), (F.col("id") % 7).cast("string"))).alias("place"))


DATED = """d AS (SELECT id % 25 AS "group", CASE WHEN regexp_full_match(raw, '\\d{4}') AND (raw || '-01-01')::DATE <= DATE '2001-12-31' THEN raw[1:4]::BIGINT WHEN regexp_full_match(raw, '\\d{4}-\\d{2}') AND try_cast(raw || '-01' AS DATE) <= DATE '2001-12-31' THEN raw[1:4]::BIGINT WHEN regexp_full_match(raw, '\\d{4}-\\d{2}-\\d{2}') AND try_cast(raw AS DATE) <= DATE '2001-12-31' THEN raw[1:4]::BIGINT END AS year, CASE WHEN id % 4 > 0 THEN 'p' || (id % 7) END AS place FROM @dates)"""


@query("SELECT role, CASE WHEN trim(coalesce(country,''))='' THEN 'Unknown' ELSE trim(country) END country, CASE WHEN trim(coalesce(region,''))='' THEN 'Unknown' ELSE trim(region) END region, CASE WHEN trim(coalesce(city,''))='' THEN 'Unknown' ELSE trim(city) END city, count(*) n FROM @samples GROUP BY 1,2,3,4")
def a02_geography_cube(spark: SparkSession, sf: str) -> DataFrame:
    return A.geography_cube(view(spark, sf, "samples"))


@query("SELECT 'country' AS level, country, '' region, '' city, count(*) n, count(*) FILTER (role='input') input_n, count(*) FILTER (role='context') context_n FROM @samples GROUP BY country UNION ALL SELECT 'place', country, region, city, count(*), count(*) FILTER (role='input'), count(*) FILTER (role='context') FROM samples GROUP BY country, region, city")
def a03_geography_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return A.geography_rollup(view(spark, sf, "samples"))


@query("""WITH l AS (SELECT role, 'st' field, st AS value FROM @samples UNION ALL SELECT role, 'mlst_scheme', mlst_scheme FROM samples)
 SELECT field, coalesce(value, 'Missing') AS value, count(*) FILTER (role='input') input_n, count(*) FILTER (role='context') context_n, any_value(reported) reported, any_value(total) total
 FROM l JOIN (SELECT field, count(value) reported, count(*) total FROM l GROUP BY 1) r USING (field) GROUP BY 1, 2""")
def a04_composition(spark: SparkSession, sf: str) -> DataFrame:
    return A.composition(view(spark, sf, "samples"), ["st", "mlst_scheme"])


@query(f"""WITH {DATED} SELECT "group", array_to_string(list_sort(list_distinct(list(year) FILTER (year IS NOT NULL))), ',') AS "years", count(DISTINCT year) year_count, max(year) - min(year) year_span, count(year) dated, count(*) total FROM d GROUP BY 1""")
def a05_persistence(spark: SparkSession, sf: str) -> DataFrame:
    return A.persistence(dated(spark, sf), "group")


@query(f"""WITH {DATED}, c AS (SELECT "group", place, year, count(*) n FROM d WHERE place IS NOT NULL AND year IS NOT NULL GROUP BY 1,2,3) SELECT "group", sum(n)::BIGINT annotated, count(*) cells, round(max(n)::DOUBLE / sum(n), 9) largest_fraction FROM c GROUP BY 1""")
def a06_concentration(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.concentration(dated(spark, sf), "group"), "largest_fraction")


@query(f"""WITH {DATED}, c AS (SELECT "group", place, count(*) n FROM d WHERE place IS NOT NULL GROUP BY 1,2) SELECT "group", first_year, last_year, records, composition FROM (SELECT "group", min(year) first_year, max(year) last_year, count(*) records FROM d GROUP BY 1) p LEFT JOIN (SELECT "group", string_agg(place || ' (' || n || ')', ', ' ORDER BY n DESC, place) composition FROM c GROUP BY 1) t USING ("group")""")
def a07_group_at_a_glance(spark: SparkSession, sf: str) -> DataFrame:
    return A.at_a_glance(dated(spark, sf), "group", "place")


@query(f"""WITH {Q.BOTH}, r AS (SELECT q.sample_id query_id, k.sample_id context_id, q.country source, k.country target, diff, shared, rank() OVER (PARTITION BY q.sample_id ORDER BY diff) rk FROM @samples q JOIN bw ON bw.x = q.sample_id JOIN @samples k ON k.sample_id = bw.y WHERE q.role = 'input' AND k.role = 'context')
 SELECT source, target, count(DISTINCT query_id) query_count, count(DISTINCT context_id) context_count, count(*) comparison_count, min(diff) mismatches_min, max(diff) mismatches_max, min(shared) shared_min, max(shared) shared_max FROM r WHERE rk = 1 GROUP BY 1, 2""")
def a08_nearest_connections(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples")
    return A.connections(P.nearest_with_ties(Q.near(spark, sf, 1).select("a", "b", "diff", "shared", "distance"), s), s)


@query("SELECT country, count(*) n, count(*) FILTER (role='input') input_n, count(*) FILTER (role='context') context_n FROM @samples GROUP BY 1")
def a09_country_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "samples").groupBy("country").agg(F.count("*").alias("n"), F.count_if(F.col("role") == "input").alias("input_n"), F.count_if(F.col("role") == "context").alias("context_n"))


@query("SELECT country, n, input_n, context_n, round(n::DOUBLE / sum(n) OVER (), 9) share, row_number() OVER (ORDER BY n DESC, country) AS position FROM (SELECT country, count(*) n, count(*) FILTER (role='input') input_n, count(*) FILTER (role='context') context_n FROM @samples GROUP BY 1)")
def a44_country_shares(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.country_shares(view(spark, sf, "samples")), "share")


@query("""WITH n AS (SELECT sample_id, count(*) n_calls FROM @calls GROUP BY 1), s AS (SELECT s.sample_id, st, scheme, coalesce(n_calls, 0) n_calls, s.sample_id % 6 <> 5 AND s.sample_id % 8 = 0 AS malformed FROM @samples s LEFT JOIN n USING (sample_id))
 SELECT sample_id, n_calls > 0 profile_ready, NOT malformed lineage_ready, st IS NOT NULL st_ready, array_to_string([x for x in [CASE WHEN st IS NULL THEN 'missing_st' END, CASE WHEN n_calls = 0 THEN 'missing_profile' END, CASE WHEN scheme = 'unknown' THEN 'missing_scope' END, CASE WHEN malformed THEN 'unresolved_lineage' END] if x IS NOT NULL], ',') reasons,
 st IS NOT NULL AND n_calls > 0 AND scheme <> 'unknown' AND NOT malformed ready FROM s""")
def a10_readiness(spark: SparkSession, sf: str) -> DataFrame:
    s = P.with_calls(view(spark, sf, "samples"), view(spark, sf, "calls"))
    return A.readiness(s.select("sample_id", S.species_key(F.col("species")).alias("species_key"), "st", "n_calls", S.typing_scope(F.col("scheme"), F.col("version"), F.lit("")).alias("scope"), F.size(S.lineage_components(F.col("lineage"))).alias("components")))


@query("SELECT count(*) records, count(*) FILTER (country <> 'unknown') country_known, count(*) FILTER (country = 'unknown') country_unknown, count(*) FILTER (city = '') city_missing, count(*) FILTER (st IS NULL) st_missing, count(DISTINCT country) countries FROM @samples")
def a11_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return A.completeness(view(spark, sf, "samples"))


@query("""WITH p AS (SELECT role, [x for x in string_split(lineage, '_') if regexp_full_match(x, '\\d+')] c FROM @samples WHERE NOT (sample_id % 6 <> 5 AND sample_id % 8 = 0)), l AS (SELECT role, c, unnest([1, 3, 5]) AS level FROM p)
 SELECT level, array_to_string(c[1:level], '_') prefix, count(*) FILTER (role='input') input_n, count(*) FILTER (role='context') context_n FROM l WHERE len(c) >= level GROUP BY 1, 2""")
def a13_level_counts(spark: SparkSession, sf: str) -> DataFrame:
    return A.level_counts(view(spark, sf, "samples").select("role", S.lineage_components(F.col("lineage")).alias("components")), [1, 3, 5])


@query("SELECT st, region, count(*) available, count(*) FILTER (sample_id % 3 = 0) selected FROM @samples GROUP BY 1, 2")
def a14_strata(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples")
    return A.strata(s, s.where("sample_id % 3 = 0").select("sample_id"), ["st", "region"])


@query("SELECT count(balance) n, round(quantile_cont(balance, 0.25), 9) q25, round(quantile_cont(balance, 0.5), 9) q50, round(quantile_cont(balance, 0.9), 9) q90 FROM @samples")
def a15_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.quantiles(view(spark, sf, "samples"), "balance", [0.25, 0.5, 0.9]), "q25", "q50", "q90")


YEARS = "(year(day) + (dayofyear(day) - 1) / CASE WHEN year(day) % 4 = 0 AND (year(day) % 100 <> 0 OR year(day) % 400 = 0) THEN 366.0::DOUBLE ELSE 365.0::DOUBLE END)"


def points(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "points").select("sample_id", D.decimal_year(F.col("day")).alias("x"), F.col("value").alias("y"))


FIT = f"""f AS (SELECT sample_id, count(*) n, count(DISTINCT x) n_x, regr_slope(y, x) b, regr_intercept(y, x) a, avg(y) centre, avg(x) reference, corr(x, y) r, stddev_pop(y) sd FROM (SELECT sample_id, {YEARS} x, value y FROM @points) GROUP BY 1)"""


@query(f"""WITH {FIT} SELECT sample_id, n, n_x, CASE WHEN n >= 3 AND n_x >= 3 THEN 'fitted' ELSE 'insufficient_data' END status, round(CASE WHEN n >= 3 AND n_x >= 3 THEN CASE WHEN sd = 0 THEN 0 ELSE b END END, 4) slope, round(CASE WHEN n >= 3 AND n_x >= 3 THEN centre END, 6) centre, round(CASE WHEN n >= 3 AND n_x >= 3 THEN reference END, 6) reference, round(CASE WHEN n >= 3 AND n_x >= 3 AND sd <> 0 THEN r END, 6) r FROM f""")
def a16_date_regression(spark: SparkSession, sf: str) -> DataFrame:
    found = A.regression(points(spark, sf), "sample_id")
    return found.select("sample_id", "n", "n_x", "status", F.round("slope", 4).alias("slope"), F.round("centre", 6).alias("centre"), F.round("reference", 6).alias("reference"), F.round("r", 6).alias("r"))


@query(f"""WITH {FIT}, e AS (SELECT p.sample_id, y - (CASE WHEN sd = 0 THEN 0 ELSE b END) * x - (CASE WHEN sd = 0 THEN centre ELSE a END) r FROM (SELECT sample_id, {YEARS} x, value y FROM @points) p JOIN f USING (sample_id) WHERE n >= 3 AND n_x >= 3) SELECT sample_id, round(avg(r * r), 4) mse, round(max(abs(r)), 4) worst FROM e GROUP BY 1""")
def a17_residuals(spark: SparkSession, sf: str) -> DataFrame:
    p = points(spark, sf)
    return A.residuals(p, A.regression(p, "sample_id"), "sample_id").select("sample_id", F.round("mse", 4).alias("mse"), F.round("worst", 4).alias("worst"))


@query(f"""WITH {Q.COMPARABLE}, d AS (SELECT sample_id, avg({YEARS}) x FROM @points GROUP BY 1) SELECT count(*) n, round(corr(diff::DOUBLE / shared, abs(p.x - q.x)), 9) r FROM sc JOIN d p ON p.sample_id = a JOIN d q ON q.sample_id = b""")
def a18_distance_date_correlation(spark: SparkSession, sf: str) -> DataFrame:
    mean = points(spark, sf).groupBy("sample_id").agg(F.avg("x").alias("x"))
    found = P.distance_gap_correlation(Q.one_scope(spark, sf), view(spark, sf, "calls"), OVERLAP, mean)
    return found.select("n", R9("r").alias("r"))


@query(f"""WITH {Q.COMPARABLE}, e AS (SELECT a sample_id, diff::DOUBLE / shared v FROM sc UNION ALL SELECT b, diff::DOUBLE / shared FROM sc), m AS (SELECT sample_id, median(v) median FROM e GROUP BY 1), c AS (SELECT median(median) centre FROM m), g AS (SELECT median(abs(median - centre)) mad FROM m, c)
 SELECT sample_id, round(median, 9) median, round(centre, 9) centre, round(CASE WHEN mad > 0 THEN 0.6745 * (median - centre) / mad WHEN median > centre THEN 'Infinity'::DOUBLE ELSE 0 END, 9) robust_z, round(CASE WHEN centre > 0 THEN median / centre WHEN median > 0 THEN 'Infinity'::DOUBLE ELSE 1 END, 9) ratio, (CASE WHEN mad > 0 THEN 0.6745 * (median - centre) / mad WHEN median > centre THEN 'Infinity'::DOUBLE ELSE 0 END) >= 10 AND median >= 5 * centre flagged FROM m, c, g""")
def a19_coherence_screen(spark: SparkSession, sf: str) -> DataFrame:
    each = P.distance_histograms(Q.one_scope(spark, sf), view(spark, sf, "calls"), OVERLAP).withColumnRenamed("distance", "v")
    return rounded(A.screen_counts(each, V.MIN_ROBUST_Z, V.MIN_MEDIAN_RATIO), "median", "centre", "robust_z", "ratio")


@query("""WITH r AS (SELECT id, p, count(*) OVER () n, rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1 rk FROM @windows WHERE p IS NOT NULL), q AS (SELECT id, least(1.0, min(p * n / rk) OVER (ORDER BY p DESC)) q FROM r) SELECT w.id, round(w.p, 9) p, round(q.q, 9) q FROM @windows w LEFT JOIN q USING (id)""")
def a20_false_discovery(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.false_discovery(view(spark, sf, "windows").select("id", "p")), "p", "q")


@query("""WITH t AS (SELECT s_nationkey % 7 AS sample_id, (s_suppkey * 31) % 977 + 1 AS length FROM supplier), r AS (SELECT *, sum(length) OVER (PARTITION BY sample_id ORDER BY length DESC) run, sum(length) OVER (PARTITION BY sample_id) total FROM t) SELECT sample_id, count(*) contigs, max(total)::BIGINT total, max(length) FILTER (run * 2 >= total) n50 FROM r GROUP BY 1""")
def a21_assembly_n50(spark: SparkSession, sf: str) -> DataFrame:
    s = spark.read.parquet(f"{sf}/supplier.parquet")
    return A.assembly_summary(s.select((F.col("s_nationkey") % 7).alias("sample_id"), ((F.col("s_suppkey") * 31) % 977 + 1).alias("length")))


@query("""WITH u AS (SELECT unnest(range(1, length(seq) + 1)) pos, seq FROM @sequences), c AS (SELECT pos, bool_and(substr(seq, pos, 1) IN ('A','C','G','T')) complete, count(DISTINCT substr(seq, pos, 1)) letters FROM u GROUP BY 1) SELECT pos, complete, letters FROM c""")
def a22_complete_sites(spark: SparkSession, sf: str) -> DataFrame:
    bases = sequences(spark, sf).select(F.posexplode(F.split("seq", "")).alias("pos", "base"))
    return bases.groupBy((F.col("pos") + 1).cast("bigint").alias("pos")).agg(F.bool_and(F.col("base").isin("A", "C", "G", "T")).alias("complete"), F.count_distinct("base").alias("letters"))


@query("""WITH b AS (SELECT record, start_at, end_at FROM @windows), bins AS (SELECT k AS bin, k * 500 lo, (k + 1) * 500 hi FROM range(0, (SELECT max(end_at) // 500 + 1 FROM @windows)) t(k)) SELECT bin::BIGINT bin, record, count(*) windows, sum(least(end_at, hi) - greatest(start_at, lo))::BIGINT covered FROM b JOIN bins ON start_at < hi AND end_at > lo GROUP BY 1, 2""")
def a24_binned_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Each window is dealt to the bins it touches; no range join is needed."""
    w = view(spark, sf, "windows").select("record", "start_at", "end_at", F.explode(F.sequence(F.floor(F.col("start_at") / 500), F.floor((F.col("end_at") - 1) / 500))).alias("bin"))
    return w.groupBy("bin", "record").agg(F.count("*").alias("windows"), F.sum(F.least("end_at", (F.col("bin") + 1) * 500) - F.greatest("start_at", F.col("bin") * 500)).alias("covered"))


@query("SELECT count(*) intervals, count(DISTINCT node) branches, max(end_at - start_at) longest, sum(end_at - start_at)::BIGINT total FROM @intervals")
def a25_interval_summary(spark: SparkSession, sf: str) -> DataFrame:
    length = F.col("end_at") - F.col("start_at")
    return view(spark, sf, "intervals").agg(F.count("*").alias("intervals"), F.count_distinct("node").alias("branches"), F.max(length).alias("longest"), F.sum(length).alias("total"))


@query("SELECT record, node, start_at, end_at - start_at AS length FROM @intervals ORDER BY end_at - start_at DESC, record, node, start_at LIMIT 10")
def o03_longest_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "intervals").select("record", "node", "start_at", (F.col("end_at") - F.col("start_at")).alias("length")).orderBy(F.desc("length"), "record", "node", "start_at").limit(10)


@query("SELECT count(*) n, count(*) FILTER (r2 >= 0.5) exceed, round((1 + count(*) FILTER (r2 >= 0.5))::DOUBLE / (1 + count(*)), 9) p FROM (SELECT p AS r2 FROM @windows WHERE p IS NOT NULL)")
def a26_permutation_p(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.permutation_p(view(spark, sf, "windows").where("p is not null").select(F.col("p").alias("r2")), 0.5), "p")


@query("SELECT sample_id, count(estimate) n, min(estimate) least, median(estimate) middle, max(estimate) most, max(estimate) - min(estimate) AS range FROM @runs GROUP BY 1")
def a29_sensitivity_spread(spark: SparkSession, sf: str) -> DataFrame:
    return A.spread(view(spark, sf, "runs"), "sample_id", "estimate")


@query("""WITH t AS (SELECT sample_id, run, estimate FROM @runs WHERE role = 'input'), x AS (SELECT a.sample_id a, b.sample_id b, a.run, CASE WHEN (a.run + a.sample_id) % 3 = 0 THEN NULL ELSE a.estimate % 3 = b.estimate % 3 END together FROM t a JOIN t b ON a.run = b.run AND a.sample_id < b.sample_id)
 SELECT a, b, count(together) callable_runs, count(*) FILTER (together) together_runs, round(count(*) FILTER (together)::DOUBLE / nullif(count(together), 0), 9) share FROM x GROUP BY 1, 2""")
def a30_coclustering_agreement(spark: SparkSession, sf: str) -> DataFrame:
    t = view(spark, sf, "runs").where("role = 'input'")
    own = t.groupBy("sample_id").agg(F.collect_list(F.struct("run", "estimate")).alias("runs"))
    pairs = P.tiled(own).select(F.col("p.sample_id").alias("a"), F.col("q.sample_id").alias("b"), F.col("p.runs").alias("x"), F.col("q.runs").alias("y"))
    tell = lambda r, s: F.when((r["run"] + F.col("a")) % 3 != 0, r["estimate"] % 3 == s["estimate"] % 3)
    together = F.flatten(F.transform("x", lambda r: F.transform(F.filter("y", lambda s: s["run"] == r["run"]), lambda s: tell(r, s))))
    return rounded(A.agreement_of(pairs, together), "share")


@query("""WITH f AS (SELECT sample_id, min(run) run FROM @runs GROUP BY 1), n AS (SELECT run, count(*) new FROM f GROUP BY 1), s AS (SELECT run, count(DISTINCT sample_id) size FROM @runs GROUP BY 1) SELECT run, size, coalesce(new, 0) AS "new", sum(coalesce(new, 0)) OVER (ORDER BY run)::BIGINT seen FROM s LEFT JOIN n USING (run)""")
def a32_selection_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return A.cumulative_coverage(view(spark, sf, "runs").select("run", "sample_id"))


@query("""WITH m AS (SELECT DISTINCT run, sample_id FROM @runs), s AS (SELECT run, count(*) n FROM m GROUP BY 1), c AS (SELECT a.run ra, b.run rb, count(*) common FROM m a JOIN m b ON a.sample_id = b.sample_id AND a.run < b.run GROUP BY 1, 2)
 SELECT x.run run_a, y.run run_b, coalesce(common, 0) common, x.n + y.n - coalesce(common, 0) AS either, round(coalesce(common, 0)::DOUBLE / (x.n + y.n - coalesce(common, 0)), 9) jaccard FROM s x JOIN s y ON x.run < y.run LEFT JOIN c ON ra = x.run AND rb = y.run""")
def j20_selection_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.selection_overlap(view(spark, sf, "runs").select("run", "sample_id")), "jaccard")


@query("""WITH m AS (SELECT record, start_at, end_at, max(end_at) OVER (PARTITION BY record ORDER BY start_at, end_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) e FROM @intervals), g AS (SELECT *, sum(CASE WHEN e IS NULL OR start_at > e THEN 1 ELSE 0 END) OVER (PARTITION BY record ORDER BY start_at, end_at ROWS UNBOUNDED PRECEDING) i FROM m) SELECT record, min(start_at) start_at, max(end_at) end_at, count(*) parts FROM g GROUP BY record, i""")
def w06_merged_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return A.merged_intervals(view(spark, sf, "intervals").select("record", "start_at", "end_at"), "record", "start_at", "end_at")


@query("""WITH r AS (SELECT record, max(end_at) AS size FROM @intervals GROUP BY 1), s AS (SELECT record, size, least(300, size) AS width, unnest(list_distinct(list_append(range(0, size - least(300, size) + 1, 120), size - least(300, size)))) start_at FROM r) SELECT record, start_at, width, start_at + width end_at FROM s""")
def w07_sliding_windows(spark: SparkSession, sf: str) -> DataFrame:
    return A.sliding(view(spark, sf, "intervals").groupBy("record").agg(F.max("end_at").alias("size")), 300, 120)


@query("""WITH p AS (SELECT record, start_at, end_at, coalesce(lag(end_at) OVER w, 0) l, lead(start_at) OVER w n FROM @windows WINDOW w AS (PARTITION BY record ORDER BY start_at, end_at)) SELECT record, start_at, end_at, CASE WHEN start_at > l THEN 'gap' WHEN start_at < l THEN 'overlap' WHEN n IS NULL AND end_at <> 5120 THEN 'end' END kind FROM p WHERE start_at <> l OR (n IS NULL AND end_at <> 5120)""")
def w08_exact_cover(spark: SparkSession, sf: str) -> DataFrame:
    return A.cover_gaps(view(spark, sf, "windows").select("record", "start_at", "end_at"), "record", "start_at", "end_at", F.lit(5120))


@query("""SELECT i.node id_a, w.id id_b, i.record, greatest(i.start_at, w.start_at) start_at, least(i.end_at, w.end_at) end_at, i.start_at < w.start_at OR i.end_at > w.end_at crosses FROM @intervals i JOIN @windows w ON i.record = w.record AND i.start_at < w.end_at AND w.start_at < i.end_at""")
def j16_interval_overlap(spark: SparkSession, sf: str) -> DataFrame:
    a = view(spark, sf, "intervals").select(F.col("node").alias("id_a"), "record", F.col("start_at").alias("start_a"), F.col("end_at").alias("end_a"))
    b = view(spark, sf, "windows").select(F.col("id").alias("id_b"), "record", F.col("start_at").alias("start_b"), F.col("end_at").alias("end_b"))
    return A.overlapping(a, b, 256)


@query("""WITH bins AS (SELECT k AS bin FROM range(0, (SELECT max(end_at)::BIGINT // 100 + 1 FROM @intervals)) t(k)) SELECT bin::BIGINT bin, count(DISTINCT node) branches, count(*) intervals FROM @intervals JOIN bins ON start_at < (bin + 1) * 100 AND end_at > bin * 100 GROUP BY 1""")
def j17_bin_branches(spark: SparkSession, sf: str) -> DataFrame:
    binned = view(spark, sf, "intervals").select("node", F.explode(F.sequence(F.floor(F.col("start_at") / 100), F.floor((F.col("end_at") - 1) / 100))).alias("bin"))
    return binned.groupBy("bin").agg(F.count_distinct("node").alias("branches"), F.count("*").alias("intervals"))


@query("""WITH s AS (SELECT record, max(end_at) AS size FROM @intervals GROUP BY 1) SELECT record, size, coalesce(sum(size) OVER (ORDER BY record ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT begins FROM s""")
def w10_cumulative_bounds(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    sizes = view(spark, sf, "intervals").groupBy("record").agg(F.max("end_at").alias("size"))
    return sizes.withColumn("begins", F.coalesce(F.sum("size").over(Window.orderBy("record").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


@query("""WITH u AS (SELECT DISTINCT year(day) y FROM @points UNION SELECT 2000), t AS (SELECT y, row_number() OVER (ORDER BY y DESC) i FROM (SELECT DISTINCT year(o_orderdate) y FROM orders)) SELECT t.y::BIGINT test_year, count(*) FILTER (year(o_orderdate) < t.y) train, count(*) FILTER (year(o_orderdate) = t.y) test FROM t, orders WHERE i <= 3 GROUP BY 1""".replace("u AS (SELECT DISTINCT year(day) y FROM @points UNION SELECT 2000), ", ""))
def w09_date_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Folds that test on each of the latest three years and train on all before; counts come from a table of years."""
    from pyspark.sql import Window

    years = spark.read.parquet(f"{sf}/orders.parquet").groupBy(F.year("o_orderdate").cast("bigint").alias("test_year")).agg(F.count("*").alias("test"))
    w = Window.orderBy("test_year").rowsBetween(Window.unboundedPreceding, -1)
    return years.withColumn("train", F.coalesce(F.sum("test").over(w), F.lit(0))).withColumn("_i", F.row_number().over(Window.orderBy(F.desc("test_year")))).where("_i <= 3").select("test_year", "train", "test")


@query("""WITH p AS (SELECT sample_id % 7 AS g, unnest(range(1, 6)) pos, string_split(lineage, '_') c FROM @samples), d AS (SELECT g, pos, count(DISTINCT c[pos]) n, min(c[pos]) v FROM p GROUP BY 1, 2), f AS (SELECT g, pos, v, min(CASE WHEN n > 1 THEN pos END) OVER (PARTITION BY g) cut FROM d) SELECT g, coalesce(string_agg(v, '_' ORDER BY pos) FILTER (cut IS NULL OR pos < cut), '') prefix FROM f GROUP BY 1""")
def a34_common_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """The leading components in which all codes of a group agree."""
    parts = view(spark, sf, "samples").select((F.col("sample_id") % 7).alias("g"), F.posexplode(F.split("lineage", "_")).alias("pos", "v"))
    each = parts.groupBy("g", "pos").agg(F.count_distinct("v").alias("n"), F.min("v").alias("v"))
    cut = each.groupBy("g").agg(F.min(F.when(F.col("n") > 1, F.col("pos"))).alias("cut"), F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("all"))
    return cut.select("g", F.concat_ws("_", F.transform(F.filter("all", lambda x: F.col("cut").isNull() | (x["pos"] < F.col("cut"))), lambda x: x["v"])).alias("prefix"))


@query("""SELECT s.version, count(DISTINCT c.locus) loci, min(c.locus) first_locus, count(DISTINCT c.sample_id) samples FROM @samples s JOIN @calls c ON c.sample_id = s.sample_id GROUP BY 1""")
def a35_locus_universe(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "samples").select("sample_id", "version").join(view(spark, sf, "calls"), "sample_id").groupBy("version").agg(F.count_distinct("locus").alias("loci"), F.min("locus").alias("first_locus"), F.count_distinct("sample_id").alias("samples"))


@query("""WITH n AS (SELECT count(DISTINCT sample_id) n FROM @dense_calls), panel AS (SELECT locus FROM @dense_calls, n GROUP BY locus, n HAVING count(*) = n), k AS (SELECT * FROM @dense_calls JOIN panel USING (locus))
 SELECT a.sample_id a, b.sample_id b, round(avg(CASE WHEN a.allele <> b.allele THEN 1.0::DOUBLE ELSE 0 END), 9) fraction FROM k a JOIN k b ON a.locus = b.locus AND a.sample_id < b.sample_id GROUP BY 1, 2""")
def a36_fixed_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Mismatch fractions over the loci that every sample has."""
    calls = view(spark, sf, "dense_calls")
    n = calls.agg(F.count_distinct("sample_id").alias("n"))  # one row
    panel = calls.groupBy("locus").agg(F.count("*").alias("c")).join(F.broadcast(n), F.col("c") == F.col("n"), "left_semi")
    k = calls.join(panel, "locus", "left_semi")
    # Panel loci are called in every sample, so the calls that two samples share are the panel.
    return P.packed_pairs(k, 0.0, 1).select("a", "b", R9("distance").alias("fraction"))


@query("SELECT country, count(*) n, ceil(count(*) / 100.0)::BIGINT batches, (count(*) * (count(*) - 1) / 2)::BIGINT pairs, 8 * count(*) * count(*) bytes FROM @samples GROUP BY 1")
def a37_plan_cost(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n")
    return view(spark, sf, "samples").groupBy("country").agg(F.count("*").alias("n")).select("country", "n", F.ceil(n / 100.0).cast("bigint").alias("batches"), (n * (n - 1) / 2).cast("bigint").alias("pairs"), (8 * n * n).alias("bytes"))


@query("""SELECT stage, n FROM (SELECT 1 i, 'records' stage, count(*) n FROM @samples UNION ALL SELECT 2, 'with_st', count(*) FROM samples WHERE st IS NOT NULL UNION ALL SELECT 3, 'with_scope', count(*) FROM samples WHERE st IS NOT NULL AND scheme <> 'unknown' UNION ALL SELECT 4, 'context', count(*) FROM samples WHERE st IS NOT NULL AND scheme <> 'unknown' AND role = 'context')""")
def a43_context_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """Each stage's number from a single pass."""
    a, b, c = F.col("st").isNotNull(), F.col("scheme") != "unknown", F.col("role") == "context"
    return view(spark, sf, "samples").agg(F.count("*").alias("records"), F.count_if(a).alias("with_st"), F.count_if(a & b).alias("with_scope"), F.count_if(a & b & c).alias("context")).unpivot([], ["records", "with_st", "with_scope", "context"], "stage", "n")
