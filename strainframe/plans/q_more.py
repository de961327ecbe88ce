"""Queries over the remaining rules: annotation by kind, ordered selections, set operations, filters and calibrations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import alignment as M
from ..operators import identity as I
from ..operators import trees as T
from . import q_trees as Q
from .q_aggregates import points, rounded
from .q_identity import END, PRECISION, START
from .registry import query
from .views import sequences, view

c = F.col


@query("""WITH g AS (SELECT sample_id, [x for x in string_split(lineage, '_') if regexp_full_match(x, '[0-9]+')] n, sample_id % 6 <> 5 AND sample_id % 8 = 0 bad, sample_id % 7 = 2 prov FROM @samples), k AS (SELECT *, unnest([3, 4, 5]) d FROM g)
 SELECT sample_id, d AS depth, CASE WHEN bad THEN 'malformed' WHEN prov THEN 'provisional' WHEN len(n) >= d THEN 'assigned' ELSE 'partial' END status, CASE WHEN NOT bad AND NOT prov AND len(n) >= d THEN array_to_string(n[1:d], '_') ELSE '' END prefix FROM k""")
def f09_f10_lineage_depths(spark: SparkSession, sf: str) -> DataFrame:
    """Groups at three depths; provisional codes need consensus evidence and stay open without it."""
    parts = S.lineage_components(c("lineage"))
    rows = view(spark, sf, "samples").select("sample_id", S.lineage_status(c("lineage")).alias("state"), parts.alias("parts"), (c("sample_id") % 7 == 2).alias("provisional"), F.explode(F.array(F.lit(3), F.lit(4), F.lit(5))).alias("depth"))
    status = F.when(c("state") == "malformed", "malformed").when(c("provisional"), "provisional").when(F.size("parts") >= c("depth"), "assigned").otherwise("partial")
    return rows.select("sample_id", "depth", status.alias("status"), F.when(status == "assigned", F.concat_ws("_", F.transform(F.slice("parts", F.lit(1), c("depth")), lambda x: x.cast("string")))).otherwise("").alias("prefix"))


@query("SELECT id, raw, regexp_full_match(raw, '\\d{4}(-\\d{2}(-\\d{2})?)?') AND (CASE length(raw) WHEN 4 THEN try_cast(raw || '-01-01' AS DATE) WHEN 7 THEN try_cast(raw || '-01' AS DATE) ELSE try_cast(raw AS DATE) END) IS NOT NULL valid FROM @dates")
def f22_study_dates(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "dates").select("id", "raw", (~c("raw").contains("/") & D.bounds_start(c("raw")).isNotNull()).alias("valid"))


@query("SELECT sample_id, lower(CASE WHEN st IS NULL THEN 'none' ELSE st || '-' || region END) slug, st IS NOT NULL AND false numeric FROM @samples".replace("lower(CASE WHEN st IS NULL THEN 'none' ELSE st || '-' || region END)", "trim(regexp_replace(lower(coalesce(st, 'none') || ' / ' || region), '[^a-z0-9]+', '-', 'g'), '-')").replace("st IS NOT NULL AND false", "regexp_full_match(coalesce(st, ''), '[0-9]+')"))
def f29_f33_slugs(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "samples").select("sample_id", S.slug(F.concat(F.coalesce("st", F.lit("none")), F.lit(" / "), c("region"))).alias("slug"), S.is_number(c("st")).alias("numeric"))


@query("""WITH k AS (SELECT s_suppkey id, unnest(['cgmlst', 'hiercc', 'cglin']) kind, s_suppkey, s_nationkey FROM supplier), a AS (SELECT id, kind, s_nationkey % 4 || '' code FROM k WHERE (id + length(kind)) % 3 <> 0 UNION ALL SELECT id, kind, '9' FROM k WHERE id % 10 = 0 AND kind = 'hiercc')
 SELECT k.id, k.kind, count(code) matches, CASE count(DISTINCT code) WHEN 0 THEN 'missing' WHEN 1 THEN 'assigned' ELSE 'conflict' END status, CASE WHEN count(DISTINCT code) = 1 THEN min(code) END code FROM k LEFT JOIN a ON a.id = k.id AND a.kind = k.kind GROUP BY 1, 2""")
def j07_typing_by_kind(spark: SparkSession, sf: str) -> DataFrame:
    """Three kinds of typing, each with its own conflicts."""
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(c("s_suppkey").alias("id"), c("s_nationkey").alias("n"))
    out = None
    for kind in ("cgmlst", "hiercc", "cglin"):
        given = s.where((c("id") + len(kind)) % 3 != 0).select(c("id").alias("src"), (c("n") % 4).cast("string").alias("code"))
        if kind == "hiercc":
            given = given.unionByName(s.where("id % 10 = 0").select(c("id").alias("src"), F.lit("9").alias("code")))
        one = I.annotate(s.select("id"), F.array("id"), given, "src", c("code"), "code").withColumn("kind", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    return out


@query("""WITH w AS (SELECT unnest([30, 7, 7, 99, 12345, 2]) sample_id, unnest(range(0, 6)) ordinal) SELECT ordinal, w.sample_id, country, s.sample_id IS NOT NULL found FROM w LEFT JOIN @samples s USING (sample_id)""")
def j19_ordered_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Chosen ids with their rows, in the order and number asked."""
    asked = spark.sql("select posexplode(array(30L, 7L, 7L, 99L, 12345L, 2L)) as (ordinal, sample_id)")
    return asked.join(view(spark, sf, "samples").select("sample_id", "country", F.lit(True).alias("f")), "sample_id", "left").select(c("ordinal").cast("bigint").alias("ordinal"), "sample_id", "country", c("f").isNotNull().alias("found"))


@query("""WITH a AS (SELECT sample_id, 'input' pool FROM @samples WHERE role = 'input'), b AS (SELECT sample_id FROM @samples WHERE sample_id % 4 = 0) SELECT 'union' AS kind, count(*) n FROM (SELECT sample_id FROM a UNION SELECT sample_id FROM b) UNION ALL SELECT 'common', count(*) FROM (SELECT sample_id FROM a INTERSECT SELECT sample_id FROM b) UNION ALL SELECT 'first_only', count(*) FROM (SELECT sample_id FROM a EXCEPT SELECT sample_id FROM b) UNION ALL SELECT 'appended', (SELECT count(*) FROM a) + (SELECT count(*) FROM b)""")
def u02_u05_set_operations(spark: SparkSession, sf: str) -> DataFrame:
    """All four counts from one pass over memberships."""
    s = view(spark, sf, "samples")
    both = s.where("role = 'input'").select("sample_id", F.lit(1).alias("x"), F.lit(0).alias("y")).unionByName(s.where("sample_id % 4 = 0").select("sample_id", F.lit(0).alias("x"), F.lit(1).alias("y")))
    per = both.groupBy("sample_id").agg(F.max("x").alias("x"), F.max("y").alias("y"), F.count("*").alias("n"))
    return per.agg(F.count("*").alias("union"), F.count_if((c("x") == 1) & (c("y") == 1)).alias("common"), F.count_if(c("y") == 0).alias("first_only"), F.coalesce(F.sum("n"), F.lit(0)).alias("appended")).unpivot([], ["union", "common", "first_only", "appended"], "kind", "n")


@query(f"""WITH b AS (SELECT id, raw, {START} s, {END} e FROM @dates), k AS (SELECT *, {PRECISION} p FROM b) SELECT id, raw, 'future_collection_date' reason FROM k WHERE p NOT IN ('missing', 'invalid') AND s > DATE '1999-06-30'""")
def v08_future_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates and intervals that begin after the middle of 1999."""
    found = view(spark, sf, "dates").select("id", "raw", D.canonical(c("raw"), today="1999-06-30")["status"].alias("s"))
    return found.where("s = 'future'").select("id", "raw", F.lit("future_collection_date").alias("reason"))


@query("SELECT sample_id, count(*) AS loci, list_sort(list(locus)) = list(locus ORDER BY locus) ordered, count(*) = 25 complete FROM @calls GROUP BY 1")
def v15_locus_order(spark: SparkSession, sf: str) -> DataFrame:
    loci = F.sort_array(F.collect_list("locus"))
    return view(spark, sf, "calls").groupBy("sample_id").agg(F.count("*").alias("loci"), loci.alias("l")).select("sample_id", "loci", (c("l") == F.array_sort("l")).alias("ordered"), (c("loci") == 25).alias("complete"))


@query("""WITH s AS (SELECT sample_id % 3 AS alignment, sample_id AS ordinal, seq FROM @sequences), u AS (SELECT alignment, ordinal, unnest(range(1, 65)) pos, seq FROM s) SELECT alignment, pos, bool_or(substr(seq, pos, 1) = 'N') strict FROM u GROUP BY 1, 2""")
def a23_strict_mask(spark: SparkSession, sf: str) -> DataFrame:
    return ordered(spark, sf).select("alignment", "pos", "strict")


def ordered(spark: SparkSession, sf: str) -> DataFrame:
    return M.ordered_mask(sequences(spark, sf).select((c("sample_id") % 3).alias("alignment"), c("sample_id").alias("ordinal"), "seq"))


@query()
def a23_ordered_mask(spark: SparkSession, sf: str) -> DataFrame:
    return M.retained(ordered(spark, sf))


@query()
def t14_network(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of changes between regions with the nearest connections between the same regions."""
    changes = Q.histories(spark, sf, c("region")).where("kind = 'change'").select("source", "target", "least", "most")
    s = view(spark, sf, "samples").select("sample_id", "role", c("region").alias("country"))
    from ..operators import pairs as P
    from . import q_pairs

    near = A.connections(P.nearest_with_ties(q_pairs.near(spark, sf, 1).select("a", "b", "diff", "shared", "distance"), s), s).select("source", "target", "comparison_count")
    return changes.join(near, ["source", "target"], "full_outer").select("source", "target", "least", "most", F.coalesce("comparison_count", F.lit(0)).alias("comparisons"))


@query()
def t20_group_calibration(spark: SparkSession, sf: str) -> DataFrame:
    """Rates of each cohort's best-rooted tree as changes a year over 25 loci, and two threshold scenarios."""
    t = Q.clocks(spark, sf)
    roots = T.clock_roots(t, Q.tip_years(spark, sf, t)).where("status = 'rooted'")
    rate = c("slope") * 25
    return roots.select("tree", rate.alias("rate"), "r2", *((2 * rate * h).alias(f"changes_{h}_years") for h in (5, 10)))


@query("SELECT sample_id, round(slope * 25, 4) slope_loci FROM (SELECT sample_id, count(*) n, count(DISTINCT x) k, regr_slope(y, x) slope FROM (SELECT sample_id, year(day) + (dayofyear(day) - 1) / CASE WHEN year(day) % 4 = 0 THEN 366.0::DOUBLE ELSE 365.0::DOUBLE END x, value y FROM @points) GROUP BY 1) WHERE n >= 3 AND k >= 3")
def f37_rescaled_fit(spark: SparkSession, sf: str) -> DataFrame:
    """A fit in changes over 25 loci."""
    fit = A.regression(points(spark, sf), "sample_id").where("status = 'fitted'")
    return fit.select("sample_id", F.round(c("slope") * 25, 4).alias("slope_loci"))


@query("SELECT record, id, rank() OVER (PARTITION BY record ORDER BY p) AS place FROM @windows WHERE p IS NOT NULL")
def w01_ranks(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "windows").where("p is not null").select("record", "id", F.rank().over(Window.partitionBy("record").orderBy("p")).cast("bigint").alias("place"))


@query("SELECT country, n, round(sum(n) OVER (ORDER BY n DESC, country ROWS UNBOUNDED PRECEDING)::DOUBLE / sum(n) OVER (), 9) upto FROM (SELECT country, count(*) n FROM @samples GROUP BY 1)")
def w04_cumulative_share(spark: SparkSession, sf: str) -> DataFrame:
    n = view(spark, sf, "samples").groupBy("country").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("t"))  # one row
    run = n.withColumn("u", F.sum("n").over(Window.orderBy(F.desc("n"), "country").rowsBetween(Window.unboundedPreceding, 0)))
    return rounded(run.join(F.broadcast(total)).select("country", "n", (c("u") / c("t")).alias("upto")), "upto")


