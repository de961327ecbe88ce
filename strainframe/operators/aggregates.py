"""Aggregates over samples, dates, places, networks and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import running


def geography_cube(samples: DataFrame) -> DataFrame:
    """Numbers of samples by role, country, region and city; blanks count as Unknown."""
    named = [F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) == "", "Unknown").otherwise(F.trim(F.col(c))).alias(c) for c in ("country", "region", "city")]
    return samples.select("role", *named).groupBy("role", "country", "region", "city").agg(F.count("*").alias("n"))


def geography_rollup(samples: DataFrame) -> DataFrame:
    """Country totals and (country, region, city) details, split by role; ``level`` tells them apart."""
    sides = [F.count_if(F.col("role") == r).alias(f"{r}_n") for r in ("input", "context")]
    total = samples.groupBy("country").agg(F.count("*").alias("n"), *sides).select(F.lit("country").alias("level"), "country", F.lit("").alias("region"), F.lit("").alias("city"), "n", "input_n", "context_n")
    detail = samples.groupBy("country", "region", "city").agg(F.count("*").alias("n"), *sides).select(F.lit("place").alias("level"), "country", "region", "city", "n", "input_n", "context_n")
    return total.unionByName(detail)


def composition(samples: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value, role, n) with missing values as Missing, and the share that is reported for each field."""
    long = samples.select("role", *fields).unpivot(["role"], fields, "field", "value")
    counts = long.groupBy("field", F.coalesce("value", F.lit("Missing")).alias("value")).agg(F.count_if(F.col("role") == "input").alias("input_n"), F.count_if(F.col("role") == "context").alias("context_n"))
    reported = long.groupBy("field").agg(F.count("value").alias("reported"), F.count("*").alias("total"))
    return counts.join(reported, "field")


def persistence(dated: DataFrame, group: str) -> DataFrame:
    """Distinct years, their span, and dated and total records of each group (columns: group, year)."""
    return dated.groupBy(group).agg(F.concat_ws(",", F.transform(F.sort_array(F.collect_set("year")), lambda y: y.cast("string"))).alias("years"), F.count_distinct("year").alias("year_count"), (F.max("year") - F.min("year")).cast("bigint").alias("year_span"), F.count("year").alias("dated"), F.count("*").alias("total"))


def concentration(rows: DataFrame, group: str) -> DataFrame:
    """The largest share of one place and year among the annotated records of each group (columns: group, place, year)."""
    cells = rows.where("place is not null and year is not null").groupBy(group, "place", "year").agg(F.count("*").alias("n"))
    return cells.groupBy(group).agg(F.sum("n").alias("annotated"), F.count("*").alias("cells"), (F.max("n") / F.sum("n")).alias("largest_fraction"))


def at_a_glance(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Each group's values as text, most frequent first, with its period."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col(value).alias("v"), "n")))
    text = counts.groupBy(group).agg(F.concat_ws(", ", F.transform(listed, lambda x: F.concat(x["v"], F.lit(" ("), x["n"].cast("string"), F.lit(")")))).alias("composition"))
    period = rows.groupBy(group).agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count("*").alias("records"))
    return period.join(text, group, "left")


def connections(nearest: DataFrame, countries: DataFrame) -> DataFrame:
    """Numbers of queries, contexts and comparisons between countries, with the extremes of what was compared; each (query, context) once."""
    c = countries.select("sample_id", F.coalesce("country", F.lit("Unknown")).alias("country"))
    once = nearest.where("context_id is not null").groupBy("query_id", "context_id").agg(F.min("diff").alias("diff"), F.min("shared").alias("shared"))
    named = once.join(c.select(F.col("sample_id").alias("query_id"), F.col("country").alias("source")), "query_id").join(c.select(F.col("sample_id").alias("context_id"), F.col("country").alias("target")), "context_id", "left")
    return named.groupBy("source", F.coalesce("target", F.lit("Unknown")).alias("target")).agg(F.count_distinct("query_id").alias("query_count"), F.count_distinct("context_id").alias("context_count"), F.count("*").alias("comparison_count"), F.min("diff").alias("mismatches_min"), F.max("diff").alias("mismatches_max"), F.min("shared").alias("shared_min"), F.max("shared").alias("shared_max"))


def country_shares(samples: DataFrame) -> DataFrame:
    """Countries with their numbers, share and place in the order (most first, then by name)."""
    n = samples.groupBy("country").agg(F.count("*").alias("n"), F.count_if(F.col("role") == "input").alias("input_n"), F.count_if(F.col("role") == "context").alias("context_n"))
    total = n.agg(F.sum("n").alias("total"))  # one row
    return n.join(F.broadcast(total)).select("country", "n", "input_n", "context_n", (F.col("n") / F.col("total")).alias("share"), F.row_number().over(Window.orderBy(F.desc("n"), "country")).cast("bigint").alias("position"))


def readiness(samples: DataFrame) -> DataFrame:
    """What each sample has, and the reasons why it is not ready, as one text."""
    checks = [("missing_species", F.col("species_key") == ""), ("missing_st", F.col("st").isNull()), ("missing_profile", F.col("n_calls") == 0), ("missing_scope", F.col("scope").isNull()), ("unresolved_lineage", F.col("components") == 0)]
    why = F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in checks)))
    return samples.select("sample_id", (F.col("n_calls") > 0).alias("profile_ready"), (F.col("components") > 0).alias("lineage_ready"), F.col("st").isNotNull().alias("st_ready"), F.concat_ws(",", why).alias("reasons"), (F.size(why) == 0).alias("ready"))


def completeness(samples: DataFrame) -> DataFrame:
    """One row of counts of known, unknown and conflicting values."""
    known = ~F.lower(F.coalesce("country", F.lit(""))).isin("", "unknown")
    return samples.agg(F.count("*").alias("records"), F.count_if(known).alias("country_known"), F.count_if(~known).alias("country_unknown"), F.count_if(F.coalesce(F.col("city"), F.lit("")) == "").alias("city_missing"), F.count_if(F.col("st").isNull()).alias("st_missing"), F.count_distinct("country").alias("countries"))


def level_counts(codes: DataFrame, levels: list[int]) -> DataFrame:
    """Samples of each lineage prefix at each level that the code reaches, by role (columns: role, components)."""
    each = codes.select("role", F.explode(F.array(*(F.struct(F.lit(k).alias("level"), F.when(F.size("components") >= k, F.concat_ws("_", F.transform(F.slice("components", 1, k), lambda x: x.cast("string")))).alias("prefix")) for k in levels))).alias("p"))
    return each.where("p.prefix is not null").groupBy("p.level", "p.prefix").agg(F.count_if(F.col("role") == "input").alias("input_n"), F.count_if(F.col("role") == "context").alias("context_n"))


def strata(rows: DataFrame, chosen: DataFrame, cells: list[str]) -> DataFrame:
    """(cells, available, selected)."""
    picked = chosen.select("sample_id", F.lit(1).alias("_picked")).distinct()
    return rows.join(picked, "sample_id", "left").groupBy(*cells).agg(F.count("*").alias("available"), F.count("_picked").alias("selected"))


def quantiles(rows: DataFrame, value: str, at: list[float]) -> DataFrame:
    """Linear quantiles of one column, one row."""
    return rows.agg(F.count(value).alias("n"), *(F.percentile(F.col(value), p).alias(f"q{int(p * 100)}") for p in at))


def screen(pairs: DataFrame, value: str, least_z: float, least_ratio: float) -> DataFrame:
    """Samples whose median distance stands far out of the cohort's: robust z and ratio must both reach their limits.

    With no spread, z is infinite above the centre and 0 else; with a centre of 0 the ratio is infinite above it and 1 else.
    """
    each = pairs.select(F.col("a").alias("sample_id"), F.col(value).alias("v")).unionByName(pairs.select(F.col("b").alias("sample_id"), F.col(value).alias("v"))).where("v is not null")
    return screen_counts(each.withColumn("n", F.lit(1)), least_z, least_ratio)


def screen_counts(each: DataFrame, least_z: float, least_ratio: float) -> DataFrame:
    """``screen`` of how many (n) distances v each sample has (sample_id, v, n)."""
    med = each.groupBy("sample_id").agg(F.percentile("v", 0.5, F.col("n")).alias("median"))
    centre = med.agg(F.median("median").alias("centre"))  # one row
    gap = med.join(F.broadcast(centre))
    mad = gap.agg(F.median(F.abs(F.col("median") - F.col("centre"))).alias("mad"))  # one row
    infinite = F.lit(float("inf"))
    z = F.when(F.col("mad") > 0, 0.6745 * (F.col("median") - F.col("centre")) / F.nullif(F.col("mad"), F.lit(0.0))).when(F.col("median") > F.col("centre"), infinite).otherwise(0.0)
    ratio = F.when(F.col("centre") > 0, F.col("median") / F.nullif(F.col("centre"), F.lit(0.0))).when(F.col("median") > 0, infinite).otherwise(1.0)
    return gap.join(F.broadcast(mad)).select("sample_id", "median", "centre", z.alias("robust_z"), ratio.alias("ratio"), ((z >= least_z) & (ratio >= least_ratio)).alias("flagged"))


def false_discovery(tests: DataFrame, p: str = "p") -> DataFrame:
    """``tests`` with Benjamini-Hochberg q; null p stays null.

    Ranks come from counts of equal p-values, and both running totals from ranges of them.
    """
    levels = tests.where(F.col(p).isNotNull()).groupBy(p).agg(F.count("*").alias("_n"))
    total = levels.agg(F.sum("_n").alias("_total"))  # one row
    upto = running(levels, [p], "_rank", total="_n").join(F.broadcast(total))
    q = running(upto, [F.desc(p)], "_least", least=F.col(p) * F.col("_total") / F.col("_rank"))
    return tests.join(q.select(F.col(p).alias("_p"), F.least(F.lit(1.0), "_least").alias("q")), F.col(p) == F.col("_p"), "left").drop("_p")


def merged_intervals(rows: DataFrame, record: str, start: str, end: str) -> DataFrame:
    """Intervals of a record that touch or overlap become one."""
    w = Window.partitionBy(record).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("_before", before).withColumn("_new", F.when(F.col("_before").isNull() | (F.col(start) > F.col("_before")), 1).otherwise(0))
    return marked.withColumn("_island", F.sum("_new").over(w)).groupBy(record, "_island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("parts")).drop("_island")


def overlapping(a: DataFrame, b: DataFrame, width: int) -> DataFrame:
    """Pairs of a (id_a, record, start_a, end_a) and b (id_b, record, start_b, end_b) that overlap, with the common part.

    Both sides are dealt to bins of ``width``, so the join is by record and bin;
    a pair counts in the bin where its common part begins.
    """
    binned = lambda d, s, e: d.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(s) / width), F.floor((F.col(e) - 1) / width))))
    low, high = F.greatest("start_a", "start_b"), F.least("end_a", "end_b")
    return binned(a, "start_a", "end_a").join(binned(b, "start_b", "end_b"), ["record", "_bin"]).where(low < high).where(F.floor(low / width) == F.col("_bin")).select("id_a", "id_b", "record", low.alias("start_at"), high.alias("end_at"), ((F.col("start_a") < F.col("start_b")) | (F.col("end_a") > F.col("end_b"))).alias("crosses"))


def sliding(records: DataFrame, width: int, step: int) -> DataFrame:
    """Windows of each record (record, size): every ``step``, the last one flush with the end; none beyond it."""
    own = F.least(F.lit(width).cast("bigint"), F.col("size"))
    last = F.col("size") - own
    starts = F.array_union(F.sequence(F.lit(0).cast("bigint"), last, F.lit(step).cast("bigint")), F.array(last))
    return records.select("record", F.explode(starts).alias("start_at"), own.alias("width")).withColumn("end_at", F.col("start_at") + F.col("width"))


def cover_gaps(parts: DataFrame, record: str, start: str, end: str, size: Column) -> DataFrame:
    """Where a record's parts fail to cover it exactly: kind gap, overlap, or end."""
    w = Window.partitionBy(record).orderBy(start, end)
    seen = parts.withColumn("_last", F.coalesce(F.lag(end).over(w), F.lit(0))).withColumn("_next", F.lead(start).over(w))
    kind = F.when(F.col(start) > F.col("_last"), "gap").when(F.col(start) < F.col("_last"), "overlap").when(F.col("_next").isNull() & (F.col(end) != size), "end")
    return seen.withColumn("kind", kind).where("kind is not null").select(record, start, end, "kind")


def assembly_summary(contigs: DataFrame) -> DataFrame:
    """(sample_id, contigs, total, n50) of contig lengths (sample_id, length)."""
    w = Window.partitionBy("sample_id").orderBy(F.desc("length"))
    run = contigs.withColumn("_run", F.sum("length").over(w.rangeBetween(Window.unboundedPreceding, 0))).withColumn("_total", F.sum("length").over(Window.partitionBy("sample_id")))
    return run.groupBy("sample_id").agg(F.count("*").alias("contigs"), F.max("_total").alias("total"), F.max(F.when(F.col("_run") * 2 >= F.col("_total"), F.col("length"))).alias("n50"))


def pearson(x: str, y: str) -> Column:
    """Correlation; null where either side is constant."""
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


def regression(points: DataFrame, group: str, x: str = "x", y: str = "y") -> DataFrame:
    """Ordinary least squares for each group: at least three points on three distinct x; a constant y has slope 0 and no r."""
    n, distinct = F.count("*"), F.count_distinct(x)
    agg = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(group).agg(n.alias("n"), distinct.alias("n_x"), F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a"), F.avg(y).alias("centre"), F.avg(x).alias("reference"), pearson(x, y).alias("r"), F.stddev_pop(y).alias("sd"))
    ok = (F.col("n") >= 3) & (F.col("n_x") >= 3)
    flat = F.col("sd") == 0
    r = F.when(ok & ~flat, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("r"))))
    return agg.select(group, "n", "n_x", F.when(ok, "fitted").otherwise("insufficient_data").alias("status"), F.when(ok, F.when(flat, 0.0).otherwise(F.col("b"))).alias("slope"), F.when(ok, F.when(flat, F.col("centre")).otherwise(F.col("a"))).alias("intercept"), F.when(ok, F.col("centre")).alias("centre"), F.when(ok, F.col("reference")).alias("reference"), r.alias("r"), (r * r).alias("r2"))


def residuals(points: DataFrame, fits: DataFrame, group: str, x: str = "x", y: str = "y") -> DataFrame:
    """(group, mse, worst): how far points lie from their group's line."""
    away = points.join(fits.where("status = 'fitted'").select(group, "slope", "intercept"), group).withColumn("_r", F.col(y) - F.col("slope") * F.col(x) - F.col("intercept"))
    return away.groupBy(group).agg(F.avg(F.col("_r") * F.col("_r")).alias("mse"), F.max(F.abs("_r")).alias("worst"))


def spread(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Least, median, largest and range, nulls left out."""
    return rows.groupBy(group).agg(F.count(value).alias("n"), F.min(value).alias("least"), F.median(value).alias("middle"), F.max(value).alias("most"), (F.max(value) - F.min(value)).alias("range"))


def selection_overlap(members: DataFrame) -> DataFrame:
    """Sizes of intersection and union, and Jaccard, of every two runs' members (run, sample_id)."""
    sizes = members.distinct().groupBy("run").agg(F.count("*").alias("n"))
    a, b = members.distinct().alias("a"), members.distinct().alias("b")
    both = a.join(b, (F.col("a.sample_id") == F.col("b.sample_id")) & (F.col("a.run") < F.col("b.run"))).groupBy(F.col("a.run").alias("run_a"), F.col("b.run").alias("run_b")).agg(F.count("*").alias("common"))
    # Runs are few: their pairs are made from the table of sizes.
    pairs = sizes.select(F.col("run").alias("run_a"), F.col("n").alias("n_a")).join(sizes.select(F.col("run").alias("run_b"), F.col("n").alias("n_b")), F.col("run_a") < F.col("run_b"))
    out = pairs.join(both, ["run_a", "run_b"], "left").withColumn("common", F.coalesce("common", F.lit(0)))
    either = F.col("n_a") + F.col("n_b") - F.col("common")
    return out.select("run_a", "run_b", "common", either.alias("either"), F.when(either == 0, 1.0).otherwise(F.col("common") / either).alias("jaccard"))


def cumulative_coverage(members: DataFrame) -> DataFrame:
    """For each run in order: its size, how many of its members are new, and how many were seen so far."""
    first = members.groupBy("sample_id").agg(F.min("run").alias("run"))
    new = first.groupBy("run").agg(F.count("*").alias("new"))
    size = members.distinct().groupBy("run").agg(F.count("*").alias("size"))
    return size.join(new, "run", "left").select("run", "size", F.coalesce("new", F.lit(0)).alias("new"), F.sum(F.coalesce("new", F.lit(0))).over(Window.orderBy("run")).alias("seen"))


def agreement(pairs: DataFrame) -> DataFrame:
    """In how many of the runs that could tell (together not null) a pair is together."""
    return pairs.groupBy("a", "b").agg(F.count("together").alias("callable_runs"), F.count_if("together").alias("together_runs")).withColumn("share", F.when(F.col("callable_runs") > 0, F.col("together_runs") / F.col("callable_runs")))


def agreement_of(pairs: DataFrame, together: Column) -> DataFrame:
    """``agreement`` where a pair (a, b) has one row with the list of what its common runs tell; those without a common run have no row."""
    told = pairs.select("a", "b", together.alias("t")).where(F.size("t") > 0)
    counted = told.select("a", "b", F.size(F.filter("t", lambda x: x.isNotNull())).cast("bigint").alias("callable_runs"), F.size(F.filter("t", lambda x: x)).cast("bigint").alias("together_runs"))
    return counted.withColumn("share", F.when(F.col("callable_runs") > 0, F.col("together_runs") / F.col("callable_runs")))


def permutation_p(draws: DataFrame, observed: float) -> DataFrame:
    """(n, exceed, p) with p = (1 + draws that reach the observed value) / (n + 1)."""
    return draws.agg(F.count("*").alias("n"), F.count_if(F.col("r2") >= observed).alias("exceed")).withColumn("p", (1 + F.col("exceed")) / (1 + F.col("n")))
