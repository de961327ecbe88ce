"""Verdicts and comparisons of dated runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import running


def temporal_verdict(requested: Column, successful: Column, rate: Column, p: Column, threshold: float) -> Column:
    """not_assessed without complete randomisations, else whether the rate is positive and the fit beats them."""
    return F.when((requested == 0) | (successful != requested), "not_assessed").when((rate <= 0) | (p > threshold), "not_supported").otherwise("supported")


def interval_overlaps(draws: DataFrame, rate: float, low: float, high: float) -> DataFrame:
    """Randomised intervals (low, high) that hold the observed rate, and those that meet its interval."""
    return draws.agg(F.count_if((F.col("low") <= rate) & (F.lit(rate) <= F.col("high"))).alias("cr1_overlaps"), F.count_if(F.greatest(F.lit(low), "low") <= F.least(F.lit(high), "high")).alias("cr2_overlaps"))


def interval_widths(rows: DataFrame) -> DataFrame:
    """The upper middle and the largest of ``width``: (middle, widest, nodes).

    The middle comes from a running count over distinct widths.
    """
    counts = rows.groupBy("width").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("nodes"), F.max("width").alias("widest"))  # one row
    run = running(counts, ["width"], "upto", total="n").join(F.broadcast(total))
    return run.where(F.col("upto") > F.floor(F.col("nodes") / 2)).groupBy("widest", "nodes").agg(F.min("width").alias("middle")).select("middle", "widest", "nodes")


def randomised(points: DataFrame, group: list[str], key: str, x: str, y: str, runs: int, seed: int) -> DataFrame:
    """(group, run, rate, exceeds, overlaps): slopes of ``y`` dealt anew to ``x`` inside each group, against the slope as observed.

    A run deals values in the order of ``md5(seed|run|key)``; ``overlaps`` says
    whether the run's interval, 1.96 standard errors either way, holds the
    observed slope.  Groups with fewer than three points or distinct x have no
    rows.
    """
    each = points.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs))))
    own = Window.partitionBy(*group, "run")
    text = F.col(key).cast("string")
    left = each.select(*group, "run", F.col(x).alias("_x"), F.row_number().over(own.orderBy(key)).alias("_i"))
    drawn = F.when(F.col("run") == 0, text).otherwise(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("run").cast("string"), text)))
    right = each.select(*group, "run", F.col(y).alias("_y"), F.row_number().over(own.orderBy(drawn)).alias("_i"))
    sums = left.join(right, [*group, "run", "_i"]).groupBy(*group, "run").agg(F.count("*").alias("n"), F.count_distinct("_x").alias("k"), F.regr_slope("_y", "_x").alias("rate"), F.regr_syy("_y", "_x").alias("yy"), F.regr_sxy("_y", "_x").alias("xy"), F.regr_sxx("_y", "_x").alias("xx"))
    rest = F.greatest(F.lit(0.0), F.col("yy") - F.col("rate") * F.col("xy"))
    fits = sums.where("n >= 3 and k >= 3").select(*group, "run", "rate", F.sqrt(rest / F.col("xx") / F.when(F.col("n") > 2, F.col("n") - 2)).alias("se"))
    observed = fits.where("run = 0").select(*group, F.col("rate").alias("_observed"))
    met = fits.where("run > 0").join(observed, group)
    inside = (F.col("rate") - 1.96 * F.col("se") <= F.col("_observed")) & (F.col("_observed") <= F.col("rate") + 1.96 * F.col("se"))
    return met.select(*group, "run", "rate", (F.col("rate") >= F.col("_observed")).alias("exceeds"), inside.alias("overlaps"))
