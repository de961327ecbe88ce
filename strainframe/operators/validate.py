"""Checks of tables: what breaks a rule comes back as (rule, id) rows or counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(rule, id) for every rule a row breaks."""
    found = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items())))
    return rows.select(F.explode(found).alias("rule"), F.col(key).alias("id"))


def repeated(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def dangling(rows: DataFrame, key: str, known: DataFrame, other: str) -> DataFrame:
    """Keys of ``rows`` that ``known`` lacks."""
    return rows.select(F.col(key).alias("id")).distinct().join(known.select(F.col(other).alias("id")).distinct(), "id", "left_anti")


def bins_violations(bins: DataFrame, low: float, high: float) -> DataFrame:
    """(group, rule): ordered bins must be adjacent and run from ``low`` to ``high``."""
    w = Window.partitionBy("group").orderBy("least", "most")
    seen = bins.withColumn("_before", F.lag("most").over(w)).withColumn("_after", F.lead("least").over(w))
    rules = [("gap", F.col("least") > F.col("_before")), ("overlap", F.col("least") < F.col("_before")), ("wrong_begin", F.col("_before").isNull() & (F.col("least") != low)), ("wrong_end", F.col("_after").isNull() & (F.col("most") != high)), ("reversed", F.col("least") >= F.col("most"))]
    parts = [seen.where(bad).select("group", F.lit(name).alias("rule")) for name, bad in rules]
    return reduce(DataFrame.unionByName, parts).groupBy("group", "rule").agg(F.count("*").alias("n"))


def sample_rules() -> dict[str, Column]:
    """Rules for sample rows with role, date_start, date_end, date_precision."""
    s, e, p = F.col("date_start"), F.col("date_end"), F.col("date_precision")
    return {
        "unknown_role": ~F.col("role").isin("input", "context"),
        "unsafe_id": ~F.col("sample_id").cast("string").rlike("^[A-Za-z0-9_.-]+$"),
        "reversed_dates": s > e,
        "day_with_range": (p == "day") & (s != e),
        "partial_month": (p == "month") & ((s != F.trunc(s, "month")) | (e != F.last_day(s))),
        "partial_year": (p == "year") & ((s != F.trunc(s, "year")) | (e != F.make_date(F.year(s), F.lit(12), F.lit(31)))),
        "date_without_precision": s.isNotNull() & p.isNull(),
    }
