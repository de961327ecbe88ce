"""Analysis blocks: who may be compared with whom, and why the rest may not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import numbered


def blocks(rows: DataFrame, key: list[Column], missing: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(members, left out): records by block; context stays only where an input is.

    ``missing`` names the reasons for which a record has no block, in order.
    """
    why = F.coalesce(*(F.when(bad, name) for name, bad in missing))
    named = rows.withColumn("reason", why).withColumn("block", F.when(F.col("reason").isNull(), F.concat_ws("|", *(F.coalesce(k.cast("string"), F.lit("")) for k in key))))
    with_input = named.where("role = 'input' and block is not null").select("block").distinct()
    members = named.where("block is not null").join(with_input, "block", "left_semi").select("block", "sample_id", "role")
    lone = named.where("block is not null").join(with_input, "block", "left_anti").select("sample_id", "role", F.lit("no_input_in_block").alias("reason"))
    return members, named.where("reason is not null").select("sample_id", "role", "reason").unionByName(lone)


def block_sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("block").agg(F.count_if(F.col("role") == "input").alias("inputs"), F.count_if(F.col("role") == "context").alias("context"))


def namespaces(rows: DataFrame) -> DataFrame:
    """``rows`` (sample_id, species_key, st, mlst_scheme) with the scheme to compare by: an unnamed one takes the only declared name."""
    declared = rows.where("mlst_scheme is not null").groupBy("species_key", F.coalesce("st", F.lit("")).alias("_st")).agg(F.min("mlst_scheme").alias("_only"), F.count_distinct("mlst_scheme").alias("_n"))
    out = rows.withColumn("_st", F.coalesce("st", F.lit(""))).join(declared, ["species_key", "_st"], "left")
    return out.select("sample_id", "species_key", "st", F.coalesce("mlst_scheme", F.when(F.col("_n") == 1, F.col("_only"))).alias("comparison_scheme"), (F.col("mlst_scheme").isNull() & (F.coalesce("_n", F.lit(0)) > 1)).alias("ambiguous"))


def display_groups(rows: DataFrame, kind: str, key: Column, most: int) -> DataFrame:
    """(kind, label, inputs, context, shown): groups by a key with an unassigned bucket; the largest ``most`` and all with inputs are shown."""
    g = rows.groupBy(F.coalesce(key, F.lit("unassigned")).alias("label")).agg(F.count_if(F.col("role") == "input").alias("inputs"), F.count_if(F.col("role") == "context").alias("context"))
    placed = numbered(g.withColumn("_size", -(F.col("inputs") + F.col("context"))), ["_size", "label"], "_place")
    return placed.select(F.lit(kind).alias("kind"), "label", "inputs", "context", ((F.col("_place") <= most) | (F.col("inputs") > 0)).alias("shown"))


def refused(rows: DataFrame, group: str, most: int) -> DataFrame:
    """Groups beyond a limit are refused whole, never cut."""
    return rows.groupBy(group).agg(F.count("*").alias("n")).withColumn("status", F.when(F.col("n") > most, "refused").otherwise("accepted"))
