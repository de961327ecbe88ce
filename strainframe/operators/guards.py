"""Rules that open or close a step: exports, alignments, public identities and options."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

# Programs that look for recombination, lineage levels that may be chosen, and the organism one export is for.
RECOMBINATION = ("phipack", "clonalframeml", "verticall")
LINEAGE_LEVELS = (5, 10)
CLUSTERED_ORGANISM, CLUSTERED_SPECIES = "562", "escherichia coli"


def true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def export_eligible() -> dict[str, Column]:
    """For each download whether a sample (numeric_source_id, species, organism_id, has_profile, lineage, has_clusters) still needs it."""
    known = true(F.col("numeric_source_id").cast("string").rlike("^[0-9]+$"))
    species, lacks = F.lower(F.coalesce("species", F.lit(""))), lambda n: ~true(F.col(n))
    return {
        "cgmlst": known & lacks("has_profile"),
        "lincodes": known & species.contains("klebsiella") & (F.coalesce("lineage", F.lit("")) == ""),
        "hiercc": known & (species == CLUSTERED_SPECIES) & (S.text(F.col("organism_id")) == CLUSTERED_ORGANISM) & lacks("has_clusters"),
    }


def alignment_problems(aligned: DataFrame, original: DataFrame) -> DataFrame:
    """(sample_id, problem): aligned rows (sample_id, seq) must be the original ones with gaps, all of one width; a null id stands for the table."""
    a = aligned.select("sample_id", F.coalesce("seq", F.lit("")).alias("seq"), F.lit(True).alias("here"))
    o = original.select("sample_id", F.col("seq").alias("before"), F.lit(True).alias("there"))
    problem = (
        F.when(F.col("here").isNull(), "not_aligned")
        .when(F.col("there").isNull(), "not_in_input")
        .when(~F.col("seq").rlike("^[ACGT-]+$"), "invalid_letters")
        .when(~F.regexp_replace("seq", "-", "").eqNullSafe(F.col("before")), "changed_sequence")
    )
    rows = a.join(o, "sample_id", "full").select("sample_id", problem.alias("problem"))
    widths = a.agg(F.count("*").alias("n"), F.min(F.length("seq")).alias("least"), F.max(F.length("seq")).alias("most"))
    table = widths.select(F.lit(None).cast(a.schema["sample_id"].dataType).alias("sample_id"), F.when(F.col("n") == 0, "empty").when(F.col("least") != F.col("most"), "unequal_widths").alias("problem"))
    return rows.unionByName(table).where("problem is not null")


def identity_problem(source_id: Column, row: Column, detail: Column) -> Column:
    """Why a provider's details (uuid, access, organism_id, species, mlst, mlst2, checksum) do not prove a sample's identity; null if they do.

    ``row`` is what is known: organism_id, species, mlst_scheme, mlst_st.  What
    is not known is not compared, but a type must follow from one of the two.
    """
    st = S.text(row["mlst_st"])
    one, two = S.text(detail["mlst"]), S.text(detail["mlst2"])
    found = F.when(row["mlst_scheme"] == "mlst", one).when(row["mlst_scheme"] == "mlst2", two).when((st != "") & st.isin(one, two), st).when(detail["mlst"].isNotNull(), one).otherwise(two)
    organism, wanted = S.text(detail["organism_id"]), S.text(row["organism_id"])
    other = (S.text(row["species"]) != "") & (S.text(detail["species"]) != "") & (F.lower(S.text(row["species"])) != F.lower(S.text(detail["species"])))
    return (
        F.when(~true(detail["uuid"] == source_id) | ~F.coalesce(detail["access"] == "PUBLIC", F.lit(True)), "unverified")
        .when((organism == "") | ((wanted != "") & (organism != wanted)) | other | (found == "") | ((st != "") & (found != st)), "scope_mismatch")
        .when(~true(detail["checksum"].rlike("^[0-9a-fA-F]{40}$")), "no_checksum")
    )


def option_rules() -> dict[str, Column]:
    """Rules that options (method, window, step, threshold, replicates, level) break; absent replicates and levels are not judged."""
    window, step, share, least = F.col("window"), F.col("step"), F.col("threshold"), F.lit(1000)
    return {
        "unknown_method": ~true(F.col("method").isin(*RECOMBINATION)),
        "window_below_200": ~true(window >= 200),
        "step_outside_window": ~true((step >= 1) & (step <= window)),
        "threshold_outside": ~true((share > 0) & (share <= 1) & ~F.isnan(share)),
        "few_replicates": (F.col("replicates") != 0) & (F.col("replicates") < least),
        "unsupported_level": ~F.col("level").between(*LINEAGE_LEVELS),
    }
