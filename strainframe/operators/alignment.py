"""Alignments: masks of columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered_mask(sequences: DataFrame) -> DataFrame:
    """(alignment, pos, masked, strict) of (alignment, ordinal, seq).

    Taxa are read in their order: a column is masked once N, -, X or ? shows, but no longer looked at after its third
    base; ``strict`` marks every column with anything but A, C, G or T.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        table = np.array([list(s.upper()) for s in rows.sort_values("ordinal")["seq"]])
        length = table.shape[1]
        first, second = np.full(length, ""), np.full(length, "")
        masked, done = np.zeros(length, bool), np.zeros(length, bool)
        for row in table:
            unknown = np.isin(row, list("N-X?"))
            masked |= unknown & ~done
            called = ~unknown & ~done
            new = called & (first == "")
            other = called & ~new & (row != first)
            fresh = other & (second == "")
            done |= other & ~fresh & (row != second)
            first, second = np.where(new, row, first), np.where(fresh, row, second)
        strict = ~np.isin(table, list("ACGT")).all(axis=0)
        return pd.DataFrame({"alignment": rows["alignment"].iloc[0], "pos": np.arange(1, length + 1), "masked": masked, "strict": strict})

    return sequences.select("alignment", "ordinal", "seq").groupBy("alignment").applyInPandas(run, f"alignment {dict(sequences.dtypes)['alignment']}, pos bigint, masked boolean, strict boolean")


def retained(columns: DataFrame) -> DataFrame:
    """(alignment, columns, masked, kept) of a mask."""
    return columns.groupBy("alignment").agg(F.count("*").alias("columns"), F.count_if("masked").alias("masked"), F.count_if(~F.col("masked")).alias("kept"))
