"""Data-quality reports, returned as DataFrames (nothing is collected)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """One row with the number of rows of ``df``."""
    return df.agg(F.count(F.lit(1)).alias(name))


def duplicate_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, copies) for every id that occurs more than once, NULL id included.

    The single-pass analyses assume unique, non-NULL ids (the written-out
    forms self-join on id, which multiplies rows for a duplicated id).  An
    empty result certifies the precondition.
    """
    return (
        df.groupBy(id_col)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where((F.col("copies") > 1) | F.col(id_col).isNull())
    )
