"""Exact results when ids repeat.

Some of the original questions join every row to a filtered copy of the
table on ``id``.  With unique ids that join is a plain filter (the default
single-pass plans).  With repeated ids it is not: a row is counted once for
every matching row that shares its id, and rows that do not match the filter
themselves can still be counted through a twin that does.

``exact_ids=True`` on the affected operators reproduces that multiplicity
exactly: one aggregate on ``id`` gives each id its number of matching rows,
and a join on ``id`` carries that weight to every row.  This costs a shuffle
on ``id``, so it is opt-in.  A heavily repeated id is handled by AQE's
skew-join split, because the weight side holds a single row per id.  AQE
splits a join only if both sides come straight from a shuffle made for it, so
the weights (one light row per id) are dealt anew after their aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEIGHT = "_id_matches"


def match_weights(df: DataFrame, pred: Column, id_col: str = "id") -> DataFrame:
    """(id, number of rows satisfying ``pred`` with that id); ids with none are absent."""
    return (
        df.where(pred & F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(F.count(F.lit(1)).alias(WEIGHT))
        .hint("rebalance")
    )


def with_match_weight(df: DataFrame, pred: Column, id_col: str = "id", how: str = "inner") -> DataFrame:
    """Rows of ``df`` with column ``_id_matches``: how many ``pred`` rows share their id.

    With ``how='left'`` rows whose id has no match get weight 0.
    """
    joined = df.join(match_weights(df, pred, id_col), on=id_col, how=how)
    if how == "left":
        joined = joined.withColumn(WEIGHT, F.coalesce(F.col(WEIGHT), F.lit(0).cast("bigint")))
    return joined


def count_by_id_match(
    df: DataFrame,
    key: str,
    pred: Column,
    name: str,
    counted: str,
    id_col: str = "id",
) -> DataFrame:
    """(key, n): every row, counted once per ``pred`` row sharing its id.

    ``COUNT(counted)`` semantics: rows with a NULL ``counted`` value add 0.
    The NULL key keeps its group.
    """
    w = with_match_weight(df, pred, id_col)
    n = F.sum(F.when(F.col(counted).isNotNull(), F.col(WEIGHT)).otherwise(F.lit(0).cast("bigint")))
    return w.groupBy(key).agg(n.alias(name))
