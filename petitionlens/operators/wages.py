"""Wage operators: per-key profiles and wage contrasts between two statuses.

Means are exact ``SUM / COUNT`` (see :func:`exact_mean`).  Each operator is a
single scan and at most one group-by; the written-out forms join a per-key
aggregate back to the rows, which costs a second scan and a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petitionlens.functions.aggregates import count_of, exact_mean, hits
from petitionlens.operators.grouped import Grouped


def key_profile_spec(key: str, value: str, pred: Column, count_name: str, mean_name: str) -> Grouped:
    present = F.col(key).isNotNull()
    aggs = ((count_name, count_of(key, pred)), (mean_name, exact_mean(value, present)))
    return Grouped((key,), present, aggs, lambda g: g.where(F.col(count_name) > 0))


def key_profile(
    df: DataFrame,
    key: str,
    value: str,
    pred: Column,
    count_name: str,
    mean_name: str,
) -> DataFrame:
    """(key, matching rows, mean value over ALL rows of the key).

    Only non-NULL keys with at least one matching row appear; the mean is
    deliberately not restricted to the matching rows.
    """
    return key_profile_spec(key, value, pred, count_name, mean_name).run(df)


def wage_contrast_by_spec(
    key: str,
    value: str,
    first: Column,
    second: Column,
    *,
    first_count: str,
    first_mean: str,
    second_mean: str,
) -> Grouped:
    def finish(g: DataFrame) -> DataFrame:
        both = (F.col(first_count) > 0) & (F.col("_second_rows") > 0)
        return g.where(both).select(key, first_count, first_mean, second_mean)

    aggs = (
        (first_count, count_of(key, first)),
        (first_mean, exact_mean(value, first)),
        ("_second_rows", hits(second)),
        (second_mean, exact_mean(value, second)),
    )
    return Grouped((key,), (first | second) & F.col(key).isNotNull(), aggs, finish)


def wage_contrast_by(
    df: DataFrame,
    key: str,
    value: str,
    first: Column,
    second: Column,
    *,
    first_count: str,
    first_mean: str,
    second_mean: str,
) -> DataFrame:
    """(key, rows of ``first``, mean under ``first``, mean under ``second``).

    Only non-NULL keys with rows under both predicates appear.  Presence is
    counted in rows, so a key whose wages are all NULL on one side stays,
    with a NULL mean.
    """
    spec = wage_contrast_by_spec(
        key, value, first, second, first_count=first_count, first_mean=first_mean, second_mean=second_mean
    )
    return spec.run(df)


def wage_contrast_total_spec(value: str, first: Column, second: Column, *, count_name: str, mean_name: str) -> Grouped:
    def finish(g: DataFrame) -> DataFrame:
        pairs = F.array(
            F.struct(F.col("_n1").alias(count_name), F.col("_m1").alias(mean_name)),
            F.struct(F.col("_n2").alias(count_name), F.col("_m2").alias(mean_name)),
        )
        return g.select(F.inline(pairs)).distinct()

    aggs = (
        ("_n1", hits(first)),
        ("_m1", exact_mean(value, first)),
        ("_n2", hits(second)),
        ("_m2", exact_mean(value, second)),
    )
    return Grouped((), first | second, aggs, finish)


def wage_contrast_total(
    df: DataFrame,
    value: str,
    first: Column,
    second: Column,
    *,
    count_name: str,
    mean_name: str,
) -> DataFrame:
    """Distinct rows {(rows, mean) under ``first``, (rows, mean) under ``second``}.

    Both sides come from ONE global aggregate over one scan; an empty side
    still yields (0, NULL), and two identical sides merge into one row, as a
    distinct union would.
    """
    return wage_contrast_total_spec(value, first, second, count_name=count_name, mean_name=mean_name).run(df)
