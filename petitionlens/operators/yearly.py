"""Multi-year operators: per-key yearly counts or means in one pass.

The written-out form chains one inner join per year (six years: seven scans
and six joins).  Here every year is a conditional aggregate of a single
group-by, and "present in every year" becomes a filter on per-year row
counts.  Presence counts rows, not values, so a year whose wages are all
NULL keeps the key and reports a NULL mean.

The written-out form reaches the first year through a self-join on ``id``;
with unique ids (the default assumption, checked by
:func:`petitionlens.operators.quality.duplicate_ids`) that is a plain filter.
``exact_ids=True`` reproduces the join's multiplicity for repeated ids
instead (see :mod:`petitionlens.operators.identity`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petitionlens.functions.aggregates import WIDE, Aggregate, exact_mean, hits
from petitionlens.operators.grouped import Grouped
from petitionlens.operators.identity import WEIGHT, match_weights

YEAR = "year"

# The six-year span of the multi-year questions.
SIX_YEARS = (2011, 2012, 2013, 2014, 2015, 2016)


def _in_year(y: int) -> Column:
    return F.col(YEAR) == F.lit(y)


def _years_filter(key: str, years: Sequence[int], pred: Column) -> Column:
    return pred & F.col(key).isNotNull() & F.col(YEAR).isin(list(years))


def _first_year_weighted(df: DataFrame, key: str, years: Sequence[int], pred: Column, id_col: str) -> DataFrame:
    """Rows for the exact-ids forms: first-year rows of ANY status (a twin may match)
    plus matching rows of the other years, each with its id's match count."""
    rows = df.where(
        F.col(key).isNotNull() & F.col(YEAR).isin(list(years)) & (pred | _in_year(years[0]))
    )
    joined = rows.join(match_weights(df, pred, id_col), on=id_col, how="left")
    return joined.withColumn(WEIGHT, F.coalesce(F.col(WEIGHT), F.lit(0).cast("bigint")))


def _first_year_count(first: int) -> Column:
    return F.sum(F.when(_in_year(first), F.col(WEIGHT)).otherwise(F.lit(0).cast("bigint")))


def yearly_counts(
    df: DataFrame,
    key: str,
    years: Sequence[int],
    pred: Column,
    *,
    prefix: str = "certifications",
    change_name: str = "net_change",
    exact_ids: bool = False,
    id_col: str = "id",
) -> DataFrame:
    """(key, n per year, n[last] - n[first]) for keys with a match in every year."""
    if not exact_ids:
        return yearly_counts_spec(key, years, pred, prefix=prefix, change_name=change_name).run(df)
    years = list(years)
    names = [f"{prefix}_{y}" for y in years]
    later = [hits(pred & _in_year(y)).alias(n) for y, n in zip(years[1:], names[1:])]
    g = (
        _first_year_weighted(df, key, years, pred, id_col)
        .groupBy(key)
        .agg(_first_year_count(years[0]).alias(names[0]), *later)
    )
    return _every_year(g, key, names, names, change_name)


def _every_year(g: DataFrame, key: str, values: list[str], seen: list[str], change_name: str) -> DataFrame:
    """Keys seen in every year, with the change from the first to the last year."""
    return g.where(_all([F.col(s) > 0 for s in seen])).select(
        key, *values, (F.col(values[-1]) - F.col(values[0])).alias(change_name)
    )


def yearly_counts_spec(
    key: str,
    years: Sequence[int],
    pred: Column,
    *,
    prefix: str = "certifications",
    change_name: str = "net_change",
) -> Grouped:
    years = list(years)
    names = [f"{prefix}_{y}" for y in years]
    aggs = tuple((n, hits(pred & _in_year(y))) for y, n in zip(years, names))
    alone = tuple((n, hits(_in_year(y))) for y, n in zip(years, names))
    return Grouped(
        (key,), _years_filter(key, years, pred), aggs, lambda g: _every_year(g, key, names, names, change_name), alone
    )


def yearly_means(
    df: DataFrame,
    key: str,
    value: str,
    years: Sequence[int],
    pred: Column,
    *,
    prefix: str = "wages",
    change_name: str = "net_change",
    exact_ids: bool = False,
    id_col: str = "id",
) -> DataFrame:
    """(key, exact mean of value per year, mean[last] - mean[first]).

    Keys must have a matching row in every year; the means skip NULL values.
    """
    if not exact_ids:
        return yearly_means_spec(key, value, years, pred, prefix=prefix, change_name=change_name).run(df)
    years = list(years)
    names = [f"{prefix}_{y}" for y in years]
    seen = [f"_rows_{y}" for y in years]
    first = years[0]
    counted = _in_year(first) & (F.col(WEIGHT) > 0)
    v = F.col(value)
    weighted = F.col(WEIGHT).cast("decimal(18,0)") * v.cast(WIDE)
    first_mean = F.sum(F.when(counted, weighted)).cast("double") / F.sum(F.when(counted & v.isNotNull(), F.col(WEIGHT)))
    g = (
        _first_year_weighted(df, key, years, pred, id_col)
        .groupBy(key)
        .agg(
            _first_year_count(first).alias(seen[0]),
            *[hits(pred & _in_year(y)).alias(s) for y, s in zip(years[1:], seen[1:])],
            first_mean.alias(names[0]),
            *[exact_mean(value, pred & _in_year(y)).alias(n) for y, n in zip(years[1:], names[1:])],
        )
    )
    return _every_year(g, key, names, seen, change_name)


def yearly_means_spec(
    key: str,
    value: str,
    years: Sequence[int],
    pred: Column,
    *,
    prefix: str = "wages",
    change_name: str = "net_change",
) -> Grouped:
    years = list(years)
    names = [f"{prefix}_{y}" for y in years]
    seen = [f"_rows_{y}" for y in years]

    def aggs(matched: list[Column]) -> tuple[tuple[str, Aggregate], ...]:
        return tuple((s, hits(m)) for s, m in zip(seen, matched)) + tuple(
            (n, exact_mean(value, m)) for n, m in zip(names, matched)
        )

    return Grouped(
        (key,),
        _years_filter(key, years, pred),
        aggs([pred & _in_year(y) for y in years]),
        lambda g: _every_year(g, key, names, seen, change_name),
        aggs([_in_year(y) for y in years]),
    )


def yearly_pivot(
    df: DataFrame,
    key: str,
    years: Sequence[int],
    pred: Column,
    *,
    prefix: str = "certifications",
    change_name: str = "net_change",
) -> DataFrame:
    """(key, n per year or NULL, n[last] - n[first] or 0) for every non-NULL key.

    Unlike :func:`yearly_counts` no year is required: a key whose matching
    rows all have another (or a NULL) year still appears, with NULL counts,
    and the change is 0 unless both end years are present.  This is a
    conditional aggregate rather than ``pivot``, which would add a second
    group-by and a second shuffle.
    """
    return yearly_pivot_spec(key, years, pred, prefix=prefix, change_name=change_name).run(df)


def yearly_pivot_spec(
    key: str,
    years: Sequence[int],
    pred: Column,
    *,
    prefix: str = "certifications",
    change_name: str = "net_change",
) -> Grouped:
    years = list(years)
    names = [f"{prefix}_{y}" for y in years]

    def absent(n: Column) -> Column:
        return F.nullif(n, F.lit(0))

    aggs = tuple((n, hits(pred & _in_year(y)).then(absent)) for y, n in zip(years, names))
    alone = tuple((n, hits(_in_year(y)).then(absent)) for y, n in zip(years, names))

    def finish(g: DataFrame) -> DataFrame:
        change = F.coalesce(F.col(names[-1]) - F.col(names[0]), F.lit(0).cast("bigint"))
        return g.select(key, *names, change.alias(change_name))

    return Grouped((key,), pred & F.col(key).isNotNull(), aggs, finish, alone)


def _all(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out
