"""Counting operators: global counts, per-key counts, per-key extremes.

Each is one filtered scan plus, for the keyed forms, one hash aggregate
(partial before the shuffle, final after it).  ``*_spec`` gives the same
analysis as a :class:`Grouped`, so it can share a scan with others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petitionlens.functions.aggregates import count_of, hits, largest, smallest
from petitionlens.operators.grouped import Grouped


def count_where_spec(pred: Column, name: str) -> Grouped:
    return Grouped((), pred, ((name, hits(pred)),))


def count_where(df: DataFrame, pred: Column, name: str) -> DataFrame:
    """One row: the number of rows where ``pred`` holds."""
    return count_where_spec(pred, name).run(df)


def count_by_spec(key: str, pred: Column, name: str, counted: str | None = None) -> Grouped:
    n = hits(pred) if counted is None else count_of(counted, pred)
    return Grouped((key,), pred, ((name, n),))


def count_by(
    df: DataFrame,
    key: str,
    pred: Column,
    name: str,
    counted: str | None = None,
) -> DataFrame:
    """(key, n) over rows where ``pred`` holds; the NULL key keeps its group.

    ``counted=None`` counts rows.  ``counted=<column>`` is ``COUNT(column)``,
    which skips NULLs, so ``counted=key`` gives the NULL-key group 0.
    """
    return count_by_spec(key, pred, name, counted).run(df)


def extreme_by_spec(
    key: str,
    value: str,
    pred: Column,
    name: str,
    *,
    kind: str = "max",
    require_value: bool = False,
) -> Grouped:
    if kind not in ("max", "min"):
        raise ValueError("kind must be 'max' or 'min'")
    if require_value:
        pred = pred & F.col(value).isNotNull()
    v = F.when(pred, F.col(value))
    return Grouped((key,), pred, ((name, largest(v) if kind == "max" else smallest(v)),))


def extreme_by(
    df: DataFrame,
    key: str,
    value: str,
    pred: Column,
    name: str,
    *,
    kind: str = "max",
    require_value: bool = False,
) -> DataFrame:
    """(key, MAX or MIN of value) over rows where ``pred`` holds.

    The NULL key keeps its group.  With ``require_value`` rows with a NULL
    value are filtered first, so a group whose values are all NULL vanishes
    instead of reporting NULL.
    """
    return extreme_by_spec(key, value, pred, name, kind=kind, require_value=require_value).run(df)
