"""Rate operators: share of a key's rows that match a predicate.

The written-out form of these questions joins each matching row back to a
per-key total (two scans, a join and an extra shuffle).  Here both counts
come out of one group-by, and the inner-join semantics are restated as a
filter: a NULL key has no partner, and a key with no matching row has no
rate row at all (so a "lowest rate" can never be 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petitionlens.functions.aggregates import count_of
from petitionlens.operators.grouped import Grouped


def rate_by_spec(
    key: str,
    pred: Column,
    over: str,
    rate_name: str,
    *,
    hits_name: str | None = None,
    total_name: str | None = None,
) -> Grouped:
    h = hits_name or "_hits"
    t = total_name or "_total"
    present = F.col(key).isNotNull()

    def finish(g: DataFrame) -> DataFrame:
        cols = [F.col(key)]
        if hits_name:
            cols.append(F.col(h))
        if total_name:
            cols.append(F.col(t))
        cols.append((F.col(h) / F.col(t)).alias(rate_name))
        return g.where(F.col(h) > 0).select(*cols)

    aggs = ((h, count_of(over, pred & present)), (t, count_of(over, present)))
    return Grouped((key,), present, aggs, finish)


def rate_by(
    df: DataFrame,
    key: str,
    pred: Column,
    over: str,
    rate_name: str,
    *,
    hits_name: str | None = None,
    total_name: str | None = None,
) -> DataFrame:
    """(key, [hits], [total], hits / total) per non-NULL key with hits > 0.

    ``hits`` is ``COUNT(over)`` over rows where ``pred`` holds and ``total`` is
    ``COUNT(over)`` over all rows of the key.
    """
    return rate_by_spec(key, pred, over, rate_name, hits_name=hits_name, total_name=total_name).run(df)


def top_k_rates_spec(key: str, pred: Column, rate_name: str, *, k: int = 10) -> Grouped:
    present = F.col(key).isNotNull()

    def finish(g: DataFrame) -> DataFrame:
        top = g.orderBy(F.desc("_n"), F.asc(key)).limit(k)
        return top.where(F.col("_hits") > 0).select(key, (F.col("_hits") / F.col("_n")).alias(rate_name))

    return Grouped((key,), present, (("_n", count_of(key, present)), ("_hits", count_of(key, pred))), finish)


def top_k_rates(
    df: DataFrame,
    key: str,
    pred: Column,
    rate_name: str,
    *,
    k: int = 10,
) -> DataFrame:
    """Rates (matching / all rows) among the ``k`` most frequent non-NULL keys.

    Frequency is ``COUNT(key)``; ties at rank ``k`` go to the smaller key so
    the answer is deterministic.  Keys without a matching row are then
    dropped, as an inner join would.  The top-k is a TakeOrderedAndProject:
    each partition keeps ``k`` rows and one task merges them.
    """
    return top_k_rates_spec(key, pred, rate_name, k=k).run(df)


def extreme_rate(rates: DataFrame, key: str, rate_name: str, *, highest: bool) -> DataFrame:
    """The single key with the highest (or lowest) rate; ties go to the smaller key."""
    order = F.desc(rate_name) if highest else F.asc(rate_name)
    return rates.orderBy(order, F.asc(key)).limit(1)
