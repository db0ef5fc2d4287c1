"""An aggregate analysis as data: rows, key, aggregates and a finishing step.

Every keyed operator in this package is a :class:`Grouped`: a row filter
(pushed into the scan), group-by keys, named aggregates and a function that
turns the aggregated frame into the answer.  Each aggregate is written to be
self-contained (conditional on the analysis' own rows), so the filter is
only an optimisation: ``run`` applies it and aggregates one analysis;
:func:`petitionlens.plans.shared.run_shared` ORs the filters of many
analyses with the same key and computes all their aggregates in ONE
group-by over ONE scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petitionlens.functions.aggregates import Aggregate


@dataclass(frozen=True)
class Grouped:
    keys: tuple[str, ...]
    where: Column | None
    aggs: tuple[tuple[str, Aggregate], ...]
    finish: Callable[[DataFrame], DataFrame] = field(default=lambda g: g)
    #: The same aggregates without what ``where`` already guarantees, for a run of this analysis alone.
    alone: tuple[tuple[str, Aggregate], ...] | None = None

    def aggregate(self, df: DataFrame) -> DataFrame:
        """The aggregated frame of this analysis alone (filter pushed down)."""
        rows = df if self.where is None else df.where(self.where)
        named = [c.alias(n) for n, c in self.alone or self.aggs]
        return rows.groupBy(*self.keys).agg(*named) if self.keys else rows.agg(*named)

    def run(self, df: DataFrame) -> DataFrame:
        return self.finish(self.aggregate(df))

    def then(self, step: Callable[[DataFrame], DataFrame]) -> Grouped:
        """The same analysis with one more finishing step (e.g. the output order)."""
        first = self.finish
        return Grouped(self.keys, self.where, self.aggs, lambda g: step(first(g)), self.alone)

    def rows_matched(self) -> Column:
        """Rows of a group that belong to this analysis (its group exists iff > 0)."""
        return F.count_if(self.where) if self.where is not None else F.count(F.lit(1))
