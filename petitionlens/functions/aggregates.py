"""Aggregate expressions with the exact semantics the analyses need.

All are built-in, algebraic aggregates (count, sum, max, min), so Spark
evaluates them as a partial aggregate before the shuffle and a final one
after it: a key holding a third of all rows still ships one partial row per
map task, never its raw rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


# Weighted sums of values of this type have 38 digits.
WIDE = "decimal(20,0)"

# Limbs of an exact sum: a long is cut into two of so many bits and a signed rest.
LIMB_BITS = 22
DIGITS = "decimal(38,0)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: How partial values of one kind are merged.
MERGE: dict[str, Callable[[Column], Column]] = {
    "count": lambda c: F.coalesce(F.sum(c), F.lit(0).cast("bigint")),
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
}


@dataclass(frozen=True)
class Aggregate:
    """An aggregate whose partial values can be stored and merged: each part with its kind, and what is made of them."""

    parts: tuple[tuple[str, Column], ...]
    finish: Callable[..., Column] = lambda c: c

    @property
    def column(self) -> Column:
        return self.finish(*[c for _, c in self.parts])

    def alias(self, name: str) -> Column:
        return self.column.alias(name)

    def then(self, step: Callable[[Column], Column]) -> Aggregate:
        first = self.finish
        return Aggregate(self.parts, lambda *cols: step(first(*cols)))

    def merged(self, names: list[str]) -> Column:
        """The aggregate from stored parts of the columns ``names``."""
        return self.finish(*[MERGE[kind](F.col(n)) for n, (kind, _) in zip(names, self.parts)])


def largest(value: Column) -> Aggregate:
    return Aggregate((("max", F.max(value)),))


def smallest(value: Column) -> Aggregate:
    return Aggregate((("min", F.min(value)),))


def hits(pred: Column) -> Aggregate:
    """Number of rows where ``pred`` is true (NULL counts as false)."""
    return Aggregate((("count", F.count_if(pred)),))


def count_of(value: str | Column, pred: Column | None = None) -> Aggregate:
    """``COUNT(value)`` over the rows where ``pred`` holds (NULL values skipped)."""
    value = _col(value)
    return Aggregate((("count", F.count(value if pred is None else F.when(pred, value))),))


def exact_mean(value: str | Column, pred: Column | None = None) -> Aggregate:
    """Null-skipping mean of a whole-number column as exact ``SUM / COUNT`` over rows where ``pred`` holds.

    ``avg`` accumulates in double and differs from the exact sum beyond
    2**53, and the sum of two large wages already leaves the range of a long.
    So three long sums, of the value's low, middle and high bits, run as
    primitives in generated code, exact for 2**41 rows a group, and are put
    together as a 38-digit decimal once per group.  An all-NULL group gives
    NULL / 0 = NULL, which is not an error under ANSI mode.
    """
    value = _col(value).cast("bigint")
    v = value if pred is None else F.when(pred, value)
    mask = F.lit((1 << LIMB_BITS) - 1).cast("bigint")
    limbs = v.bitwiseAND(mask), F.shiftright(v, LIMB_BITS).bitwiseAND(mask), F.shiftright(v, 2 * LIMB_BITS)

    def mean(low: Column, middle: Column, high: Column, n: Column) -> Column:
        step = F.lit(1 << LIMB_BITS).cast("decimal(8,0)")
        total = (high.cast("decimal(20,0)") * step + middle.cast("decimal(20,0)")).cast("decimal(29,0)") * step + low.cast("decimal(20,0)")
        return total.cast(DIGITS).cast("double") / n

    return Aggregate((*[("sum", F.sum(x)) for x in limbs], ("count", F.count(v))), mean)
