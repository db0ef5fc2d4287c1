"""ANSI-safe cleaning expressions for raw petition text.

Spark 4 runs with ANSI mode on: ``cast('NA' as bigint)`` and
``cast('36067.6' as bigint)`` raise, and the obvious replacement
``try_cast('36067.6' as bigint)`` silently returns NULL, losing every
decimal wage.  The expressions below keep the legacy meaning (decimals are
truncated toward zero, anything else that is not a number becomes NULL)
without turning ANSI mode off, and they stay JVM-side (no UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The missing-value marker, and the text the legacy
# (non-ANSI) text-to-integer cast accepts: optional edge characters
# \x00-\x20 and \x7f, an optional sign, then digits with an optional
# fraction, or a fraction alone ('.5' and '.' read as 0).
MISSING = "NA"
EDGE = r"[\x00-\x20\x7f]*"
DECIMAL_TEXT = rf"^{EDGE}[+-]?([0-9]+([.][0-9]*)?|[.][0-9]*){EDGE}$"
SIGNED_WHOLE = rf"^{EDGE}([+-]?[0-9]*)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: str | Column) -> Column:
    """Exact, case-sensitive ``'NA'`` -> NULL; everything else unchanged."""
    c = _col(c)
    return F.nullif(c, F.lit(MISSING))


def truncating_integral(c: str | Column, type_name: str) -> Column:
    """Text -> integral type, truncating a fractional part (the legacy cast).

    ``' 12 '`` -> 12, ``'-5.9'`` -> -5, ``'36067.6'`` -> 36067, ``'.5'`` -> 0;
    ``'1e5'``, ``'1,000'``, ``''``, ``'-'``, ``'NA'`` and out-of-range values
    -> NULL.  Checked against Spark's own non-ANSI cast in the tests.
    """
    c = _col(c)
    whole = F.regexp_extract(c, SIGNED_WHOLE, 1)
    value = F.when(whole.rlike("[0-9]"), whole.try_cast(type_name)).otherwise(F.lit(0).cast(type_name))
    return F.when(c.rlike(DECIMAL_TEXT), value)


def to_double(c: str | Column) -> Column:
    return _col(c).try_cast("double")


def split_field(c: str | Column, index: int, sep: str = ",") -> Column:
    """Trimmed ``index``-th comma field; NULL when the text has fewer fields.

    ``'NA'`` has no second field, so its state is NULL; ``'A,'`` has an empty
    second field, so its state is ``''``.
    """
    return F.trim(F.get(F.split(_col(c), sep), F.lit(index)))
