"""Status predicates shared by every workload.

All of them are plain column expressions, so Catalyst pushes them into the
Parquet scan (``StringStartsWith`` / ``StringEndsWith`` / ``EqualTo`` appear
under ``PushedFilters``).  A NULL status makes each predicate NULL, which
``where`` and ``count_if`` treat as false.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The case-status vocabulary the analyses depend on.
CERTIFIED = "CERTIFIED"  # matched as a prefix (or as a substring in the row forms)
DENIED = "DENIED"  # matched exactly
WITHDRAWN = "WITHDRAWN"  # matched as a suffix

STATUS = "case_status"


def certified(status: str = STATUS) -> Column:
    """Status starts with CERTIFIED (CERTIFIED, CERTIFIED-WITHDRAWN, ...)."""
    return F.col(status).startswith(CERTIFIED)


def mentions_certified(status: str = STATUS) -> Column:
    """Status contains CERTIFIED anywhere (also DECERTIFIED)."""
    return F.col(status).contains(CERTIFIED)


def denied(status: str = STATUS) -> Column:
    """Status equals DENIED."""
    return F.col(status) == F.lit(DENIED)


def withdrawn(status: str = STATUS) -> Column:
    """Status ends with WITHDRAWN (WITHDRAWN, CERTIFIED-WITHDRAWN, ...)."""
    return F.col(status).endswith(WITHDRAWN)


def in_year(year: int, column: str = "year") -> Column:
    return F.col(column) == F.lit(year)
