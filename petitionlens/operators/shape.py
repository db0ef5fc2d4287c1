"""Result shaping: total orders and top-n previews."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered(df: DataFrame, order: Sequence[Column], tie_break: Sequence[str] = ()) -> DataFrame:
    """Sort by ``order`` and then by the ``tie_break`` columns (ascending).

    Appending the key makes ties at a LIMIT or preview boundary deterministic.
    """
    return df.orderBy(*order, *[F.asc(c) for c in tie_break])


def top_n(df: DataFrame, order: Sequence[Column], n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows in a total order (TakeOrderedAndProject: each
    partition keeps ``n`` rows, one task merges them)."""
    return ordered(df, order, tie_break).limit(n)


# Preview sizes of the original console output (rows shown),
# and the analyses whose cells it cut to 20 characters.
PREVIEW_ROWS = {"default": 20, "all_petitions": 40, "modal_soc_by_state": 55}
PREVIEW_CUT = ("cert_state_year_count", "cert_rate_by_year", "all_petitions")


def preview(df: DataFrame, n: int = 20, *, truncate: bool | int = True) -> str:
    """The first ``n`` rows as the console table ``show`` prints, returned as text.

    Only ``n`` rows reach the driver (the plan ends in a limit), so this is
    safe on any result size.  ``truncate=True`` cuts cells to 20 characters,
    an int cuts them to that width, ``False`` keeps them whole.
    """
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.show(n, truncate)
    return text.getvalue()
