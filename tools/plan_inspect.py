"""Plan inspection helpers (used by tests and when tuning a query)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame, *, execute: bool = False) -> str:
    """The physical plan as text.

    With ``execute=True`` the DataFrame's own plan is run first (inside the
    JVM, counting rows without returning them), so an adaptive plan shows its
    final form, including reused exchanges and joins re-planned from runtime
    sizes.
    """
    qe = df._jdf.queryExecution()
    if execute:
        qe.toRdd().count()
    return qe.executedPlan().toString()


def final_plan(df: DataFrame) -> str:
    """Only the ``Final Plan`` section of an executed adaptive plan."""
    text = physical_plan(df, execute=True)
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text


def count(plan: str, pattern: str) -> int:
    return len(re.findall(pattern, plan))


def summary(plan: str) -> dict[str, int]:
    """Scans, joins and exchanges in a plan string."""
    return {
        "scans": count(plan, r"FileScan parquet|Scan parquet"),
        "joins": count(plan, r"\w+Join "),
        "hash_exchanges": count(plan, r"Exchange hashpartitioning"),
        "range_exchanges": count(plan, r"Exchange rangepartitioning"),
        "reused_exchanges": count(plan, r"ReusedExchange"),
        "windows": count(plan, r"\bWindow\b"),
        "python": count(plan, r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas"),
    }
