"""The printed report of a catalogue run: one preview table per analysis.

Only the preview rows of each answer reach the driver (each preview ends in
a limit), so the report is safe whatever the table size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from petitionlens.operators.shape import PREVIEW_CUT, PREVIEW_ROWS, preview
from petitionlens.plans.catalogue import CATALOGUE

# The section order and titles of the report.
SECTIONS = (("basic", "BASIC QUERIES"), ("additional", "ADDITIONAL QUERIES"), ("task", "TASKS"), ("timing", "TIMING"))


def report(
    answers: dict[str, DataFrame], groups: Sequence[str] | None = None, *, truncate: bool | int | None = None
) -> str:
    """Text report of ``answers`` (as returned by ``run_catalogue``), section by section.

    Cells are cut as each analysis' preview has it, or all alike by ``truncate``.
    """
    wanted = set(groups) if groups is not None else {g for g, _ in SECTIONS}
    parts = []
    for group, title in SECTIONS:
        if group not in wanted:
            continue
        parts.append(f"### {title} ###")
        for key, w in CATALOGUE.items():
            if w.group != group or key not in answers:
                continue
            n = PREVIEW_ROWS.get(key, PREVIEW_ROWS["default"])
            parts.append(f"## {w.ident} {key}\n{preview(answers[key], n, truncate=key in PREVIEW_CUT if truncate is None else truncate)}")
    return "\n".join(parts)
