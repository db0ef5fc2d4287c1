from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

from corpus_cases import DOCS, TEXTS  # noqa: E402

@pytest.fixture(scope="session")
def docs(spark):
    """Awkward rows: all TEXTS, a null id, null lang and source, a row twice, and columns with clashing names."""
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 2}" if i % 4 else None, len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id here", "en", "src0", 10), rows[10], rows[10]]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return df.selectExpr("*", "'x' AS key", "1 AS n_words", "'y' AS tkey", "2 AS fp", "'z' AS queue", "3 AS data", "false AS kept")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
