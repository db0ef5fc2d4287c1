"""Declared schemas of the petition table and a strict schema check.

Two stages exist: RAW is what arrives from CSV or a warehouse table (every
numeric column is text, because missing values are written as ``'NA'``), and
CLEAN is the typed table stored as Parquet and read by every analysis.
Column names are lower case throughout the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("case_status", T.StringType()),
        T.StructField("employer_name", T.StringType()),
        T.StructField("soc_name", T.StringType()),
        T.StructField("job_title", T.StringType()),
        T.StructField("full_time_position", T.StringType()),
        T.StructField("prevailing_wage", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("worksite", T.StringType()),
        T.StructField("lon", T.StringType()),
        T.StructField("lat", T.StringType()),
    ]
)

CLEAN = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("case_status", T.StringType()),
        T.StructField("employer_name", T.StringType()),
        T.StructField("soc_name", T.StringType()),
        T.StructField("job_title", T.StringType()),
        T.StructField("full_time_position", T.StringType()),
        T.StructField("prevailing_wage", T.LongType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("worksite", T.StringType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
    ]
)

# The columns the analyses read. The driver-table projection has no lon/lat.
ANALYSIS_COLUMNS = [
    "id",
    "case_status",
    "employer_name",
    "soc_name",
    "job_title",
    "full_time_position",
    "prevailing_wage",
    "year",
    "worksite",
    "city",
    "state",
]


class SchemaMismatch(ValueError):
    """Raised when a DataFrame does not carry the expected columns and types."""


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields]


def require(df: DataFrame, expected: T.StructType, *, subset: bool = False) -> DataFrame:
    """Return ``df`` unchanged if its columns and types equal ``expected``.

    Nullability is ignored (Parquet footers mark every column nullable).  With
    ``subset=True`` ``df`` may carry extra columns.  Nothing is ever dropped
    or rewritten: a mismatch raises, so stored data is never destroyed.
    """
    have = _shape(df.schema)
    want = _shape(expected)
    if subset:
        have_map = dict(have)
        missing = [(n, t) for n, t in want if have_map.get(n) != t]
        if missing:
            raise SchemaMismatch(f"missing or mistyped columns {missing}; have {have}")
        return df
    if have != want:
        raise SchemaMismatch(f"schema {have} differs from expected {want}")
    return df
