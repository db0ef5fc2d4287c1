"""Small helpers for building hand-made petition tables in tests."""

from __future__ import annotations

from pyspark.sql import types as T

from petitionlens.schema import ANALYSIS_COLUMNS, CLEAN

ANALYSIS = T.StructType([f for f in CLEAN.fields if f.name in ANALYSIS_COLUMNS])


def table(spark, rows: list[dict]):
    """A clean-shaped DataFrame from dicts; missing fields are NULL.

    ``city``/``state`` default to the comma fields of ``worksite``.
    """
    full = []
    for r in rows:
        r = dict(r)
        ws = r.get("worksite")
        if ws is not None and "city" not in r:
            parts = [x.strip() for x in ws.split(",")]
            r["city"] = parts[0]
            r.setdefault("state", parts[1] if len(parts) > 1 else None)
        full.append(tuple(r.get(f.name) for f in ANALYSIS.fields))
    return spark.createDataFrame(full, ANALYSIS)


def rows(df, order=None):
    out = [tuple(r) for r in df.collect()]
    return out if order is False else sorted(out, key=repr)
