"""The batch ingest job and a runner for catalogue groups.

``ingest`` is the whole load path as one Spark job: read RAW rows (CSV or
any data source), clean them, store them as Parquet (idempotently by
default), and return the stored table.  ``run_catalogue`` answers the
selected analysis groups over that table, one scan per group-by key.
"""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from petitionlens.operators.clean import clean_petitions
from petitionlens.operators.quality import duplicate_ids
from petitionlens.plans.catalogue import select
from petitionlens.plans.shared import run_catalogue_shared
from petitionlens.schema import CLEAN, RAW, require
from petitionlens.sources.files import (
    CORRUPT,
    WRITE_MODES,
    path_exists,
    read_petitions,
    read_petitions_csv,
    read_table,
)
from petitionlens.sources.snapshots import (
    LOADS,
    MANIFESTS,
    ConcurrentLoad,
    Folder,
    Manifest,
    commit,
    manifest,
    manifest_name,
    read_snapshot,
    stored_rows,
    versions,
    write_load,
)

log = logging.getLogger(__name__)


def _as_text(table: DataFrame, name: str, kind: T.DataType) -> Column:
    """A column of a typed table in RAW form.

    A number becomes text by way of its whole part: the cleaning keeps no
    more of it, and a double's own text has an exponent from 10^7 on.
    Coordinates keep their fraction.
    """
    have = next((f.dataType for f in table.schema.fields if f.name.lower() == name), None)
    col = F.col(name)
    if name in ("prevailing_wage", "year") and isinstance(have, T.NumericType):
        col = col.try_cast("bigint")
    return col.cast(kind).alias(name)


def read_raw(spark: SparkSession, source: str, *, fmt: str = "csv", bad_records: str = "fail", **options: str) -> DataFrame:
    """RAW rows from a CSV path, or from any data source by name.

    A table is bound by column name (case-insensitively) and every RAW
    column is brought to its RAW type, so a table that already types a column
    (an integer id, a double wage of any size) goes through the same cleaning.
    ``bad_records`` is the policy for CSV rows that do not fit (see
    :func:`petitionlens.sources.files.read_petitions_csv`).
    """
    if fmt == "csv":
        return read_petitions_csv(spark, source, bad_records=bad_records)
    table = read_table(spark, fmt, source, **options)
    return require(table.select([_as_text(table, f.name, f.dataType) for f in RAW.fields]), RAW)


class UnmarkedTable(RuntimeError):
    """A folder holds rows, but nothing says that their load was finished."""


def plain_rows(spark: SparkSession, target: str) -> tuple[bool, bool]:
    """Of a table without manifests: whether it has a row, and whether its writer (or a stream) marked it as finished."""
    if not path_exists(spark, target):
        return False, False
    base = target.rstrip("/")
    marked = any(path_exists(spark, f"{base}/{mark}") for mark in ("_SUCCESS", "_spark_metadata"))
    return not spark.read.schema(CLEAN).parquet(target).isEmpty(), marked


def is_loaded(spark: SparkSession, target: str) -> bool:
    """A finished load with a row: a committed version, or a plain table with its writer's mark."""
    seen = manifest(spark, target)
    return seen.rows > 0 if seen else plain_rows(spark, target) == (True, True)


def set_apart(raw: DataFrame, source: str, target: str, quarantine: str, name: str | None = None) -> DataFrame:
    """The rows that fit; the others are written as text below ``quarantine``, in a folder of this source and
    target (or of a given ``name``), which a retry of the load writes anew."""
    bad = Observation("bad_records")
    # a row is bad by the columns that are read, so this reads all of them, as the load does
    nothing = F.concat_ws("", *[F.substring(F.col(f.name).cast("string"), 1, 0) for f in RAW.fields])
    text = F.concat(F.col(CORRUPT), nothing)
    rejected = raw.where(F.col(CORRUPT).isNotNull()).select(text.alias("value"))
    name = name or hashlib.sha256(f"{source}\n{target}".encode()).hexdigest()[:16]
    apart = f"{quarantine.rstrip('/')}/load={name}"
    rejected.observe(bad, F.count(F.lit(1)).alias("n")).write.mode("overwrite").text(apart)
    log.warning("%s: %d rows quarantined in %s", source, bad.get["n"], apart)
    return raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def ingest(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    fmt: str = "csv",
    mode: str = "ignore",
    partition_by: Sequence[str] = ("year",),
    bad_records: str = "fail",
    quarantine: str | None = None,
    **options: str,
) -> DataFrame:
    """RAW source -> clean -> a new version of the Parquet table ``target``; returns that version.

    The rows go to a folder of their own, are counted there against the rows
    written, and become visible when the manifest is committed
    (:mod:`petitionlens.sources.snapshots`); a failed load changes nothing.

    ``mode='ignore'`` leaves a table with rows alone (the load runs once).  A
    plain Parquet folder counts as such a table if its writer's mark is there;
    rows without one raise :class:`UnmarkedTable` and stay.  ``'overwrite'``
    forces a refresh: readers of the old version go on.  ``'append'`` adds to
    the table.  Of two loads that begin on the same version one commits first;
    the other then returns that version (ignore), appends to it, or raises
    ConcurrentLoad (overwrite, error).  Partitioning by ``year`` lets every
    year-filtered analysis read only its years.

    With ``bad_records='quarantine'`` CSV rows that do not fit are written as
    text below the folder ``quarantine`` (with their number logged) and the
    others are loaded; by default such a row fails the load.
    """
    if bad_records == "quarantine" and not quarantine:
        raise ValueError("name the folder for quarantined rows")
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    seen = manifest(spark, target)
    filled, marked = (seen.rows > 0, True) if seen else plain_rows(spark, target)
    if filled and mode == "ignore":
        if not marked:
            raise UnmarkedTable(f"{target} has rows but neither a manifest nor _SUCCESS; overwrite it, or mark it as finished")
        return read_petitions(spark, target)
    if filled and mode in ("error", "errorifexists"):
        raise ValueError(f"{target} has rows already")
    if path_exists(spark, f"{target.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{target} is written by a stream; batch writes to it would not be read")
    if filled and seen is None and mode == "append":
        raise ValueError(f"{target} is a plain folder; bring it under versions with migrate() first")
    raw = read_raw(spark, source, fmt=fmt, bad_records=bad_records, **options)
    if CORRUPT in raw.columns:
        raw = set_apart(raw, source, target, quarantine)
    written = Observation("written")
    load = write_load(clean_petitions(raw).observe(written, F.count(F.lit(1)).alias("n")), target, partition_by)
    have, want = stored_rows(spark, target, load), written.get["n"]
    if have != want:
        raise RuntimeError(f"{target}/{load} holds {have} rows after a load that makes {want}")
    while True:
        before = list(seen.loads) if seen and mode == "append" else []
        try:
            return read_snapshot(spark, target, commit(spark, target, seen, [*before, (load, have)]).version)
        except ConcurrentLoad:
            if mode not in ("ignore", "append"):
                raise
            seen = manifest(spark, target)
            if mode == "ignore" and seen.rows:
                return read_petitions(spark, target)


def migrate(spark: SparkSession, target: str, partition_by: Sequence[str] = ("year",)) -> tuple[DataFrame, dict[str, int]]:
    """Bring a stored table of an older schema to CLEAN, as a new version; returns it and, by column, the
    values that did not fit.

    A missing column becomes NULL, another type is cast; a value that its new
    type cannot hold becomes NULL and is counted (and logged).  Columns that
    CLEAN does not know are left out.  The old files stay until they are
    expired (versions) or deleted (a plain folder).
    """
    known = versions(spark, target)
    after = Manifest(known[-1], ()) if known else None
    base, paths = target, [target]
    if known:
        base = f"{target.rstrip('/')}/{LOADS}"
        listed = json.loads(Folder(spark, f"{target.rstrip('/')}/{MANIFESTS}").read(manifest_name(known[-1])))
        paths = [f"{target.rstrip('/')}/{x['path']}" for x in listed["loads"] if x["rows"]]
    old = spark.read.option("basePath", base).parquet(*paths)
    have = {f.name.lower(): f.dataType.simpleString() for f in old.schema.fields}
    columns, unfit = [], []
    for f in CLEAN.fields:
        if f.name not in have:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        new = F.col(f.name).try_cast(f.dataType)
        columns.append(new.alias(f.name))
        if have[f.name] != f.dataType.simpleString():
            unfit.append(F.count_if(F.col(f.name).isNotNull() & new.isNull()).alias(f.name))
    told = Observation("migrated")
    old = old.observe(told, F.count(F.lit(1)).alias("__rows__"), *unfit)
    load = write_load(old.select(columns), target, partition_by)
    counts = dict(told.get)
    rows = counts.pop("__rows__")
    if (stored := stored_rows(spark, target, load)) != rows:
        raise RuntimeError(f"{target}/{load} holds {stored} rows of {rows}")
    log.warning("%s: migrated %d rows, values that did not fit: %s", target, rows, counts)
    return read_snapshot(spark, target, commit(spark, target, after, [(load, rows)]).version), counts


def run_catalogue(
    petitions: DataFrame,
    groups: Sequence[str] | None = ("basic", "additional", "task", "timing"),
    *,
    shared: bool = True,
    params: dict[str, dict] | None = None,
    exact_ids: bool | str = "check",
) -> dict[str, DataFrame]:
    """DataFrames of the analyses in ``groups`` over the clean table.

    ``shared=True`` (the default) reads the table once per group-by key and
    stores each per-key summary in the shared folder now; the answers then
    read only those summaries.  ``shared=False`` returns one lazy,
    independent plan per analysis.

    ``exact_ids=True`` answers the id-sensitive analyses exactly when ids
    repeat, ``False`` takes ids as unique, and ``'check'`` (the default) looks
    for a repeated or NULL id once, if an id-sensitive analysis is asked for,
    and logs which of the two it then does.
    """
    if exact_ids == "check":
        sensitive = any(w.id_sensitive for w in select(groups).values())
        exact_ids = sensitive and not duplicate_ids(petitions).isEmpty()
        if sensitive:
            log.warning("ids %s", "repeat or are NULL: exact id joins" if exact_ids else "are unique: single-pass plans")
    if shared:
        return run_catalogue_shared(petitions, params, groups, exact_ids=exact_ids)
    params = params or {}
    out = {}
    for key, w in select(groups).items():
        if w.source == "clean":
            extra = {"exact_ids": True} if exact_ids and w.id_sensitive else {}
            out[key] = w.run(petitions, **params.get(key, {}), **extra)
    return out
