"""Ingest: cleaning rules (N1-N4), CSV reading (N17, N18), sinks and schema checks."""

from __future__ import annotations

import glob
import os
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from petitionlens.operators import clean_petitions
from petitionlens.schema import CLEAN, RAW, SchemaMismatch, require
from petitionlens.sources import (
    petitions,
    raw_petitions,
    read_petitions,
    read_petitions_csv,
    write_petitions,
)

from scale import SF_SMALL


def _raw(spark, **overrides):
    base = dict(
        id=1, case_status="CERTIFIED", employer_name="ACME", soc_name="analysts", job_title="DEV",
        full_time_position="Y", prevailing_wage="100", year="2016", worksite="A, B", lon="1.5", lat="2.5",
    )
    base.update(overrides)
    return base


def _clean_rows(spark, raws):
    df = spark.createDataFrame([tuple(r[f.name] for f in RAW.fields) for r in raws], RAW)
    return clean_petitions(df).collect()


def test_wage_text_truncates_like_legacy_cast(spark):
    cases = [
        ("36067.6", 36067), ("-5.9", -5), (" 12 ", 12), ("+7", 7), ("5.", 5),
        ("1e5", None), ("1,000", None), ("", None), ("12345678901234567890", None), ("NA", None),
        ("abc", None), (None, None), (".5", 0), ("-.5", 0), ("-", None), ("\x0012\x01", 12),
    ]
    raws = [_raw(spark, id=i, prevailing_wage=w) for i, (w, _) in enumerate(cases)]
    got = {r.id: r.prevailing_wage for r in _clean_rows(spark, raws)}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_year_and_coordinates(spark):
    raws = [
        _raw(spark, id=1, year="2016", lon="-12.25", lat="4.5"),
        _raw(spark, id=2, year="2016.0", lon="NA", lat="NA"),
        _raw(spark, id=3, year="NA", lon="x", lat=""),
        _raw(spark, id=4, year="99999999999", lon=" 3 ", lat="1e2"),
    ]
    got = {r.id: (r.year, r.lon, r.lat) for r in _clean_rows(spark, raws)}
    assert got == {1: (2016, -12.25, 4.5), 2: (2016, None, None), 3: (None, None, None), 4: (None, 3.0, 100.0)}


def test_worksite_split_rules(spark):
    sites = ["NA", "A", "A, B", "A, B, C", "A,", None]
    raws = [_raw(spark, id=i, worksite=w) for i, w in enumerate(sites)]
    got = {r.id: (r.worksite, r.city, r.state) for r in _clean_rows(spark, raws)}
    assert got == {
        0: ("NA", "NA", None),
        1: ("A", "A", None),
        2: ("A, B", "A", "B"),
        3: ("A, B, C", "A", "B"),
        4: ("A,", "A", ""),
        5: (None, None, None),
    }


def test_missing_marker_is_exact_except_soc(spark):
    raws = [
        _raw(spark, id=1, soc_name="na", job_title="na", case_status="NA", employer_name=" NA"),
        _raw(spark, id=2, soc_name="NA", job_title="NA", full_time_position="NA"),
        _raw(spark, id=3, soc_name="Software Dev", job_title="Na"),
    ]
    got = {r.id: r for r in _clean_rows(spark, raws)}
    assert got[1].soc_name is None and got[1].job_title == "na"
    assert got[1].case_status is None and got[1].employer_name == " NA"
    assert got[2].soc_name is None and got[2].job_title is None and got[2].full_time_position is None
    assert got[3].soc_name == "SOFTWARE DEV" and got[3].job_title == "Na"


def test_clean_runs_under_ansi_without_errors(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    raws = [_raw(spark, id=1, prevailing_wage="NA", year="x", lon="?", lat="NA")]
    (r,) = _clean_rows(spark, raws)
    assert (r.prevailing_wage, r.year, r.lon, r.lat) == (None, None, None, None)


def test_csv_quotes_and_positional_header(spark, scratch):
    path = os.path.join(scratch, "raw.csv")
    with open(path, "w") as fh:
        # Header names deliberately differ: columns bind by position.
        fh.write("a,b,c,d,e,f,g,h,i,j,k\n")
        fh.write('7,CERTIFIED,"ACME ""BIG"" CO",analysts,DEV,Y,1000.5,2016,"AUSTIN, TEXAS",-97.7,30.2\n')
        fh.write("8,DENIED,,na,NA,N,NA,NA,NA,NA,NA\n")
    df = read_petitions_csv(spark, path)
    require(df, RAW)
    got = {r.id: r for r in clean_petitions(df).collect()}
    assert got[7].employer_name == 'ACME "BIG" CO'
    assert (got[7].city, got[7].state) == ("AUSTIN", "TEXAS")
    assert (got[7].prevailing_wage, got[7].year) == (1000, 2016)
    assert got[8].employer_name is None  # unquoted empty field
    assert got[8].soc_name is None and got[8].prevailing_wage is None
    assert (got[8].city, got[8].state) == ("NA", None)


def test_raw_csv_round_trip_restores_projection(spark, scratch):
    """RAW text written as CSV, read back and cleaned, equals the projection."""
    raw = require(raw_petitions(spark, SF_SMALL), RAW)
    require(clean_petitions(raw), CLEAN)
    out = os.path.join(scratch, "csv")
    raw.write.option("header", True).option("escape", '"').csv(out)
    cleaned = clean_petitions(read_petitions_csv(spark, out))
    cols = [c for c in cleaned.columns if c not in ("lon", "lat")]
    want = petitions(spark, SF_SMALL).select(cols)
    assert cleaned.count() == 1500
    assert cleaned.select(cols).exceptAll(want).count() == 0
    assert want.exceptAll(cleaned.select(cols)).count() == 0
    coords = cleaned.where(F.col("id") % 5 != 0).select("id", "lon", "lat").limit(3).collect()
    for r in coords:
        assert r.lon == -float(f"{r.id % 90}.25") and r.lat == float(f"{r.id % 45}.5")


def test_sink_modes_and_schema(spark, scratch):
    clean = clean_petitions(raw_petitions(spark, SF_SMALL))
    path = os.path.join(scratch, "pq")
    write_petitions(clean, path)
    stored = read_petitions(spark, path)
    require(stored, CLEAN)
    assert stored.count() == 1500
    with pytest.raises(Exception):
        write_petitions(clean, path)  # default mode refuses to touch existing data
    write_petitions(clean.limit(10), path, mode="ignore")
    assert read_petitions(spark, path).count() == 1500
    write_petitions(clean.limit(10), path, mode="overwrite")
    assert read_petitions(spark, path).count() == 10
    with pytest.raises(ValueError):
        write_petitions(clean, path, mode="replace")


def test_partitioned_sink_prunes_and_keeps_column_order(spark, scratch):
    clean = clean_petitions(raw_petitions(spark, SF_SMALL))
    path = os.path.join(scratch, "by_year")
    write_petitions(clean, path, partition_by=("year",))
    stored = read_petitions(spark, path)
    assert stored.columns == [f.name for f in CLEAN.fields]
    assert stored.count() == 1500
    assert stored.where(F.col("year").isNull()).count() == clean.where(F.col("year").isNull()).count()
    one = stored.where(F.col("year") == 2011)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert one.count() == clean.where(F.col("year") == 2011).count()


def test_schema_require_rejects_mismatch(spark):
    df = spark.createDataFrame([Row(id=1, case_status="X")])
    with pytest.raises(SchemaMismatch):
        require(df, CLEAN)
    with pytest.raises(SchemaMismatch):
        require(df, CLEAN, subset=True)
    require(df.select("id"), CLEAN.__class__([CLEAN["id"]]))


def test_ingest_job_and_catalogue_groups(spark, scratch):
    from petitionlens.plans.ingest import ingest, read_raw, run_catalogue

    src = os.path.join(scratch, "landing")
    raw_petitions(spark, SF_SMALL).write.option("header", True).csv(src)
    target = os.path.join(scratch, "table")
    stored = ingest(spark, src, target)
    assert stored.count() == 1500
    again = ingest(spark, src + "/part-*", target)  # idempotent: the table is left alone
    assert again.count() == 1500
    basic = run_catalogue(stored, groups=("basic",))
    assert sorted(basic) == ["cert_rate_by_year", "cert_state_year_count", "top10_soc_max_rate", "top10_soc_min_rate"]
    assert basic["cert_rate_by_year"].count() == 7

    # A table source binds by name, case-insensitively.
    pq = os.path.join(scratch, "raw_table")
    raw = raw_petitions(spark, SF_SMALL)
    raw.toDF(*[c.upper() for c in raw.columns]).write.parquet(pq)
    assert read_raw(spark, pq, fmt="parquet").columns == [f.name for f in RAW.fields]

    # A table that types its numbers (int id, double wage) is cleaned the same way.
    typed = os.path.join(scratch, "typed_table")
    raw.select(
        F.col("id").cast("int").alias("ID"),
        *[F.col(c) for c in raw.columns if c not in ("id", "prevailing_wage")],
        F.col("prevailing_wage").try_cast("double").alias("PREVAILING_WAGE"),
    ).write.parquet(typed)
    cleaned = clean_petitions(read_raw(spark, typed, fmt="parquet"))
    want = clean_petitions(raw)
    assert cleaned.select("id", "prevailing_wage").exceptAll(want.select("id", "prevailing_wage")).count() == 0


def test_rebalanced_sink_splits_a_heavy_year(spark, scratch):
    """A third of the rows in one year, all ids NULL: several even files there, one for a light year."""
    from scale import conf

    rows = spark.range(0, 90_000, 1, 12).select(
        F.lit(None).cast("bigint").alias("id"),
        *[F.sha2(F.concat(F.lit(c), F.col("id").cast("string")), 256).alias(c)
          for c in ("case_status", "employer_name", "soc_name", "job_title", "full_time_position")],
        F.col("id").alias("prevailing_wage"),
        F.when(F.col("id") % 3 == 0, 2011).otherwise(2012 + F.col("id") % 60).cast("int").alias("year"),
        F.lit("X, Y").alias("worksite"), F.lit(1.0).alias("lon"), F.lit(1.0).alias("lat"),
        F.lit("X").alias("city"), F.lit("Y").alias("state"),
    )
    path = os.path.join(scratch, "rebalanced")
    with conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}):
        write_petitions(rows, path, partition_by=("year",))
    files = {d: [os.path.getsize(f) for f in glob.glob(f"{path}/year={d}/*.parquet")] for d in (2011, 2012)}
    assert len(files[2011]) >= 4 and max(files[2011]) < 3 * min(files[2011])
    assert len(files[2012]) <= 2
    assert read_petitions(spark, path).count() == 90_000


def _typed_table(spark, path, wages, kind):
    rows = [tuple(_raw(spark, id=i)[f.name] if f.name != "prevailing_wage" else w for f in RAW.fields) for i, w in enumerate(wages)]
    schema = RAW.__class__([f if f.name != "prevailing_wage" else f.__class__(f.name, kind) for f in RAW.fields])
    spark.createDataFrame(rows, schema).write.parquet(path)


@pytest.mark.parametrize("kind", ["double", "decimal(20,2)", "bigint"])
def test_typed_wages_of_any_size(spark, scratch, kind):
    from pyspark.sql import types as T

    from petitionlens.plans.ingest import read_raw

    wages = [36067.6, 9999999.0, 12000000.0, 1e8, 1.5e9, -2.5e7, None] + ([float("nan"), 1e300] if kind == "double" else [])
    if kind == "bigint":
        wages = [None if w is None else int(w) for w in wages]
    elif kind != "double":
        wages = [None if w is None else Decimal(str(w)) for w in wages]
    path = os.path.join(scratch, "typed")
    _typed_table(spark, path, wages, T._parse_datatype_string(kind))
    got = {r.id: r.prevailing_wage for r in clean_petitions(read_raw(spark, path, fmt="parquet")).collect()}
    assert [got[i] for i in range(len(wages))] == [36067, 9999999, 12000000, 10**8, 1500000000, -25000000, None, None, None][: len(wages)]


def _csv(path, lines):
    with open(path, "w") as fh:
        fh.write("id,a,b,c,d,e,f,g,h,i,j\n" + "".join(x + "\n" for x in lines))


GOOD = "1,CERTIFIED,ACME,analysts,DEV,Y,100,2016,\"A, B\",1.5,2.5"
BAD = [GOOD.replace("1,", "abc,", 1), "3,CERTIFIED,ACME,analysts,DEV,Y,100,2016", GOOD.replace("1,", "4,", 1) + ",more"]


@pytest.mark.parametrize("line", BAD)
def test_a_bad_record_fails_the_load(spark, scratch, line):
    from petitionlens.plans.ingest import ingest, is_loaded

    src, target = os.path.join(scratch, "raw.csv"), os.path.join(scratch, "table")
    _csv(src, [GOOD, line])
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest(spark, src, target)
    assert not is_loaded(spark, target)
    _csv(src, [GOOD])
    assert ingest(spark, src, target).count() == 1  # the retry is not put off by what the failed load left


def test_bad_records_are_quarantined_and_counted(spark, scratch, caplog):
    from petitionlens.plans.ingest import ingest

    src, target, apart = (os.path.join(scratch, n) for n in ("raw.csv", "table", "apart"))
    _csv(src, [GOOD, *BAD])
    stored = ingest(spark, src, target, bad_records="quarantine", quarantine=apart)
    assert [r.id for r in stored.collect()] == [1]
    assert sorted(r.value for r in spark.read.text(apart).collect()) == sorted(BAD)
    assert "3 rows quarantined" in caplog.text


def test_an_empty_or_half_written_table_is_loaded(spark, scratch):
    from petitionlens.plans.ingest import ingest

    src = os.path.join(scratch, "raw.csv")
    _csv(src, [GOOD])
    for name in ("absent", "folder", "empty"):
        target = os.path.join(scratch, name)
        if name == "folder":
            os.makedirs(os.path.join(target, "_temporary"))
        if name == "empty":
            clean_petitions(read_petitions_csv(spark, src)).limit(0).write.parquet(target)
        assert ingest(spark, src, target).count() == 1


def test_stored_schema_is_verified(spark, scratch):
    clean = clean_petitions(raw_petitions(spark, SF_SMALL))
    for name, df in (("lost", clean.drop("state")), ("typed", clean.withColumn("prevailing_wage", F.col("prevailing_wage").cast("string")))):
        path = os.path.join(scratch, name)
        df.write.parquet(path)
        with pytest.raises(SchemaMismatch):
            read_petitions(spark, path)
    path = os.path.join(scratch, "order")
    clean.select(*reversed(clean.columns)).write.parquet(path)
    assert read_petitions(spark, path).columns == [f.name for f in CLEAN.fields]


def test_repeated_ids_are_noticed(spark):
    from helpers import rows, table
    from petitionlens.plans.catalogue import CATALOGUE
    from petitionlens.plans.ingest import run_catalogue

    data = [dict(id=i // 2, case_status="CERTIFIED" if i % 2 else "DENIED", worksite="A, B", state="B") for i in range(4)]
    twice = table(spark, data)
    got = rows(run_catalogue(twice, groups=("additional",))["certs_by_state"])
    assert got == rows(CATALOGUE["certs_by_state"].run(twice, exact_ids=True)) != rows(CATALOGUE["certs_by_state"].run(twice))
