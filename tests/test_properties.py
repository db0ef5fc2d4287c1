"""Properties on random tables: single-pass (Spark) == join form (DuckDB).

Small vocabularies make ties, NULL keys, missing years, zero-hit keys and
all-NULL wage groups common.  Ids are unique in the default tables; the
repeated-id tables check the ``exact_ids`` mode.
"""

from __future__ import annotations

import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tools import oracle_sql
from petitionlens.plans.catalogue import CATALOGUE, cert_state_year_count

from helpers import ANALYSIS
from oracle_check import rows_of

STATUSES = ["CERTIFIED", "CERTIFIED-WITHDRAWN", "DENIED", "WITHDRAWN", "DECERTIFIED", "PENDING", None]
SOCS = ["ANALYST", "ENGINEER", "NURSE", "TEACHER", None]
JOBS = ["J1", "J2", "J3", None]
EMPLOYERS = ["E1", "E2", "E3", "E4", None]
SITES = ["AUSTIN, TEXAS", "DALLAS, TEXAS", "MIAMI, FLORIDA", "NA", "RENO", "X, Y, Z", "LONE,"]


def _random_rows(seed: int, n: int, *, repeated_ids: bool = False):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        ident = i * 3 + 1
        if repeated_ids:
            ident = None if rnd.random() < 0.05 else rnd.randint(1, max(2, n // 3))
        site = rnd.choice(SITES)
        parts = [p.strip() for p in site.split(",")]
        out.append(
            dict(
                id=ident,
                case_status=rnd.choice(STATUSES),
                employer_name=rnd.choice(EMPLOYERS),
                soc_name=rnd.choice(SOCS),
                job_title=rnd.choice(JOBS),
                full_time_position=rnd.choice(["Y", "N", None]),
                prevailing_wage=None if rnd.random() < 0.2 else rnd.randint(1, 9) * 1000,
                year=rnd.choice([2010, 2011, 2012, 2013, 2014, 2015, 2016, 2017, None]),
                worksite=site,
                city=parts[0],
                state=parts[1] if len(parts) > 1 else None,
            )
        )
    return out


def _arrow(rows):
    types = {"id": pa.int64(), "prevailing_wage": pa.int64(), "year": pa.int32()}
    fields = [pa.field(f.name, types.get(f.name, pa.string())) for f in ANALYSIS.fields]
    return pa.Table.from_pylist(rows, schema=pa.schema(fields))


KEYS = [k for k, w in CATALOGUE.items() if w.source == "clean"]


def _compare_all(spark, data, *, exact_ids: bool) -> list[str]:
    df = spark.createDataFrame([tuple(r[f.name] for f in ANALYSIS.fields) for r in data], ANALYSIS)
    con = duckdb.connect()
    con.register("p_input", _arrow(data))
    stmts = oracle_sql.statements()
    stmts["cert_state_year_count"] = oracle_sql.cert_state_year_count("TEXAS", 2016)
    bad = []
    for key in KEYS:
        if key == "cert_state_year_count":
            got = cert_state_year_count(df, state="TEXAS", year=2016)
        elif exact_ids and CATALOGUE[key].id_sensitive:
            got = CATALOGUE[key].run(df, exact_ids=True)
        else:
            got = CATALOGUE[key].run(df)
        sql = stmts[key].replace(oracle_sql.PETITIONS, "SELECT * FROM p_input")
        cur = con.execute(sql)
        want_cols = [c[0] for c in cur.description]
        want = rows_of(want_cols, cur.fetchall())
        have = rows_of(got.columns, [tuple(r) for r in got.collect()])
        if sorted(got.columns) != sorted(want_cols) or have != want:
            bad.append(key)
    return bad


@pytest.mark.parametrize("seed,n", [(1, 60), (2, 300), (3, 800)])
def test_single_pass_equals_join_form(spark, seed, n):
    assert _compare_all(spark, _random_rows(seed, n), exact_ids=False) == []


@pytest.mark.parametrize("seed,n", [(6, 90), (7, 400)])
def test_exact_ids_mode_equals_join_form_with_repeated_ids(spark, seed, n):
    """With repeated and NULL ids, ``exact_ids=True`` still matches the join form."""
    data = _random_rows(seed, n, repeated_ids=True)
    assert len({r["id"] for r in data}) < n  # ids really repeat
    assert _compare_all(spark, data, exact_ids=True) == []


def test_default_mode_differs_only_on_id_sensitive_keys(spark):
    data = _random_rows(8, 400, repeated_ids=True)
    bad = _compare_all(spark, data, exact_ids=False)
    assert bad and all(CATALOGUE[k].id_sensitive for k in bad)


@pytest.mark.parametrize("seed", [4, 5])
def test_counts_partition_the_total_and_rates_are_bounded(spark, seed):
    data = _random_rows(seed, 400)
    df = spark.createDataFrame([tuple(r[f.name] for f in ANALYSIS.fields) for r in data], ANALYSIS)
    certified = sum(1 for r in data if (r["case_status"] or "").startswith("CERTIFIED"))
    by_state = CATALOGUE["certs_by_state"].run(df).agg(F.sum("visa_requests")).first()[0]
    by_site = CATALOGUE["certs_by_worksite"].run(df).agg(F.sum("visa_requests")).first()[0]
    assert by_state == by_site == certified
    withdrawn = CATALOGUE["withdrawn_count"].run(df).first()[0]
    assert CATALOGUE["withdrawn_by_job"].run(df).agg(F.sum("withdrawn_visas")).first()[0] <= withdrawn
    for key, col in [("cert_rate_by_year", "certification_rate"), ("cert_rate_by_full_time", "rate_certified"),
                     ("denial_rate_by_state", "denied_ratio"), ("denial_rate_by_worksite", "denied_ratio")]:
        lo, hi = CATALOGUE[key].run(df).agg(F.min(col), F.max(col)).first()
        assert 0 < lo <= hi <= 1
