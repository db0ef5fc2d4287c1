"""Every registered query against its join-form DuckDB oracle (sf0.001)."""

from __future__ import annotations

import re

import __spark_entry__ as entry_module
from oracle_check import compare
from petitionlens.plans.catalogue import CATALOGUE

from scale import SF_SMALL

# Expected row counts at sf0.001 (independently computed on the projection).
EXPECTED_ROWS = {
    "soc_six_year_certs": 21, "job_six_year_certs": 2, "soc_six_year_wages": 21, "job_six_year_wages": 2,
    "max_cert_wage_by_job": 149, "min_cert_wage_by_job": 149, "employer_certs_and_pay": 148,
    "soc_yoy_2011_2012": 25, "soc_yoy_2012_2013": 24, "soc_yoy_2013_2014": 24, "soc_yoy_2014_2015": 24,
    "soc_yoy_2015_2016": 22, "soc_denied_vs_cert_wage": 25, "denied_vs_cert_wage": 2,
    "certs_by_state": 6, "certs_by_worksite": 46, "cert_rate_by_full_time": 2, "denials_by_job": 146,
    "denial_rate_by_state": 5, "denial_rate_by_worksite": 43, "modal_soc_by_state": 6,
    "withdrawn_by_soc": 26, "withdrawn_by_job": 144, "soc_years_pivot": 25, "certs_by_soc": 26,
    "certs_by_soc_rows": 26, "petitions_in_year": 229, "cert_rate_by_year": 7, "all_petitions": 1500,
    "clean_petitions": 1500,
}


def own_queries():
    """The registered queries but those of the corpus operators, which have tests of their own."""
    return [k for k in entry_module.queries() if k != "pipeline" and not re.match(r"op\d+_", k)]


def test_registry_is_complete():
    q, o = set(entry_module.queries()), set(entry_module.oracle_sql())
    assert set(CATALOGUE) <= q and set(CATALOGUE) <= o <= q
    assert len(CATALOGUE) == 34


def test_all_queries_match_oracle(spark):
    results = compare(spark, SF_SMALL, own_queries())
    bad = {k: r for k, r in results.items() if not (r["values_match"] and r["columns_match"] and r["types_match"])}
    assert bad == {}
    counts = {k: r["spark_rows"] for k, r in results.items() if k in EXPECTED_ROWS}
    assert counts == EXPECTED_ROWS


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.count() == 21
    assert df.columns[0] == "soc_name" and df.columns[-1] == "net_change"


def test_values_recorded_in_fixtures(small):
    """Values FIXTURES.md records for sf0.001, computed independently there."""
    from petitionlens.plans import catalogue as C

    assert C.cert_state_year_count(small, state="AMERICA").first()[0] == 20
    b2 = C.top10_soc_max_rate(small).first()
    b3 = C.top10_soc_min_rate(small).first()
    assert (b2[0], round(b2[1], 5)) == ("MACHINERY NOT SPECIFIED", 0.57377)
    assert (b3[0], round(b3[1], 5)) == ("BUILDING HIGH", 0.34524)
    assert C.withdrawn_count(small).first()[0] == 479
