"""Plan shapes: one scan, no join, pushed filters, pruned columns, no Python."""

from __future__ import annotations

import os

import pytest

from petitionlens.plans.catalogue import CATALOGUE, cert_state_year_count
from tools.plan_inspect import final_plan, physical_plan, summary
from petitionlens.session import shared_dir
from petitionlens.sources import read_petitions, write_petitions

from scale import SF_SMALL

JOINED = {"modal_soc_by_state"}


@pytest.fixture(scope="module")
def stored(spark):
    from pyspark.sql import functions as F

    from petitionlens.schema import CLEAN
    from petitionlens.sources import petitions

    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # untruncated PushedFilters
    path = os.path.join(shared_dir(spark), "plans-petitions")
    p = petitions(spark, SF_SMALL)
    clean = p.select(*[F.col(c) if c in p.columns else F.lit(None).cast("double").alias(c)
                       for c in (f.name for f in CLEAN.fields)])
    write_petitions(clean, path, mode="overwrite")
    return read_petitions(spark, path)


@pytest.mark.parametrize("key", [k for k, w in CATALOGUE.items() if w.source == "clean"])
def test_every_analysis_is_one_scan_without_python(stored, key):
    s = summary(final_plan(CATALOGUE[key].run(stored)))
    assert s["scans"] == 1, s
    assert s["python"] == 0 and s["windows"] == 0, s
    if key in JOINED:
        assert s["joins"] == 1 and s["reused_exchanges"] == 1, s
    else:
        assert s["joins"] == 0, s
        assert s["hash_exchanges"] <= 1, s


def test_six_year_plan_is_one_group_by(stored):
    plan = physical_plan(CATALOGUE["soc_six_year_certs"].run(stored))
    s = summary(plan)
    assert (s["scans"], s["joins"], s["hash_exchanges"], s["range_exchanges"]) == (1, 0, 1, 1)
    assert "partial_count" in plan
    assert "ReadSchema: struct<case_status:string,soc_name:string,year:int>" in plan
    assert "StringStartsWith(case_status,CERTIFIED)" in plan
    assert "In(year, [2011,2012,2013,2014,2015,2016])" in plan


def test_filters_reach_the_scan(stored):
    plan = physical_plan(cert_state_year_count(stored, state="AMERICA", year=2016))
    assert "StringStartsWith(case_status,CERTIFIED)" in plan
    assert "EqualTo(state,AMERICA)" in plan and "EqualTo(year,2016)" in plan
    assert "ReadSchema: struct<case_status:string,year:int,state:string>" in plan
    w = physical_plan(CATALOGUE["withdrawn_by_job"].run(stored))
    assert "StringEndsWith(case_status,WITHDRAWN)" in w


def test_projection_join_is_declared_without_hints(spark):
    from petitionlens.sources import petitions

    plan = physical_plan(petitions(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan or "SortMergeJoin" in plan
    s = summary(plan)
    assert s["scans"] == 4 and s["python"] == 0
