"""Shared scans: every answer equals the one-at-a-time answer, in order."""

from __future__ import annotations

import re

import pytest

from petitionlens.plans.catalogue import CATALOGUE
from tools.plan_inspect import final_plan, physical_plan, summary
from petitionlens.plans.shared import catalogue_specs, run_catalogue_shared, summaries

from helpers import ANALYSIS
from test_properties import _random_rows

PARAMS = {"cert_state_year_count": {"state": "AMERICA"}}
UNORDERED = {"denied_vs_cert_wage"}  # a distinct union of two rows has no defined order


def _same_as_alone(df, params, checkpoint=True):
    shared = run_catalogue_shared(df, params, checkpoint=checkpoint)
    bad = []
    for key, w in CATALOGUE.items():
        if w.source != "clean":
            continue
        alone = w.run(df, **params.get(key, {}))
        got = shared[key]
        have, want = [tuple(r) for r in got.collect()], [tuple(r) for r in alone.collect()]
        if key in UNORDERED:
            have, want = sorted(have, key=repr), sorted(want, key=repr)
        if got.columns != alone.columns or have != want:
            bad.append(key)
    return bad


def test_shared_equals_alone_on_projection(small):
    assert _same_as_alone(small, PARAMS) == []


@pytest.mark.parametrize("seed", [11, 12])
def test_shared_equals_alone_on_random_tables(spark, seed):
    data = _random_rows(seed, 500)
    df = spark.createDataFrame([tuple(r[f.name] for f in ANALYSIS.fields) for r in data], ANALYSIS)
    params = {"cert_state_year_count": {"state": "TEXAS"}}
    assert _same_as_alone(df, params, checkpoint=False) == []


def test_one_scan_per_key(spark, small):
    import os

    from petitionlens.session import shared_dir

    path = os.path.join(shared_dir(spark), "shared-petitions")
    small.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    specs = catalogue_specs(PARAMS)
    parts = summaries(stored, specs)
    keys = {k for k in parts}
    assert keys == {("soc_name",), ("job_title",), ("state",), ("worksite",), ("employer_name",),
                    ("full_time_position",), ("year",), ()}
    assert sum(len(names) for _, names in parts.values()) == len(specs) == 30  # 33 minus A1, A19, T3
    occupation, names = parts[("soc_name",)]
    assert len(names) == 14
    s = summary(physical_plan(occupation))
    assert (s["scans"], s["joins"], s["hash_exchanges"]) == (1, 0, 1)
    # The wide summary (dozens of aggregates) still runs in whole-stage codegen.
    plan = final_plan(occupation)
    assert re.search(r"\*\(\d+\) HashAggregate", plan) and "partial_" in plan


def test_report_previews_every_answer(small):
    from petitionlens.plans.ingest import run_catalogue
    from petitionlens.plans.report import report

    answers = run_catalogue(small, groups=("basic", "task"), params=PARAMS)
    text = report(answers, groups=("basic", "task"))
    assert text.startswith("### BASIC QUERIES ###") and "### TASKS ###" in text
    for ident in ("B1", "B2", "B3", "B4", "K1", "K2", "K3"):
        assert f"## {ident} " in text
    assert "ADDITIONAL" not in text


def test_answers_written_concurrently_equal_the_answers(spark, small, scratch):
    from petitionlens.sources import write_answers

    answers = run_catalogue_shared(small, PARAMS, groups=("basic", "timing"))
    paths = write_answers(answers, scratch + "/answers", concurrency=4)
    assert set(answers) - set(paths) == {"petitions_in_year"}  # rows of the table are stored only on demand
    paths |= write_answers(answers, scratch + "/rows", rows_of=("petitions_in_year",), concurrency=4)
    assert set(paths) == set(answers)
    for name, path in paths.items():
        stored = spark.read.parquet(path)
        assert stored.columns == answers[name].columns
        assert stored.exceptAll(answers[name]).count() == 0 and answers[name].exceptAll(stored).count() == 0


def test_shared_catalogue_with_exact_ids_on_repeated_ids(spark):
    import duckdb

    from oracle_check import rows_of
    from tools import oracle_sql
    from test_properties import _arrow

    data = _random_rows(31, 300, repeated_ids=True)
    df = spark.createDataFrame([tuple(r[f.name] for f in ANALYSIS.fields) for r in data], ANALYSIS)
    answers = run_catalogue_shared(df, {"cert_state_year_count": {"state": "TEXAS"}}, exact_ids=True)
    con = duckdb.connect()
    con.register("p_input", _arrow(data))
    stmts = oracle_sql.statements()
    stmts["cert_state_year_count"] = oracle_sql.cert_state_year_count("TEXAS", 2016)
    bad = []
    for key, got in answers.items():
        cur = con.execute(stmts[key].replace(oracle_sql.PETITIONS, "SELECT * FROM p_input"))
        want = rows_of([c[0] for c in cur.description], cur.fetchall())
        if rows_of(got.columns, [tuple(r) for r in got.collect()]) != want:
            bad.append(key)
    assert len(answers) == 33 and bad == []


def test_an_answer_reads_its_own_columns_until_released(small):
    import pytest

    from petitionlens.plans.shared import release

    answers = run_catalogue_shared(small, PARAMS, groups=("basic", "additional", "task", "timing"))
    plan = physical_plan(answers["certs_by_soc"])
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert schema.count("__") == 2  # its row count and its one aggregate
    assert answers["certs_by_soc"].count() == 26
    release(answers)
    with pytest.raises(Exception):
        answers["certs_by_soc"].count()


def test_concurrent_actions_keep_the_callers_job_group(spark, small):
    from petitionlens.plans.actions import act_concurrently

    spark.sparkContext.setJobGroup("together", "together")
    seen = act_concurrently(
        {"a": small, "b": small}, lambda name, df: df.sparkSession.sparkContext.getLocalProperty("spark.jobGroup.id")
    )
    spark.sparkContext.setJobGroup("tests", "tests")
    assert seen == {"a": "together", "b": "together"}
