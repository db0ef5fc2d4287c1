"""The stream of loads: each run is a version, done once, and bad rows are set apart."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from petitionlens.plans.catalogue import CATALOGUE
from petitionlens.plans.ingest import UnmarkedTable, ingest
from petitionlens.plans.states import run_incremental
from petitionlens.operators import clean_petitions
from petitionlens.sources import raw_petitions, read_petitions
from petitionlens.sources.snapshots import LOADS, manifest, versions
from petitionlens.streaming import ingest_available_loads, loads
from petitionlens.streaming.loads import append_load

from scale import SF_SMALL


def _land(rows, folder):
    rows.coalesce(1).write.option("header", True).option("escape", '"').csv(folder)


@pytest.fixture
def places(scratch):
    return {n: os.path.join(scratch, n) for n in ("landing", "table", "ckpt", "apart")}


def test_runs_are_versions_beside_batch_loads(spark, places):
    raw = raw_petitions(spark, SF_SMALL)
    landing, target = places["landing"], places["table"]
    raw.where("id % 3 = 0").write.parquet(places["apart"])
    ingest(spark, places["apart"], target, fmt="parquet")
    specs = {k: CATALOGUE[k].spec() for k in ("soc_six_year_wages", "certs_by_state")}
    for i in (1, 2):
        _land(raw.where(f"id % 3 = {i}"), os.path.join(landing, f"b{i}"))
        for _ in range(2):  # the second finds nothing new
            ingest_available_loads(spark, landing + "/*", target, progress=places["ckpt"])
        answers = run_incremental(spark, target, specs)
    assert versions(spark, target) == [1, 2, 3]
    stored = read_petitions(spark, target)
    assert stored.count() == 1500
    for k, answer in answers.items():
        assert answer.collect() == CATALOGUE[k].run(stored).collect()


def test_bad_rows_are_set_apart_and_stop_the_stream_otherwise(spark, places):
    raw = raw_petitions(spark, SF_SMALL).where("id < 400")
    _land(raw, os.path.join(places["landing"], "a"))
    bad = os.path.join(places["landing"], "b")
    os.makedirs(bad)
    with open(os.path.join(bad, "bad.csv"), "w") as f:
        f.write(",".join(raw.columns) + "\nnot a number,CERTIFIED\n")
    landing, target = places["landing"] + "/*", places["table"]
    with pytest.raises(PySparkException):
        ingest_available_loads(spark, landing, target + "-strict", progress=places["ckpt"] + "-strict")
    assert not versions(spark, target + "-strict")
    ingest_available_loads(spark, landing, target, progress=places["ckpt"], quarantine=places["apart"])
    assert read_petitions(spark, target).count() == raw.count()
    assert [r["value"] for r in spark.read.text(places["apart"]).select("value").collect()] == ["not a number,CERTIFIED"]


def test_a_run_that_dies_between_its_steps_is_finished_by_the_next(spark, places, monkeypatch):
    raw = raw_petitions(spark, SF_SMALL)
    landing, target, own = places["landing"] + "/*", places["table"], places["ckpt"]
    _land(raw.where("id % 2 = 0"), os.path.join(places["landing"], "a"))
    with monkeypatch.context() as m:  # rows are staged, but no load is written
        m.setattr(loads, "append_load", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest_available_loads(spark, landing, target, progress=own)
    assert not versions(spark, target)
    with monkeypatch.context() as m:  # the load is committed, but its staged files stay
        m.setattr(loads.Folder, "delete", lambda *_: None)
        ingest_available_loads(spark, landing, target, progress=own)
    before = manifest(spark, target)
    assert before.rows == raw.where("id % 2 = 0").count()
    ingest_available_loads(spark, landing, target, progress=own)
    assert manifest(spark, target) == before
    assert not [n for n in os.listdir(os.path.join(own, "staged")) if n.startswith("run=")]


def test_an_unfinished_attempt_is_replaced(spark, places):
    rows = clean_petitions(raw_petitions(spark, SF_SMALL))
    target = places["table"]
    rows.where("id < 100").write.parquet(f"{target}/{LOADS}/load=s-0")  # was killed before its commit
    assert append_load(rows, target, "s-0", ("year",)) == 1500
    assert read_petitions(spark, target).count() == 1500


def test_an_empty_run_makes_no_version_and_plain_folders_are_refused(spark, places):
    rows = clean_petitions(raw_petitions(spark, SF_SMALL))
    assert append_load(rows.where(F.lit(False)), places["table"], "s-1", ("year",)) == 0
    assert not versions(spark, places["table"])
    rows.limit(3).write.parquet(places["apart"])
    with pytest.raises(UnmarkedTable):
        ingest_available_loads(spark, places["landing"], places["apart"], progress=places["ckpt"])
