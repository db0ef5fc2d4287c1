"""Answers from stored states equal answers from rows, and an append reads only its own rows."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from petitionlens.plans import states as P
from petitionlens.plans.catalogue import CATALOGUE
from petitionlens.plans.shared import catalogue_specs
from petitionlens.schema import CLEAN
from petitionlens.sources import snapshots as S

from test_shared import PARAMS, UNORDERED


def store(spark, target, df):
    df = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in CLEAN.fields])
    load = S.write_load(df, target, ("year",))
    seen = S.manifest(spark, target)
    return S.commit(spark, target, seen, [*(seen.loads if seen else ()), (load, df.count())])


def differing(spark, target, specs):
    answers, rows = P.run_incremental(spark, target, specs), S.read_snapshot(spark, target)
    bad = []
    for key in specs:
        alone = CATALOGUE[key].run(rows, **PARAMS.get(key, {}))
        have, want = [tuple(r) for r in answers[key].collect()], [tuple(r) for r in alone.collect()]
        if key in UNORDERED:
            have, want = sorted(have, key=repr), sorted(want, key=repr)
        if answers[key].columns != alone.columns or answers[key].dtypes != alone.dtypes or have != want:
            bad.append(key)
    return bad


def marks(target):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{target}/_loads/*/_states/*/_SUCCESS")}


def test_append_reads_only_new_rows_and_equals_a_full_run(spark, small, tmp_path):
    target, specs = str(tmp_path / "t"), catalogue_specs(PARAMS)
    store(spark, target, small.where("id % 3 = 0"))
    assert differing(spark, target, specs) == []
    first = marks(target)
    assert len(first) == 8
    store(spark, target, small.where("id % 3 <> 0"))
    assert differing(spark, target, specs) == []
    second = marks(target)
    assert len(second) == 16 and all(second[p] == t for p, t in first.items())
    broken = next(iter(first))  # a write that was killed
    os.remove(broken)
    one = {"certs_by_soc": specs["certs_by_soc"]}
    assert differing(spark, target, specs) == [] and marks(target)[broken] != first[broken]
    assert differing(spark, target, one) == []  # other analyses of a key have states of their own
    assert S.read_snapshot(spark, target).count() == small.count()


def test_empty_table(spark, small, tmp_path):
    target = str(tmp_path / "t")
    store(spark, target, small.where("false"))
    specs = catalogue_specs(PARAMS)
    assert differing(spark, target, specs) == []
