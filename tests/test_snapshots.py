"""Versions of stored tables: loads that fail, meet, append, refresh and migrate."""

from __future__ import annotations

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from petitionlens.operators import clean_petitions
from petitionlens.plans import ingest as I
from petitionlens.schema import CLEAN
from petitionlens.sources import read_petitions, read_petitions_csv, write_petitions
from petitionlens.sources import snapshots as S

LINE = '{},CERTIFIED,ACME,analysts,DEV,Y,100,2016,"A, B",1.5,2.5\n'


def csv(folder, name, ids):
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write("id,a,b,c,d,e,f,g,h,i,j\n" + "".join(LINE.format(i) for i in ids))
    return path


def ids(df):
    return sorted(r.id for r in df.collect())


def test_rows_without_a_mark_are_never_replaced(spark, scratch):
    target = os.path.join(scratch, "table")
    write_petitions(clean_petitions(read_petitions_csv(spark, csv(scratch, "five.csv", range(5)))), target)
    os.remove(os.path.join(target, "_SUCCESS"))
    with pytest.raises(I.UnmarkedTable):
        I.ingest(spark, csv(scratch, "two.csv", [8, 9]), target)
    assert ids(read_petitions(spark, target)) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        I.ingest(spark, csv(scratch, "two.csv", [8, 9]), target, mode="append")
    assert ids(I.ingest(spark, csv(scratch, "two.csv", [8, 9]), target, mode="overwrite")) == [8, 9]


def test_modes_make_versions(spark, scratch):
    target = os.path.join(scratch, "table")
    one, two = csv(scratch, "one.csv", [1]), csv(scratch, "two.csv", [2, 3])
    assert ids(I.ingest(spark, one, target)) == [1]
    assert ids(I.ingest(spark, two, target)) == [1]
    old = read_petitions(spark, target)
    assert ids(I.ingest(spark, two, target, mode="append")) == [1, 2, 3]
    assert ids(I.ingest(spark, two, target, mode="overwrite")) == [2, 3]
    assert ids(old) == [1]  # a reader of an old version goes on
    assert [ids(S.read_snapshot(spark, target, v)) for v in S.versions(spark, target)] == [[1], [1, 2, 3], [2, 3]]
    with pytest.raises(ValueError):
        I.ingest(spark, one, target, mode="error")
    with pytest.raises(ValueError):
        I.ingest(spark, one, target, mode="replace")
    assert len(S.expire(spark, target)) == 2 and S.versions(spark, target) == [3]
    assert ids(read_petitions(spark, target)) == [2, 3] and len(glob.glob(f"{target}/_loads/load=*")) == 1


def test_a_load_that_fails_leaves_the_old_version(spark, scratch):
    target = os.path.join(scratch, "table")
    I.ingest(spark, csv(scratch, "one.csv", [1]), target)
    broken = csv(scratch, "two.csv", range(50))
    with open(broken, "a") as fh:
        fh.write("x" + LINE.format(7))
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="(?i)malformed"):
            I.ingest(spark, broken, target, mode=mode)
        assert ids(read_petitions(spark, target)) == [1] and S.versions(spark, target) == [1]


def test_killed_between_write_and_commit(spark, scratch, monkeypatch):
    target = os.path.join(scratch, "table")
    I.ingest(spark, csv(scratch, "one.csv", [1]), target)
    monkeypatch.setattr(I, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        I.ingest(spark, csv(scratch, "two.csv", [2]), target, mode="overwrite")
    assert ids(read_petitions(spark, target)) == [1]


@pytest.mark.parametrize("mode", ["ignore", "append", "overwrite"])
def test_of_two_loads_at_once_one_commits_first(spark, scratch, monkeypatch, mode):
    target, other, late = os.path.join(scratch, "table"), csv(scratch, "other.csv", [1]), csv(scratch, "late.csv", [2])
    if mode != "ignore":
        I.ingest(spark, csv(scratch, "zero.csv", [0]), target)
    real, begun = I.write_load, []

    def slow(*a, **b):
        out = real(*a, **b)
        if not begun:  # the other load begins and ends while this one has written, but not committed
            begun.append(1)
            I.ingest(spark, other, target, mode=mode)
        return out

    monkeypatch.setattr(I, "write_load", slow)
    if mode == "overwrite":
        with pytest.raises(S.ConcurrentLoad):
            I.ingest(spark, late, target, mode=mode)
        assert ids(read_petitions(spark, target)) == [1]
    else:
        want = [1] if mode == "ignore" else [0, 1, 2]
        assert ids(I.ingest(spark, late, target, mode=mode)) == want == ids(read_petitions(spark, target))


def test_a_manifest_is_never_written_twice(spark, scratch):
    folder = S.Folder(spark, os.path.join(scratch, "m"))
    assert folder.create("1.json", "a") and not folder.create("1.json", "b")
    assert folder.read("1.json") == "a" and folder.names() == ["1.json"]


def test_old_schemas_are_migrated(spark, scratch):
    rows = clean_petitions(read_petitions_csv(spark, csv(scratch, "raw.csv", range(4))))
    cases = {
        "without": (rows.drop("lon"), {}, {"lon": None}),
        "narrow": (rows.withColumn("prevailing_wage", F.col("prevailing_wage").cast("int")), {"prevailing_wage": 0}, {"prevailing_wage": 100}),
        "text": (rows.withColumn("prevailing_wage", F.when(F.col("id") > 1, "much").otherwise("7")), {"prevailing_wage": 2}, {}),
        "wide": (rows.withColumn("id", F.col("id").cast("decimal(30,0)") + F.expr("CASE WHEN id = 3 THEN 10000000000000000000000000 ELSE 0 END")), {"id": 1}, {}),
        "extra": (rows.withColumn("more", F.lit(1)), {}, {"lon": 1.5}),
    }
    for name, (df, unfit, want) in cases.items():
        target = os.path.join(scratch, name)
        df.write.parquet(target)
        new, counts = I.migrate(spark, target)
        assert counts == unfit and new.count() == 4 and new.schema.simpleString() == CLEAN.simpleString()
        for column, value in want.items():
            assert {r[0] for r in new.select(column).collect()} == {value}
        assert new.collect() == read_petitions(spark, target).collect()
        assert I.ingest(spark, csv(scratch, "more.csv", [9]), target, mode="append").count() == 5


def test_a_manifest_of_another_schema_is_refused_until_migrated(spark, scratch):
    target = os.path.join(scratch, "table")
    I.ingest(spark, csv(scratch, "one.csv", [1]), target)
    name = glob.glob(f"{target}/_manifests/*.json")[0]
    text = open(name).read()
    shutil.rmtree(f"{target}/_manifests")
    os.makedirs(f"{target}/_manifests")
    with open(name, "w") as fh:
        fh.write(text.replace("state:string", "state:int"))
    with pytest.raises(ValueError):
        read_petitions(spark, target)
    assert ids(I.migrate(spark, target)[0]) == [1] and S.versions(spark, target) == [1, 2]


def test_a_retry_does_not_quarantine_rows_twice(spark, scratch):
    src, target, apart = csv(scratch, "raw.csv", [1]), os.path.join(scratch, "t"), os.path.join(scratch, "apart")
    with open(src, "a") as fh:
        fh.write("x" + LINE.format(7))
    for _ in range(2):
        I.ingest(spark, src, target, mode="overwrite", bad_records="quarantine", quarantine=apart)
    assert spark.read.text(apart).count() == 1
