"""Places in a total order, and the table source."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from petitionlens.operators import with_place
from petitionlens.sources import raw_petitions, table_rows, table_source

from scale import SF_SMALL


def test_places_are_one_to_n_in_order(spark):
    r = random.Random(4)
    rows = [(i, r.choice([None, 1, 2, 3]), r.choice("ab")) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, v int, place string").repartition(6)
    got = sorted(((x.place, x.v, x.id) for x in with_place(df, [F.desc_nulls_last("v"), "id"]).collect()))
    want = sorted(((v is None, -(v or 0), i), v, i) for i, v, _ in rows)
    assert [(v, i) for _, v, i in got] == [(v, i) for _, v, i in want] and [p for p, _, _ in got] == list(range(1, 2001))


def test_one_value_does_not_meet_in_one_range(spark):
    df = spark.range(0, 40_000, 1, 4).withColumn("v", F.lit(7))
    placed = with_place(df, ["v"], "at")
    assert sorted(r.at for r in placed.select("at").collect()) == list(range(1, 40_001))
    assert with_place(df.limit(0), ["v"]).count() == 0


@pytest.fixture()
def warehouse(spark, scratch):
    path = os.path.join(scratch, "warehouse")
    raw_petitions(spark, SF_SMALL).repartition(3).write.parquet(path)
    return path


CASES = [
    ([], "true"), ([("id", ">", 500)], "id > 500"), ([("year", "=", "2016")], "year = '2016'"),
    ([("year", "in", ["2011", "2013", None]), ("id", "<=", 900)], "year in ('2011', '2013') and id <= 900"),
    ([("employer_name", "known", None)], "employer_name is not null"), ([("lon", "null", None)], "lon is null"),
    ([("id", "<", 0)], "id < 0"), ([("year", "=", "1900")], "false"), ([("id", ">=", 10), ("id", "<", 20)], "id between 10 and 19"),
]


def test_table_source_reads_all_rows_and_applies_filters(spark, warehouse):
    want = spark.read.parquet(warehouse)
    whole = table_rows(spark, warehouse)
    assert whole.schema.simpleString() == want.schema.simpleString() and whole.rdd.getNumPartitions() == 3
    for filters, where in CASES:
        a, b = table_rows(spark, warehouse, where=filters), want.where(where)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), where
        assert table_rows(spark, warehouse, ["soc_name"], filters).columns == ["soc_name"]
    # one relation, several queries: none sees another's filter
    assert whole.where("id > 500").union(whole.where("id <= 500")).count() == whole.count() == want.count()
    with pytest.raises(ValueError):
        table_rows(spark, warehouse, where=[("id", "~", 1)])


def test_table_source_plans_partitions_and_skips_row_groups(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "ordered")
    spark.range(0, 40_000, 1, 1).write.option("parquet.block.size", 64 << 10).parquet(path)
    monkeypatch.setattr(table_source, "SPLIT_BYTES", 1)
    every = table_source.TableReader(path, ["id"], []).partitions()
    some = table_source.TableReader(path, ["id"], [["id", "<", 100]]).partitions()
    none = table_source.TableReader(path, ["id"], [["id", "<", 0]]).partitions()
    assert len(every) > 3 and len(some) == 1 and none[0].groups == []
