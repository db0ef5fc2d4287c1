"""Paths that only show up at scale: no broadcast possible, and a hot key."""

from __future__ import annotations

from pyspark.sql import functions as F

from petitionlens.plans.catalogue import CATALOGUE
from tools.plan_inspect import final_plan, summary
from petitionlens.sources import petitions

from helpers import rows, table
from scale import NO_BROADCAST, SF_SMALL, conf

def test_joins_fall_back_to_shuffle_joins_with_same_answer(spark):
    p = petitions(spark, SF_SMALL)
    want_rows = p.count()
    want_modal = rows(CATALOGUE["modal_soc_by_state"].run(p))
    with conf(spark, NO_BROADCAST):
        q = petitions(spark, SF_SMALL)
        modal = CATALOGUE["modal_soc_by_state"].run(q)
        plan = final_plan(modal)
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert rows(modal) == want_modal
        assert "SortMergeJoin" in final_plan(q) and q.count() == want_rows


def test_hot_state_is_pre_aggregated_and_answers_stay_whole(spark):
    # One state holds 90% of the rows; every group-by must still be exact.
    data = [dict(id=i, state="HOT", soc_name=f"S{i % 7}", case_status="CERTIFIED" if i % 3 else "DENIED",
                 job_title=f"J{i % 5}", year=2011 + i % 6, prevailing_wage=1000 + i)
            for i in range(900)]
    data += [dict(id=1000 + i, state=f"C{i % 4}", soc_name="S1", case_status="DENIED", year=2012)
             for i in range(100)]
    df = table(spark, data).repartition(8)
    modal = rows(CATALOGUE["modal_soc_by_state"].run(df))
    assert ("HOT", "S0", 129) in modal and ("HOT", "S1", 129) in modal
    assert {r for r in modal if r[0] != "HOT"} == {(f"C{i}", "S1", 25) for i in range(4)}
    denied = dict(rows(CATALOGUE["denial_rate_by_state"].run(df)))
    assert denied["HOT"] == 300 / 900 and denied["C0"] == 1.0
    plan = final_plan(CATALOGUE["denial_rate_by_state"].run(df))
    assert "partial_count" in plan and summary(plan)["windows"] == 0
    total = CATALOGUE["certs_by_state"].run(df).agg(F.sum("visa_requests")).first()[0]
    assert total == 600


def test_exact_ids_with_one_id_on_a_third_of_rows(spark):
    # The join form multiplies the hot id's rows (about 100 x 35 pairs);
    # the weighted single pass must give exactly the same answers.
    from test_properties import _compare_all, _random_rows

    data = _random_rows(21, 300)
    for r in data[::3]:
        r["id"] = 7
    assert sum(r["id"] == 7 for r in data) >= 100
    assert _compare_all(spark, data, exact_ids=True) == []


def test_exact_ids_join_on_id_without_broadcast(spark):
    from test_properties import _compare_all, _random_rows

    data = _random_rows(41, 250, repeated_ids=True)
    with conf(spark, NO_BROADCAST):
        assert _compare_all(spark, data, exact_ids=True) == []


SPLIT = NO_BROADCAST | {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_a_heavily_repeated_id_is_split(spark):
    n = 60_000
    data = spark.range(0, n, 1, 16).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).cast("bigint").alias("id"),
        F.when(F.col("id") % 2 == 0, "CERTIFIED").otherwise("DENIED").alias("case_status"),
        F.concat(F.lit("S"), (F.col("id") % 50).cast("string")).alias("state"),
    )
    with conf(spark, SPLIT):
        exact = CATALOGUE["certs_by_state"].run(data, exact_ids=True)
        assert "skew=true" in final_plan(exact)
        got = {r[0]: r[1] for r in exact.collect()}
    pdf = data.toPandas()
    weight = pdf[pdf.case_status == "CERTIFIED"].groupby("id").size()
    want = pdf.assign(w=pdf.id.map(weight).fillna(0)).groupby("state").w.sum()
    assert got == {k: int(v) for k, v in want.items()}


def test_a_hot_state_is_split_in_the_modal_join(spark):
    """One state holds nearly all distinct occupations, each with one row: the count join is skewed on (state, 1)."""
    rows_ = spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 20 > 0, "HOT").otherwise(F.concat(F.lit("C"), (F.col("id") % 200).cast("string"))).alias("state"),
        F.sha2(F.col("id").cast("string"), 256).alias("soc_name"),
    )
    with conf(spark, SPLIT):
        modal = CATALOGUE["modal_soc_by_state"].run(rows_)
        assert "skew=true" in final_plan(modal)
        assert modal.count() == 60_000
