"""Incremental ingest: each landed file is cleaned and stored exactly once."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from petitionlens.schema import CLEAN, require
from petitionlens.sources import petitions, raw_petitions, read_petitions
from petitionlens.streaming import ingest_available

from scale import SF_SMALL


def test_incremental_ingest_is_exactly_once(spark, scratch):
    landing, target, ckpt = (os.path.join(scratch, n) for n in ("landing", "table", "ckpt"))
    raw = raw_petitions(spark, SF_SMALL)
    first = raw.where(F.col("id") % 2 == 0)
    second = raw.where(F.col("id") % 2 == 1)

    first.write.option("header", True).csv(os.path.join(landing, "batch1"))
    ingest_available(spark, landing + "/*", target, checkpoint=ckpt)
    assert read_petitions(spark, target).count() == first.count()

    ingest_available(spark, landing + "/*", target, checkpoint=ckpt)  # nothing new
    assert read_petitions(spark, target).count() == first.count()

    second.write.option("header", True).csv(os.path.join(landing, "batch2"))
    ingest_available(spark, landing + "/*", target, checkpoint=ckpt)
    stored = read_petitions(spark, target)
    require(stored, CLEAN)
    assert stored.count() == 1500
    cols = [c for c in stored.columns if c not in ("lon", "lat")]
    assert stored.select(cols).exceptAll(petitions(spark, SF_SMALL).select(cols)).count() == 0


def test_incremental_ingest_of_parquet_landing(spark, scratch):
    landing, target, ckpt = (os.path.join(scratch, n) for n in ("landing", "table", "ckpt"))
    raw = raw_petitions(spark, SF_SMALL)
    raw.where(F.col("id") < 3000).write.parquet(os.path.join(landing, "a"))
    ingest_available(spark, landing + "/*", target, checkpoint=ckpt, fmt="parquet")
    raw.where(F.col("id") >= 3000).write.parquet(os.path.join(landing, "b"))
    ingest_available(spark, landing + "/*", target, checkpoint=ckpt, fmt="parquet")
    stored = read_petitions(spark, target)
    assert stored.count() == 1500
    cols = [c for c in stored.columns if c not in ("lon", "lat")]
    assert stored.select(cols).exceptAll(petitions(spark, SF_SMALL).select(cols)).count() == 0


def test_bounded_micro_batches(spark, scratch):
    from petitionlens.streaming import start_incremental_ingest

    landing, target, ckpt = (os.path.join(scratch, n) for n in ("landing", "table", "ckpt"))
    raw = raw_petitions(spark, SF_SMALL)
    for i in range(3):
        raw.where(F.col("id") % 3 == i).coalesce(1).write.option("header", True).csv(os.path.join(landing, f"b{i}"))
    q = start_incremental_ingest(spark, landing + "/*", target, checkpoint=ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3 and sum(p["numInputRows"] for p in batches) == 1500
    assert read_petitions(spark, target).count() == 1500


def test_an_old_file_is_ingested_once(spark, scratch):
    """A backfill that keeps its files' times lands behind a newer file."""
    import time

    landing, target, ckpt = (os.path.join(scratch, n) for n in ("landing", "table", "ckpt"))
    raw = raw_petitions(spark, SF_SMALL)
    raw.where(F.col("id") % 2 == 0).coalesce(1).write.option("header", True).csv(os.path.join(landing, "new"))
    ingest_available(spark, landing + "/*", target, checkpoint=ckpt)
    raw.where(F.col("id") % 2 == 1).coalesce(1).write.option("header", True).csv(os.path.join(landing, "old"))
    then = time.time() - 30 * 86400
    for name in os.listdir(os.path.join(landing, "old")):
        os.utime(os.path.join(landing, "old", name), (then, then))
    for _ in range(2):
        ingest_available(spark, landing + "/*", target, checkpoint=ckpt)
    assert read_petitions(spark, target).count() == 1500


def test_batch_writes_to_a_streamed_target_are_refused(spark, scratch):
    import pytest

    from petitionlens.plans.ingest import ingest

    landing, target, ckpt = (os.path.join(scratch, n) for n in ("landing", "table", "ckpt"))
    raw_petitions(spark, SF_SMALL).limit(5).write.option("header", True).csv(os.path.join(landing, "a"))
    ingest_available(spark, landing + "/*", target, checkpoint=ckpt)
    with pytest.raises(ValueError, match="stream"):
        ingest(spark, landing + "/*", target, mode="append")
    assert ingest(spark, landing + "/*", target).count() == 5  # loaded already
