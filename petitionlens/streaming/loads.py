"""The incremental ingest as versions of a table: what each run finds is a load.

A run has two steps.  A Structured Streaming query reads the files that landed
since the last run and stores their RAW rows in a staging folder, in a partition
of its own (``run=<id>``); Spark's file sink does that exactly once.  Then every
staged run is cleaned, written to a load folder named after it, counted there,
and appended by a new manifest (:mod:`petitionlens.sources.snapshots`); its
staged files go at last.  So a table can be fed by streams and by batch loads
alike, its stored partial states serve streamed rows too, and CSV rows that do
not fit can be set apart instead of stopping the stream.

After a failure at any point the next run goes on: a staged run that a manifest
names is only cleared away, one that none names is written anew, with its
rejects, and files of an unfinished staging are not in the sink's log and count
for nothing.  A run without rows makes no version.  Files older than
``max_file_age`` before the newest one are left out by Spark, as in the plain form.
"""

from __future__ import annotations

import hashlib
import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from petitionlens.operators.clean import clean_petitions
from petitionlens.plans.ingest import UnmarkedTable, plain_rows, set_apart
from petitionlens.schema import RAW
from petitionlens.session import shared_dir
from petitionlens.sources.files import CORRUPT, csv_options, path_exists
from petitionlens.sources.snapshots import LOADS, ConcurrentLoad, Folder, commit, manifest, stored_rows, was_committed, write_load

log = logging.getLogger(__name__)

RUN = "run"
STAGED = T.StructType([*RAW.fields, T.StructField(CORRUPT, T.StringType())])


def append_load(clean: DataFrame, target: str, name: str, partition_by: Sequence[str]) -> int:
    """Append ``clean`` as the load ``name``, written under that name alone; returns its rows."""
    spark = clean.sparkSession
    written = Observation(f"written {name}")
    load = write_load(clean.observe(written, F.count(F.lit(1)).alias("n")), target, partition_by, name)
    want = written.get["n"]
    if want == 0:
        return 0
    if (have := stored_rows(spark, target, load)) != want:
        raise RuntimeError(f"{target}/{load} holds {have} rows after a run that makes {want}")
    while True:
        seen = manifest(spark, target)
        before = seen.loads if seen else ()
        if (load, have) in before:
            return have
        try:
            commit(spark, target, seen, [*before, (load, have)])
            return have
        except ConcurrentLoad:
            log.warning("%s: another load came first, %s follows it", target, load)


def stage(spark: SparkSession, landing: str, staging: str, checkpoint: str, fmt: str, quarantine: bool, max_files: int | None, max_age: str) -> None:
    """Store the RAW rows of the files not yet read as one more run below ``staging``."""
    reader = spark.readStream.option("maxFileAge", max_age)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        policy = csv_options("quarantine" if quarantine else "fail")
        raw = reader.schema(STAGED if quarantine else RAW).options(header=True, **policy).csv(landing)
    else:
        raw = reader.schema(RAW).format(fmt).load(landing)
    if CORRUPT not in raw.columns:
        raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    rows = raw.withColumn(RUN, F.lit(f"r{uuid.uuid4().hex}"))
    writer = rows.writeStream.format("parquet").partitionBy(RUN).option("checkpointLocation", checkpoint)
    q = writer.option("compression", "zstd").trigger(availableNow=True).start(staging)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def promote(spark: SparkSession, staging: str, target: str, partition_by: Sequence[str], quarantine: str | None) -> None:
    """Make every staged run a load of ``target``, then clear it away."""
    folder = Folder(spark, staging)
    for name in [n for n in folder.names() if n.startswith(f"{RUN}=")]:
        run = name.split("=", 1)[1]
        load = f"stream-{run}"
        if not was_committed(spark, target, f"{LOADS}/load={load}"):
            rows = spark.read.schema(T.StructType([*STAGED.fields, T.StructField(RUN, T.StringType())])).parquet(staging)
            rows = rows.where(F.col(RUN) == run).drop(RUN)
            rows = set_apart(rows, staging, target, quarantine, load) if quarantine else rows.drop(CORRUPT)
            append_load(clean_petitions(rows), target, load, partition_by)
        folder.delete(name)


def ingest_available_loads(
    spark: SparkSession,
    landing: str,
    target: str,
    *,
    progress: str | None = None,
    partition_by: Sequence[str] = ("year",),
    quarantine: str | None = None,
    max_files_per_trigger: int | None = None,
    fmt: str = "csv",
    max_file_age: str = "365000d",
) -> None:
    """Append the files not yet loaded as one load, after what an earlier run left staged; then return.

    ``progress`` is the folder of the stream's checkpoint and its staged rows.
    With a folder ``quarantine`` CSV rows that do not fit are written there as
    text, in a folder of each run, and the others are loaded; without one such
    a row fails the run.  Keep to one choice for a stream.  A plain folder with
    rows is refused, as is one that the plain stream writes.
    """
    if path_exists(spark, f"{target.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{target} is written by a stream of plain files; loads in it would not be read")
    if manifest(spark, target) is None and plain_rows(spark, target)[0]:
        raise UnmarkedTable(f"{target} is a plain folder with rows; bring it under versions with migrate() first")
    if progress is None:
        digest = hashlib.sha256(f"{landing}\n{target}".encode()).hexdigest()[:16]
        progress = f"{shared_dir(spark)}/ingest-loads-{digest}"
    staging = f"{progress.rstrip('/')}/staged"
    promote(spark, staging, target, partition_by, quarantine)
    stage(spark, landing, staging, f"{progress.rstrip('/')}/checkpoint", fmt, bool(quarantine), max_files_per_trigger, max_file_age)
    promote(spark, staging, target, partition_by, quarantine)
