"""The ingest job in incremental form: new CSV files -> clean -> Parquet.

Same transform as the batch ingest (RAW -> CLEAN), run as a Structured
Streaming query over a landing folder, so files that arrive later are
cleaned and appended exactly once.  The file source and the Parquet sink
both record progress in the checkpoint, so a restarted (or partly failed)
run neither skips nor duplicates a file.  Spark's file source leaves out
files older than ``max_file_age`` before the newest one; the default here is
a thousand years, so a backfill that keeps its files' times is ingested too.
The target belongs to the stream: its readers see the files of the stream's
log only, and batch writes to it are refused.  No state is kept: the transform
is row-by-row, so there is no watermark and nothing grows with the data.

The checkpoint lives in the shared folder named by ``spark.checkpoint.dir``
unless one is passed explicitly.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from petitionlens.operators.clean import clean_petitions
from petitionlens.schema import RAW
from petitionlens.session import shared_dir
from petitionlens.sources.files import csv_options


def start_incremental_ingest(
    spark: SparkSession,
    landing: str,
    target: str,
    *,
    checkpoint: str | None = None,
    partition_by: tuple[str, ...] = (),
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    fmt: str = "csv",
    max_file_age: str = "365000d",
) -> StreamingQuery:
    """Start the query; with ``available_now`` it processes what is there and stops.

    ``fmt`` is the landing files' format: CSV (positional, header skipped; a
    row that does not fit fails its batch, which is then done again) or any file format Spark streams (Parquet, JSON, ORC ...), read by
    column name with the RAW schema.
    """
    reader = spark.readStream.option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        raw = reader.schema(RAW).options(header=True, **csv_options("fail")).csv(landing)
    else:
        raw = reader.schema(RAW).format(fmt).load(landing)
    clean = clean_petitions(raw)
    if checkpoint is None:
        # A stable name: the same landing/target pair resumes the same progress.
        digest = hashlib.sha256(f"{landing}\n{target}".encode()).hexdigest()[:16]
        checkpoint = f"{shared_dir(spark)}/ingest-{digest}"
    writer = clean.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(target)


def ingest_available(spark: SparkSession, landing: str, target: str, **kwargs) -> None:
    """Clean every file not yet ingested, then return."""
    q = start_incremental_ingest(spark, landing, target, available_now=True, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
