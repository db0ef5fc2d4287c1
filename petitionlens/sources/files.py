"""Sources and sinks: CSV, any Spark data source, and Parquet.

Text readers declare their schema, so no job is spent on inference; a stored
table's own schema is read and verified.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from petitionlens.schema import CLEAN, RAW, SchemaMismatch, require
from petitionlens.sources.snapshots import read_snapshot, versions

BAD_RECORDS = ("fail", "quarantine")
WRITE_MODES = ("error", "errorifexists", "ignore", "overwrite", "append")


CORRUPT = "_corrupt_record"


def csv_options(bad_records: str) -> dict[str, object]:
    """Reader options of the two policies for rows that do not fit the schema.

    Columns are not pruned while parsing, so the number of fields always
    counts; a value that does not fit its type counts if its column is read.
    """
    if bad_records not in BAD_RECORDS:
        raise ValueError(f"bad_records must be one of {BAD_RECORDS}")
    mode = {"mode": "FAILFAST"} if bad_records == "fail" else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return {"escape": '"', "columnPruning": False, **mode}


def read_petitions_csv(spark: SparkSession, path: str, *, header: bool = True, bad_records: str = "fail") -> DataFrame:
    """Raw petition CSV (one file or a directory), columns bound by position.

    The header row is skipped, not matched against the schema.  ``""``
    inside a quoted field is an escaped quote.  An unquoted empty field is
    NULL (a warehouse loader may keep ``''`` for strings instead).

    A row with another number of fields or an id that is no integer fails
    the read (``bad_records='fail'``); with ``'quarantine'`` it stays, whole,
    in an extra column ``_corrupt_record`` that is NULL for good rows.
    """
    schema = RAW if bad_records == "fail" else T.StructType([*RAW.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).options(header=header, **csv_options(bad_records)).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds ``path``, on whatever file system; no file is read."""
    try:
        spark.read.text(path).schema  # noqa: B018
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_table(spark: SparkSession, fmt: str, name: str, **options: str) -> DataFrame:
    """Any Spark data source by format name (``jdbc``, ``orc``, ``avro``, a warehouse connector ...).

    The connector itself must be on the cluster classpath; nothing here
    depends on a particular vendor.
    """
    return spark.read.format(fmt).options(**options).load(name)


def read_petitions(spark: SparkSession, path: str) -> DataFrame:
    """Clean petition Parquet, verified against the CLEAN schema.

    The stored schema must have every CLEAN column with its type, in any
    order; otherwise :class:`SchemaMismatch` is raised.  If the table was
    written partitioned by ``year`` the partition column is recovered from
    the directory names (its type there is a guess and not compared) and
    moved back into place.  Of a table with versions the newest is read.
    """
    if versions(spark, path):
        return read_snapshot(spark, path)
    stored = spark.read.parquet(path).schema
    have = {f.name.lower(): f.dataType.simpleString() for f in stored.fields}
    want = {f.name: f.dataType.simpleString() for f in CLEAN.fields}
    wrong = {n: have.get(n) for n, t in want.items() if have.get(n) != t and not (n == "year" and n in have)}
    if wrong:
        raise SchemaMismatch(f"{path}: missing or mistyped columns {wrong}")
    df = spark.read.schema(CLEAN).parquet(path)
    return df.select([F.col(f.name) for f in CLEAN.fields])


def write_petitions(
    df: DataFrame,
    path: str,
    mode: str = "error",
    *,
    partition_by: tuple[str, ...] = (),
    check_schema: bool = True,
) -> None:
    """Write clean petitions to Parquet.

    ``mode='ignore'`` skips the write when the target exists (idempotent
    materialisation), ``'overwrite'`` replaces it (forced refresh), and the
    default ``'error'`` refuses to touch existing data.  With
    ``partition_by=('year',)`` a filter on a single year reads only its
    directory.

    A partitioned write is rebalanced on its partition columns first: AQE
    packs light years into one task and splits a heavy one over several
    tasks of the advisory size, whatever its ids are, so the table gets
    neither (tasks x years) small files nor one task for a hot year.

    A folder that a stream writes is refused: readers of it see only the
    files in the stream's own log, so rows added here would stay hidden.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    if path_exists(df.sparkSession, f"{path.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{path} is written by a stream; batch writes to it would not be read")
    if check_schema:
        require(df, CLEAN)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_answers(
    answers: dict[str, DataFrame],
    root: str,
    mode: str = "overwrite",
    *,
    rows_of: Sequence[str] = (),
    concurrency: int = 4,
) -> dict[str, str]:
    """Write every answer as a Parquet table ``root/<name>``; returns the paths.

    Answers that return rows of the table itself, which would be stored a
    second time, are written only if named in ``rows_of``.  Answers are
    written concurrently (bounded), since most are small.
    """
    from petitionlens.plans.actions import act_concurrently
    from petitionlens.plans.catalogue import ROW_ANSWERS

    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    base = root.rstrip("/")

    def write(name: str, df: DataFrame) -> str:
        df.write.mode(mode).parquet(f"{base}/{name}")
        return f"{base}/{name}"

    wanted = {k: v for k, v in answers.items() if k not in ROW_ANSWERS or k in rows_of}
    return act_concurrently(wanted, write, concurrency=concurrency)
