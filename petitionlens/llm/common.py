"""Helpers shared by the corpus operators: shared storage, Arrow column maps, range sums."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Batches = Iterator[pa.RecordBatch]


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once per application.

    Nothing is done where PYTHONPATH already leads them to it.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in known or any(p.endswith("petitionlens.zip") for p in sc.listFiles):
        return
    package = os.path.basename(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), package), "zip", root, package))


def map_batches(df: DataFrame, fn: Callable[[Batches], Batches], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` whose workers can import this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a ``local`` master may run without that setting; it then gets a
    temporary folder, which all of its threads see.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "petitionlens-shared")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def materialise(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage so that later stages neither repeat the work nor depend on
    the shuffle files of a lost executor.
    """
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def utf8(col: str | Column) -> Column:
    """Bytes of a text column; null counts as empty."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("binary"), F.lit(b""))


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def rows_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """A batch of ``rows``, which may be empty."""
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def with_columns(
    df: DataFrame,
    source: Column,
    fn: Callable[[list[bytes]], dict[str, object]],
    fields: str,
    keep: list[str] | None = None,
) -> DataFrame:
    """Append columns that ``fn`` derives from a list of ``source`` values, batch by batch.

    The columns ``keep`` (default: all) of ``df`` pass through; one with the
    name of an appended column is replaced.
    """
    added = T.StructType.fromDDL(fields)
    new = {f.name.lower() for f in added}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    schema = T.StructType([df.schema[c] for c in keep] + list(added))
    arrow_added = arrow_schema(added)
    src = "__source__"

    def run(batches: Batches) -> Batches:
        for b in batches:
            values = fn(b.column(b.schema.get_field_index(src)).to_pylist())
            extra = [pa.array(values[f.name], f.type) for f in arrow_added]
            cols = [b.column(i) for i, f in enumerate(b.schema) if f.name != src]
            yield pa.RecordBatch.from_arrays(cols + extra, names=[*keep, *arrow_added.names])

    return map_batches(df.select(*[F.col(f"`{c}`") for c in keep], source.alias(src)), run, schema)


def running_offsets(df: DataFrame, order: list[Column], size: str, out: str, parts: int | None = None) -> DataFrame:
    """``df`` sorted by ``order`` with ``out``: the sum of ``size`` over all earlier rows.

    Range partitions are written once; the driver sees one sum for each
    partition, and each task then adds up its own rows.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    stored = materialise(ordered.withColumn("__part__", F.spark_partition_id()))
    totals = {r[0]: r[1] for r in stored.groupBy("__part__").agg(F.sum(size)).collect()}
    before, at = {}, 0
    for p in sorted(totals):
        before[p] = at
        at += totals[p]
    # one hash partition per range partition keeps each run whole; rows are sorted again inside it
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])
    names = [f.name for f in schema]

    def run(batches: Batches) -> Batches:
        part, pos = None, 0
        for b in batches:
            parts_col = b.column(b.schema.get_field_index("__part__")).to_pylist()
            sizes = b.column(b.schema.get_field_index(size)).to_pylist()
            offs = []
            for p, s in zip(parts_col, sizes):
                if p != part:
                    part, pos = p, before[p]
                offs.append(pos)
                pos += s
            cols = [b.column(i) for i, f in enumerate(b.schema) if f.name != "__part__"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(offs, pa.int64())], names=names)

    again = stored.repartition(max(1, len(totals)), "__part__").sortWithinPartitions("__part__", *order)
    return map_batches(again, run, schema)
