"""Places of rows in a total order, without a task that sees them all."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petitionlens.session import ensure_shared_dir

#: monotonically_increasing_id puts the task's number above this many bits of row number.
ROW_BITS = 33


def with_place(df: DataFrame, order: Sequence[str | Column], out: str = "place") -> DataFrame:
    """``df`` with each row's position (1 first, bigint) in ``order``.

    A window without partition keys would send every row to one task.  Here
    the rows are dealt out by ranges of ``order``, each range is sorted and
    written to the shared folder with its rows numbered, and the driver adds
    up one count for each range.  The number of ranges follows the size of the
    data (AQE merges light ones).

    Rows that ``order`` leaves tied are told apart by a hash of all their
    columns, so that many equal values do not meet in one range and a place
    does not depend on how the rows were dealt out; only whole copies of a row
    share both.  NULLs stand where ``order`` puts them (Spark: first when
    ascending); an empty table stays empty; a column named ``out`` is replaced.
    """
    spark = df.sparkSession
    df = df.drop(out)
    place, salt = f"__{out}_row__", f"__{out}_tie__"
    keys = [*[F.asc(c) if isinstance(c, str) else c for c in order], F.asc(salt)]
    ranged = df.withColumn(salt, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).repartitionByRange(*keys).sortWithinPartitions(*keys)
    path = f"{ensure_shared_dir(spark, tempfile.gettempdir())}/places-{uuid.uuid4().hex}"
    numbered = ranged.drop(salt).withColumn(place, F.monotonically_increasing_id())
    numbered.write.parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    part = F.shiftrightunsigned(F.col(place), ROW_BITS)
    sizes = sorted((r[0], r[1]) for r in stored.groupBy(part.alias("part")).count().collect())
    starts = zip([p for p, _ in sizes], accumulate((n for _, n in sizes), initial=0))
    offsets = spark.createDataFrame(list(starts), f"{place}part long, {place}start long")
    # as many rows as there were ranges
    placed = stored.join(F.broadcast(offsets), part == F.col(f"{place}part"))
    row = F.col(place).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(f"{place}start") + row + 1).alias(out))
