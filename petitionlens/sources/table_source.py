"""A warehouse-like table source: rows by column name, partitioned reads, filters and columns given to the reader.

``table_rows(spark, folder, ...)`` reads a folder of Parquet files through
Spark's Python data source interface, as a warehouse connector would: the
reader plans one partition for each run of row groups, skips row groups by
their statistics, applies the filters, and hands Arrow batches of the wanted
columns to Spark.  The folder must be one that executors can open.

Filters are options of the relation and not taken from the query: Spark 4.1
keeps one reader for each relation, so that a filter which a query pushes into a
Python source also holds for the next query on the same DataFrame (and for the
other half of a union).  ``spark.sql.python.filterPushdown.enabled`` is left off.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql.types import StructField, StructType

FORMAT = "petition_table"
SIGNS = ("=", "in", "<", "<=", ">", ">=", "known", "null")
#: Uncompressed bytes that a partition holds at least, if its file has them.
SPLIT_BYTES = 64 << 20


Filter = tuple[str, str, object]


def register_table_source(spark: SparkSession) -> None:
    """Make the format known to the session."""
    # workers get the classes themselves: they need not find this package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PetitionTable)


def table_rows(
    spark: SparkSession, folder: str, columns: Sequence[str] = (), where: Sequence[Filter] = ()
) -> DataFrame:
    """The rows of the table in ``folder`` that pass all filters ``where``; all columns, or ``columns``.

    A filter is (column, sign, value) with a sign of SIGNS; values are what
    JSON can hold (a list for ``in``).  As in SQL, NULL passes none but ``null``.
    """
    for name, sign, _ in where:
        if sign not in SIGNS:
            raise ValueError(f"{name}: the sign must be one of {SIGNS}")
    register_table_source(spark)
    options = {"columns": json.dumps(list(columns)), "where": json.dumps([list(f) for f in where])}
    return spark.read.format(FORMAT).options(**options).load(folder)


class RowGroups(D.InputPartition):
    """Some row groups of a file."""

    def __init__(self, path: str, groups: list[int]):
        super().__init__((path, tuple(groups)))
        self.path, self.groups = path, groups


def parquet_files(folder: str) -> list[str]:
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
    found = store.get_file_info(fs.FileSelector(path, recursive=True))
    names = (f.path for f in found if f.is_file and f.path.endswith(".parquet"))
    return sorted(n for n in names if not any(part.startswith(("_", ".")) for part in n[len(path) :].split("/")))


class PetitionTable(D.DataSource):
    """Columns and types as the first file has them."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        files = parquet_files(self.options["path"])
        if not files:
            raise ValueError(f"no Parquet file in {self.options['path']}")
        have = from_arrow_schema(pq.read_schema(files[0]))
        wanted = json.loads(self.options.get("columns", "[]")) or have.names
        return StructType([StructField(n, have[n].dataType) for n in wanted])

    def reader(self, schema: StructType) -> D.DataSourceReader:
        return TableReader(self.options["path"], schema.names, json.loads(self.options.get("where", "[]")))


class TableReader(D.DataSourceReader):
    def __init__(self, folder: str, names: list[str], where: list[Filter]):
        self.folder, self.names, self.where = folder, names, where

    def skipped(self, group) -> bool:
        """Whether the statistics of a row group leave no row for the filters."""
        columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        for name, sign, value in self.where:
            stats = columns[name].statistics
            if sign in ("null", "known") or stats is None or not stats.has_min_max:
                continue
            values = [v for v in (value if sign == "in" else [value]) if v is not None]
            least, most = stats.min, stats.max
            reach = {
                "=": lambda v: least <= v <= most, "in": lambda v: least <= v <= most,
                ">": lambda v: most > v, ">=": lambda v: most >= v, "<": lambda v: least < v, "<=": lambda v: least <= v,
            }[sign]
            if not any(reach(v) for v in values):
                return True
        return False

    def partitions(self) -> Sequence[D.InputPartition]:
        import pyarrow.parquet as pq

        out: list[RowGroups] = []
        for path in parquet_files(self.folder):
            meta = pq.read_metadata(path)
            held, size = [], 0
            for g in range(meta.num_row_groups):
                if self.skipped(meta.row_group(g)):
                    continue
                held.append(g)
                size += meta.row_group(g).total_byte_size
                if size >= SPLIT_BYTES:
                    out.append(RowGroups(path, held))
                    held, size = [], 0
            if held:
                out.append(RowGroups(path, held))
        return out or [RowGroups("", [])]

    def read(self, partition: RowGroups) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        def passes(column, sign, value):
            if sign in ("known", "null"):
                return pc.is_valid(column) if sign == "known" else pc.is_null(column)
            if sign == "in":
                return pc.is_in(column, value_set=pa.array([v for v in value if v is not None], column.type))
            compare = {"=": pc.equal, ">": pc.greater, ">=": pc.greater_equal, "<": pc.less, "<=": pc.less_equal}[sign]
            return pc.fill_null(compare(column, pa.scalar(value, column.type)), False)

        if not partition.groups:
            return
        read = list(dict.fromkeys([*self.names, *[name for name, _, _ in self.where]]))
        with pq.ParquetFile(partition.path) as file:
            for batch in file.iter_batches(row_groups=list(partition.groups), columns=read):
                for test in self.where:
                    batch = batch.filter(passes(batch.column(test[0]), *test[1:]))
                yield batch.select(self.names)
