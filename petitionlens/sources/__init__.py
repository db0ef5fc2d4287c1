"""Sources (CSV, any data source, Parquet, driver-table projection) and sinks."""

from petitionlens.sources.files import (
    read_petitions,
    read_petitions_csv,
    read_table,
    write_answers,
    write_petitions,
)
from petitionlens.sources.fixtures import petitions, raw_petitions
from petitionlens.sources.table_source import register_table_source, table_rows

__all__ = [
    "petitions",
    "raw_petitions",
    "read_petitions",
    "read_petitions_csv",
    "read_table",
    "register_table_source",
    "table_rows",
    "write_answers",
    "write_petitions",
]
