"""The ingest transform: RAW text columns -> typed CLEAN columns.

One ``select`` (one Project node) instead of a chain of ``withColumn``
calls; every expression is a built-in, so the whole transform runs inside
the scan's whole-stage-codegen stage and adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petitionlens.functions.cleaning import (
    missing_to_null,
    split_field,
    to_double,
    truncating_integral,
)


def clean_petitions(raw: DataFrame) -> DataFrame:
    """Apply the cleaning rules to a RAW-shaped DataFrame.

    * ``'NA'`` -> NULL (exact match) for the text columns; ``soc_name`` is
      upper-cased first, so ``'na'`` becomes NULL there too.
    * ``worksite`` is kept verbatim; ``city``/``state`` are its first and
      second comma fields, trimmed.
    * wage -> bigint and year -> int, truncating decimals; lon/lat -> double.

    The result has exactly the CLEAN columns and types (asserted in the tests).
    """
    return raw.select(
        F.col("id").cast("bigint").alias("id"),
        missing_to_null("case_status").alias("case_status"),
        missing_to_null("employer_name").alias("employer_name"),
        missing_to_null(F.upper("soc_name")).alias("soc_name"),
        missing_to_null("job_title").alias("job_title"),
        missing_to_null("full_time_position").alias("full_time_position"),
        truncating_integral("prevailing_wage", "bigint").alias("prevailing_wage"),
        truncating_integral("year", "int").alias("year"),
        F.col("worksite"),
        to_double("lon").alias("lon"),
        to_double("lat").alias("lat"),
        split_field("worksite", 0).alias("city"),
        split_field("worksite", 1).alias("state"),
    )
