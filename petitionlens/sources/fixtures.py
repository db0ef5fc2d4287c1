"""A petition-shaped table projected from the driver's TPC-H-style tables.

The driver data holds no petition records, so the analyses run over a
deterministic projection of ``orders`` joined to ``customer``, ``nation`` and
``region``.  The same projection is written independently as SQL in
``tools/oracle_sql.py`` for the DuckDB check.

The join is declared, not hinted: Spark broadcasts ``nation``/``region`` and,
at small scale, ``customer`` because their size estimates are under
``spark.sql.autoBroadcastJoinThreshold``; at cluster scale ``orders`` x
``customer`` becomes a sort-merge join on ``custkey`` and AQE splits a
customer that owns a large share of the orders (skew-join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# The driver-table columns the projection reads.  Declaring them skips the
# footer read for schema inference and prunes every other column.
DRIVER_COLUMNS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def petitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean petition table (CLEAN columns without lon/lat) from ``sf_dir``."""
    orders = _table(spark, sf_dir, "orders")
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")

    # orders x customer first: without CBO Spark estimates a join's size as
    # the product of its inputs, so joining the geography into customer first
    # would make customer look larger than orders.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey)
    rows = rows.join(geo, rows.c_nationkey == geo.n_nationkey)

    # The column rules are plain SQL expressions: one selectExpr builds the
    # whole projection in the JVM instead of ~90 Column calls over Py4J.
    base = rows.selectExpr(
        "o_orderkey AS id",
        """CASE WHEN o_orderkey % 41 = 0 THEN NULL
                WHEN o_orderstatus = 'F' THEN 'CERTIFIED'
                WHEN o_orderstatus = 'O' THEN 'DENIED'
                WHEN o_orderkey % 2 = 0 THEN 'CERTIFIED-WITHDRAWN' ELSE 'WITHDRAWN' END AS case_status""",
        "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE c_name END AS employer_name",
        """CASE WHEN o_orderkey % 29 = 0 THEN NULL
                ELSE concat(c_mktsegment, ' ', substr(o_orderpriority, 3)) END AS soc_name""",
        "CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE concat('JOB ', CAST(o_custkey % 500 AS STRING)) END AS job_title",
        "CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'N' ELSE 'Y' END AS full_time_position",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS prevailing_wage",
        "CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST(year(o_orderdate) + 16 AS INT) END AS year",
        """CASE WHEN o_orderkey % 19 = 0 THEN 'NA' WHEN o_orderkey % 17 = 0 THEN n_name
                ELSE concat(n_name, ', ', r_name) END AS worksite""",
    )
    return base.selectExpr(
        "*",
        "trim(split_part(worksite, ',', 1)) AS city",
        "nullif(trim(split_part(worksite, ',', 2)), '') AS state",
    )


def raw_petitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records in RAW form (text with ``'NA'`` markers), for the ingest job.

    Wages get a ``'.6'`` suffix so cleaning must truncate, SOC names are lower
    case so cleaning must upper-case them, and ``lon``/``lat`` are synthesised
    from the id.
    """
    p = petitions(spark, sf_dir)
    return p.selectExpr(
        "id",
        "coalesce(case_status, 'NA') AS case_status",
        "coalesce(employer_name, 'NA') AS employer_name",
        "coalesce(lower(soc_name), 'na') AS soc_name",
        "coalesce(job_title, 'NA') AS job_title",
        "coalesce(full_time_position, 'NA') AS full_time_position",
        "coalesce(concat(CAST(prevailing_wage AS STRING), '.6'), 'NA') AS prevailing_wage",
        "coalesce(CAST(year AS STRING), 'NA') AS year",
        "worksite",
        "CASE WHEN id % 5 = 0 THEN 'NA' ELSE concat('-', CAST(id % 90 AS STRING), '.25') END AS lon",
        "CASE WHEN id % 5 = 0 THEN 'NA' ELSE concat(CAST(id % 45 AS STRING), '.5') END AS lat",
    )


def raw_petitions_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The RAW form with the awkward values that real files hold, dealt out by the id."""
    return raw_petitions(spark, sf_dir).selectExpr(
        "id",
        "case_status",
        "CASE WHEN id % 6 = 0 THEN ' NA' ELSE employer_name END AS employer_name",
        "CASE id % 5 WHEN 0 THEN 'NA' WHEN 1 THEN 'Na' ELSE soc_name END AS soc_name",
        "CASE id % 4 WHEN 0 THEN 'na' ELSE job_title END AS job_title",
        "full_time_position",
        """CASE id % 19
             WHEN 0 THEN concat(' ', CAST(id AS STRING), ' ') WHEN 1 THEN concat('+', CAST(id AS STRING))
             WHEN 2 THEN concat('-', CAST(id AS STRING), '.9') WHEN 3 THEN concat('.', CAST(id AS STRING)) WHEN 4 THEN '-.5'
             WHEN 5 THEN concat(CAST(id AS STRING), '.') WHEN 6 THEN '1e5' WHEN 7 THEN '1,000' WHEN 8 THEN '' WHEN 9 THEN '-'
             WHEN 10 THEN '12345678901234567890' WHEN 11 THEN 'abc' WHEN 12 THEN '.' WHEN 13 THEN '9223372036854775807'
             WHEN 14 THEN '1.2.3' WHEN 15 THEN '- 5' ELSE prevailing_wage END AS prevailing_wage""",
        """CASE id % 7 WHEN 0 THEN '2016.0' WHEN 1 THEN '99999999999' WHEN 2 THEN ' 2014 ' WHEN 3 THEN 'x' ELSE year END AS year""",
        """CASE id % 8 WHEN 0 THEN 'A,' WHEN 1 THEN 'A, B, C' WHEN 2 THEN '' WHEN 3 THEN ' , B ' WHEN 4 THEN 'NA'
             ELSE worksite END AS worksite""",
        "CASE id % 3 WHEN 0 THEN ' 3 ' WHEN 1 THEN '1e2' ELSE lon END AS lon",
        "CASE id % 3 WHEN 0 THEN '' WHEN 1 THEN 'x' ELSE lat END AS lat",
    )


def petitions_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table with repeated and NULL ids, a status that only mentions CERTIFIED, and a tie.

    The rows with the smallest and the largest order key are alone in the
    state TIE, each with an occupation of its own.
    """
    orders = _table(spark, sf_dir, "orders")
    low, high = orders.selectExpr("min(o_orderkey)", "max(o_orderkey)").first()
    if low is None:  # no orders: nothing is equal to it
        low = high = "NULL"
    return petitions(spark, sf_dir).selectExpr(
        "CASE WHEN id % 11 = 0 THEN NULL ELSE id div 3 END AS id",
        "CASE WHEN id % 5 = 0 THEN 'DECERTIFIED' ELSE case_status END AS case_status",
        "employer_name",
        f"CASE id WHEN {low} THEN 'FIRST' WHEN {high} THEN 'LAST' ELSE soc_name END AS soc_name",
        "job_title",
        "full_time_position",
        "prevailing_wage",
        "year",
        "worksite",
        "city",
        f"CASE WHEN id IN ({low}, {high}) THEN 'TIE' ELSE state END AS state",
    )
