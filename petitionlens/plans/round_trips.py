"""Queries that exercise the storage path and the awkward data, for the registry.

Each reads its whole input from the driver tables.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from petitionlens.operators import SIX_YEARS, clean_petitions, duplicate_ids, row_count, top_n, with_place
from petitionlens.plans.catalogue import CATALOGUE
from petitionlens.plans.ingest import ingest, migrate
from petitionlens.plans.states import run_incremental
from petitionlens.session import ensure_shared_dir
from petitionlens.sources.files import read_petitions
from petitionlens.sources.table_source import FORMAT, register_table_source
from petitionlens.sources.fixtures import petitions, petitions_edges, raw_petitions, raw_petitions_edges
from petitionlens.streaming.loads import ingest_available_loads


def clean_petitions_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_petitions(raw_petitions_edges(spark, sf_dir))


def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_ids(petitions_edges(spark, sf_dir))


def petition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(petitions(spark, sf_dir))


def top_employers(spark: SparkSession, sf_dir: str, n: int = 20) -> DataFrame:
    """The first ``n`` employers by certifications, with their rank, so that the order is compared too."""
    counts = CATALOGUE["employer_certs_and_pay"].run(petitions(spark, sf_dir)).select("employer_name", "application_count")
    first = top_n(counts, [F.desc("application_count")], n, ["employer_name"])
    # the window orders n rows
    place = Window.orderBy(F.desc("application_count"), F.asc("employer_name"))
    return first.withColumn("place", F.row_number().over(place))


def stored_six_year_certs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW rows -> CSV -> cleaned Parquet by year in the shared folder -> A10 over the stored table."""
    root = f"{ensure_shared_dir(spark, tempfile.gettempdir())}/round-trip-{uuid.uuid4().hex}"
    raw_petitions(spark, sf_dir).write.option("header", True).option("escape", '"').csv(f"{root}/landing")
    return CATALOGUE["soc_six_year_certs"].run(ingest(spark, f"{root}/landing", f"{root}/petitions"))


def _fresh(spark: SparkSession) -> str:
    return f"{ensure_shared_dir(spark, tempfile.gettempdir())}/round-trip-{uuid.uuid4().hex}"


def table_source_six_year_certs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW rows of the six years, read by name from a table source that applies the filter, cleaned and stored -> A10."""
    root = _fresh(spark)
    raw_petitions(spark, sf_dir).write.parquet(f"{root}/warehouse")
    register_table_source(spark)
    years = json.dumps([["year", "in", [str(y) for y in SIX_YEARS]]])
    return CATALOGUE["soc_six_year_certs"].run(ingest(spark, f"{root}/warehouse", f"{root}/petitions", fmt=FORMAT, where=years))


def refreshed_certs_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of the denied rows alone, a second load that leaves it as it is, then a forced refresh with all rows -> A12."""
    root = _fresh(spark)
    raw = raw_petitions(spark, sf_dir)
    raw.where("case_status = 'DENIED'").write.parquet(f"{root}/denied")
    raw.write.parquet(f"{root}/all")
    first = ingest(spark, f"{root}/denied", f"{root}/petitions", fmt="parquet").count()
    if ingest(spark, f"{root}/all", f"{root}/petitions", fmt="parquet").count() != first:
        raise RuntimeError("a loaded table was loaded again")
    return CATALOGUE["certs_by_state"].run(ingest(spark, f"{root}/all", f"{root}/petitions", fmt="parquet", mode="overwrite"))


def appended_certs_by_soc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, of the rows with an odd id and then of the others, as versions of one table -> T2."""
    root = _fresh(spark)
    raw = raw_petitions(spark, sf_dir)
    raw.where("id % 2 = 1").write.parquet(f"{root}/odd")
    raw.where("id % 2 = 0").write.parquet(f"{root}/even")
    ingest(spark, f"{root}/odd", f"{root}/petitions", fmt="parquet")
    return CATALOGUE["certs_by_soc"].run(ingest(spark, f"{root}/even", f"{root}/petitions", fmt="parquet", mode="append"))


def incremental_six_year_wages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; the states of the first are stored before the second comes, and the answer merges both -> K2."""
    root = _fresh(spark)
    raw = raw_petitions(spark, sf_dir)
    raw.where("id % 2 = 1").write.parquet(f"{root}/odd")
    raw.where("id % 2 = 0").write.parquet(f"{root}/even")
    specs = {"soc_six_year_wages": CATALOGUE["soc_six_year_wages"].spec()}
    ingest(spark, f"{root}/odd", f"{root}/petitions", fmt="parquet")
    run_incremental(spark, f"{root}/petitions", specs)
    ingest(spark, f"{root}/even", f"{root}/petitions", fmt="parquet", mode="append")
    return run_incremental(spark, f"{root}/petitions", specs)["soc_six_year_wages"]


def streamed_modal_soc_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch load of the rows with an odd id, then a stream that adds the others as loads -> A19."""
    root = _fresh(spark)
    raw = raw_petitions(spark, sf_dir)
    raw.where("id % 2 = 1").write.parquet(f"{root}/odd")
    raw.where("id % 2 = 0").write.option("header", True).option("escape", '"').csv(f"{root}/landing")
    ingest(spark, f"{root}/odd", f"{root}/petitions", fmt="parquet")
    ingest_available_loads(spark, f"{root}/landing", f"{root}/petitions", progress=f"{root}/progress", quarantine=f"{root}/apart")
    return CATALOGUE["modal_soc_by_state"].run(read_petitions(spark, f"{root}/petitions"))


def migrated_max_wage_by_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of an older schema (wages as text, no coordinates) brought to CLEAN as a new version -> A2."""
    root = _fresh(spark)
    old = clean_petitions(raw_petitions(spark, sf_dir)).drop("lon", "lat")
    old.withColumn("prevailing_wage", F.col("prevailing_wage").cast("string")).write.parquet(f"{root}/petitions")
    return CATALOGUE["max_cert_wage_by_job"].run(migrate(spark, f"{root}/petitions")[0])


def placed_employers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 in its order, with every employer's place."""
    answer = CATALOGUE["employer_certs_and_pay"].run(petitions(spark, sf_dir)).select("employer_name", "application_count")
    return with_place(answer, [F.desc("application_count"), F.asc("employer_name")])


def placed_socs_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupations by state, in descending count and ascending state, with their places."""
    counts = petitions(spark, sf_dir).groupBy("state", "soc_name").agg(F.count("id").alias("n"))
    return with_place(counts, [F.desc("n"), F.asc_nulls_last("state"), F.asc_nulls_last("soc_name")])


def placed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's place by its wage, then its id: the order of a whole table."""
    rows = petitions(spark, sf_dir).select("id", "prevailing_wage", "state")
    return with_place(rows, [F.desc_nulls_last("prevailing_wage"), F.asc("id")])


def _on_edges(key: str) -> Callable[[SparkSession, str], DataFrame]:
    w = CATALOGUE[key]
    extra = {"exact_ids": True} if w.id_sensitive else {}

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return w.run(petitions_edges(spark, sf_dir), **extra)

    run.__name__ = f"edges_{key}"
    return run


#: The analyses that depend on ids, and those that the odd status and the tie tell apart.
EDGE_KEYS = [k for k, w in CATALOGUE.items() if w.id_sensitive] + ["certs_by_soc", "certs_by_soc_rows", "modal_soc_by_state"]

ROUND_TRIPS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        clean_petitions_edges,
        repeated_ids,
        petition_rows,
        top_employers,
        stored_six_year_certs,
        table_source_six_year_certs,
        refreshed_certs_by_state,
        appended_certs_by_soc,
        incremental_six_year_wages,
        streamed_modal_soc_by_state,
        migrated_max_wage_by_job,
        placed_employers,
        placed_socs_by_state,
        placed_rows,
    )
} | {f"edges_{k}": _on_edges(k) for k in EDGE_KEYS}
