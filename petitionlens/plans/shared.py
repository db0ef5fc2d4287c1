"""Answer many analyses from one scan per group-by key.

Run one at a time, the 33 catalogue analyses over the clean table scan it
33 times; 14 of them group by occupation, 6 by job title, two each by state
and worksite, and 3 are global counts.  ``run_shared`` merges every analysis with the same key
into ONE group-by over ONE scan (the row filters are OR-ed, and each
analysis' aggregates are conditional on its own rows), stores that small
per-key summary as a Parquet table in the shared folder
(``spark.checkpoint.dir``), and derives each answer from its columns of it.  So at scale
the table is read once per key instead of once per analysis, and a lost
executor costs a re-read of the summary, not of the table.

A group exists in an analysis' answer only if it has a row of that
analysis (``rows_matched > 0``), exactly as if the analysis had filtered
first.  Global analyses always produce their single row.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from petitionlens.operators.grouped import Grouped
from petitionlens.plans.actions import act_concurrently
from petitionlens.plans.catalogue import CATALOGUE
from petitionlens.session import shared_dir


def either(filters: list[Column | None]) -> Column | None:
    if any(f is None for f in filters):
        return None
    return reduce(lambda a, b: a | b, filters)


def summaries(df: DataFrame, specs: dict[str, Grouped]) -> dict[tuple[str, ...], tuple[DataFrame, list[str]]]:
    """One aggregated frame per distinct key, with the analyses it serves (not yet run)."""
    by_keys: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for name, spec in specs.items():
        by_keys[spec.keys].append(name)
    out = {}
    for keys, names in by_keys.items():
        aggs = []
        for i, name in enumerate(names):
            spec = specs[name]
            if keys:
                aggs.append(spec.rows_matched().alias(f"q{i}__rows"))
            aggs += [c.alias(f"q{i}__{n}") for n, c in spec.aggs]
        where = either([specs[n].where for n in names])
        rows = df if where is None else df.where(where)
        out[keys] = (rows.groupBy(*keys).agg(*aggs) if keys else rows.agg(*aggs), names)
    return out


def new_store(spark: SparkSession) -> str:
    """A new database in the shared folder, for the summaries of one run."""
    name = f"petitionlens_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark)}/{name}'")
    return name


def release(answers: SharedAnswers) -> None:
    """Delete the stored summaries behind ``answers``, which cannot be read any more."""
    if answers.store:
        answers.spark.sql(f"DROP DATABASE IF EXISTS {answers.store} CASCADE")
        answers.store = None


class SharedAnswers(dict):
    """Answers by name, and the database that holds their summaries (None: none was stored)."""

    def __init__(self, spark: SparkSession, store: str | None):
        super().__init__()
        self.spark, self.store = spark, store


def run_shared(
    df: DataFrame,
    specs: dict[str, Grouped],
    *,
    checkpoint: bool = True,
    concurrency: int = 4,
) -> SharedAnswers:
    """The answer of every spec, computed from one summary per distinct key.

    With ``checkpoint=True`` every summary, also one that serves a single
    analysis, is computed now (one job per key, ``concurrency`` at a time) and stored as a Parquet table
    in the shared folder; each answer reads only its own columns of it, and
    all answers show the data as of this call.  The tables stay until
    :func:`release`.  With ``checkpoint=False`` nothing runs yet, and each
    answer recomputes its summary when acted on.
    """
    spark = df.sparkSession
    answers = SharedAnswers(spark, new_store(spark) if checkpoint and specs else None)
    found = summaries(df, specs)
    if checkpoint and found:
        tables = {f"{answers.store}.summary_{number}": summary for number, (summary, _) in enumerate(found.values())}
        act_concurrently(tables, lambda table, summary: summary.write.format("parquet").saveAsTable(table), concurrency=concurrency)
        found = {keys: (spark.table(t), names) for t, (keys, (_, names)) in zip(tables, found.items())}
    for keys, (summary, names) in found.items():
        for i, name in enumerate(names):
            spec = specs[name]
            view = summary.where(F.col(f"q{i}__rows") > 0) if keys else summary
            view = view.select(*keys, *[F.col(f"q{i}__{n}").alias(n) for n, _ in spec.aggs])
            answers[name] = spec.finish(view)
    return answers


def catalogue_specs(params: dict[str, dict] | None = None, groups=None) -> dict[str, Grouped]:
    """The spec of every catalogue analysis that is a single group-by."""
    params = params or {}
    return {
        key: w.spec(**params.get(key, {}))
        for key, w in CATALOGUE.items()
        if w.spec is not None and (groups is None or w.group in set(groups))
    }


def run_catalogue_shared(
    df: DataFrame,
    params: dict[str, dict] | None = None,
    groups=None,
    *,
    checkpoint: bool = True,
    exact_ids: bool = False,
) -> SharedAnswers:
    """Every catalogue analysis over the clean table, sharing scans per key.

    Analyses that are not a single group-by (all rows, rows of one year, the
    per-state modal occupation) run on their own; so do the id-sensitive ones
    when ``exact_ids=True`` (their exact form joins on id).
    """
    params = params or {}
    specs = catalogue_specs(params, groups)
    alone = {}
    if exact_ids:
        alone = {k: {**params.get(k, {}), "exact_ids": True} for k in specs if CATALOGUE[k].id_sensitive}
        specs = {k: v for k, v in specs.items() if k not in alone}
    answers = run_shared(df, specs, checkpoint=checkpoint)
    for key, w in CATALOGUE.items():
        if w.source != "clean" or (groups is not None and w.group not in set(groups)):
            continue
        if key in alone:
            answers[key] = w.run(df, **alone[key])
        elif w.spec is None:
            answers[key] = w.run(df, **params.get(key, {}))
    return answers
