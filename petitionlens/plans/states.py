"""Answers from stored partial states, one set for each load of a versioned table.

A load never changes, so what the analyses need of it (counts, limb sums,
largest and smallest values by key) is computed once and kept inside the load's
folder, where Spark does not list it as data and from where it goes with the load.  After an append only
the new load's rows are read; answers merge the states of the loads that the
version names.  States are named after the analyses' expressions, so a changed
analysis never meets old states; an unfinished write has no mark and is
repeated.  Ids are taken as unique over the whole table.
"""

from __future__ import annotations

import hashlib
import logging
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from petitionlens.functions.aggregates import MERGE
from petitionlens.operators.grouped import Grouped
from petitionlens.plans.actions import act_concurrently
from petitionlens.plans.shared import either, catalogue_specs
from petitionlens.schema import CLEAN
from petitionlens.sources.files import path_exists
from petitionlens.sources.snapshots import LOADS, manifest

log = logging.getLogger(__name__)


def _parts(spec: Grouped, number: int) -> dict[str, list[str]]:
    """The names of an analysis' stored columns, by aggregate."""
    return {n: [f"q{number}__{n}__{i}" for i in range(len(a.parts))] for n, a in spec.aggs}


def _signature(specs: list[Grouped]) -> str:
    text = "\n".join(
        f"{s.keys} {s.where} " + " ".join(f"{n}:{kind}:{c}" for n, a in s.aggs for kind, c in a.parts) for s in specs
    )
    return hashlib.sha256(text.encode()).hexdigest()[:20]


def partial_states(df: DataFrame, specs: list[Grouped]) -> DataFrame:
    """One row for each key of analyses that share it: their rows and parts."""
    aggs = []
    for i, spec in enumerate(specs):
        aggs.append(spec.rows_matched().alias(f"q{i}__rows"))
        for n, a in spec.aggs:
            aggs += [c.alias(name) for name, (_, c) in zip(_parts(spec, i)[n], a.parts)]
    where = either([s.where for s in specs])
    rows = df if where is None else df.where(where)
    keys = specs[0].keys
    return rows.groupBy(*keys).agg(*aggs) if keys else rows.agg(*aggs)


def run_incremental(
    spark: SparkSession, target: str, specs: dict[str, Grouped] | None = None, *, version: int | None = None, concurrency: int = 4
) -> dict[str, DataFrame]:
    """The answer of every spec (default: all grouped analyses of the catalogue) over a version of ``target``.

    Loads without states of these analyses are read now, once for each key;
    the answers read states alone.
    """
    specs = catalogue_specs() if specs is None else specs
    found = manifest(spark, target, version)
    if found is None:
        raise FileNotFoundError(f"{target} has no manifest")
    base = target.rstrip("/")
    by_keys: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for name, spec in specs.items():
        by_keys[spec.keys].append(name)
    stored: dict[tuple[str, ...], list[str]] = {}
    todo: dict[str, DataFrame] = {}
    for keys, names in by_keys.items():
        group = [specs[n] for n in names]
        stored[keys] = [f"{base}/{load}/_states/{_signature(group)}" for load, n in found.loads if n]
        for (load, _), at in zip([x for x in found.loads if x[1]], stored[keys]):
            if not path_exists(spark, f"{at}/_SUCCESS"):
                rows = spark.read.schema(CLEAN).option("basePath", f"{base}/{LOADS}").parquet(f"{base}/{load}")
                todo[at] = partial_states(rows, group)
    log.warning("%s: %d partial states to compute", target, len(todo))
    if todo:
        act_concurrently(todo, lambda at, states: states.write.mode("overwrite").parquet(at), concurrency=concurrency)
    answers = {}
    for keys, names in by_keys.items():
        group = [specs[n] for n in names]
        shape = partial_states(spark.createDataFrame([], CLEAN), group)
        states = spark.read.schema(shape.schema).parquet(*stored[keys]) if stored[keys] else shape
        for i, name in enumerate(names):
            spec, parts = specs[name], _parts(specs[name], i)
            merged = [a.merged(parts[n]).alias(n) for n, a in spec.aggs]
            if keys:
                merged.append(MERGE["count"](F.col(f"q{i}__rows")).alias("__rows__"))
                view = states.groupBy(*keys).agg(*merged).where("__rows__ > 0").drop("__rows__")
            else:
                view = states.agg(*merged)
            answers[name] = spec.finish(view)
    return answers
