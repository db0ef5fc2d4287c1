"""Benchmark: ingest once, then every catalogue analysis over the stored table.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Stage 1 (``ingest``) cleans the RAW form of the petition records (projected
from the driver tables) and writes it as Parquet partitioned by year into
the shared folder of ``spark.checkpoint.dir`` (a fresh temporary folder is
used only when that setting is unset, as on a single machine).  Stage 2 runs
each catalogue query over the stored table with a ``noop`` sink, so every
row is computed and nothing is collected: one warm-up pass, then the median
of ``BENCH_REPS`` timed passes.

The join form (per-year joins, join-back to totals) of the multi-year and
profile questions is run by Spark over the same table for comparison, and
the 33 analyses over the clean table are also run together with shared
scans (one summary per group-by key, ``plans.shared``).

Times are split into driver-side build (DataFrame construction and analysis
over Py4J, a fixed cost per query) and execution (``exec_sec``).  Spark's
event log (in the scratch folder) gives, per query, the rows read
from Parquet, the bytes written to shuffle, and the number of jobs and
stages: the quantities that grow with the data, unlike the fixed per-query
cost that dominates wall time at small scale.

Prints ONE JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from petitionlens.operators import clean_petitions, ordered  # noqa: E402
from petitionlens.functions.predicates import certified, denied  # noqa: E402
from tools import oracle_sql  # noqa: E402
from petitionlens.plans.catalogue import CATALOGUE, cert_state_year_count  # noqa: E402
from petitionlens.plans.actions import act_concurrently  # noqa: E402
from petitionlens.plans.shared import run_catalogue_shared  # noqa: E402
from tools.plan_inspect import final_plan, summary  # noqa: E402
from petitionlens.session import ensure_shared_dir, local_session  # noqa: E402
from petitionlens.sources import raw_petitions, read_petitions, write_petitions  # noqa: E402

# Join-form comparisons, each sorted like the single-pass answer (the
# original questions sort their output too): (descending column, tie key).
JOIN_FORM_ORDER = {
    "soc_six_year_certs": ("net_change", "soc_name"),
    "job_six_year_certs": ("net_change", "job_title"),
    "soc_six_year_wages": ("net_change", "soc_name"),
    "job_six_year_wages": ("net_change", "job_title"),
    "employer_certs_and_pay": ("application_count", "employer_name"),
    "soc_yoy_2015_2016": ("yoy_change", "soc_name"),
    "cert_rate_by_full_time": ("rate_certified", "full_time_position"),
    "soc_denied_vs_cert_wage": ("denied_visa_count", "soc_name"),
}
JOIN_FORM_KEYS = tuple(JOIN_FORM_ORDER)


def _per_key(rows, key, counted, name):
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(counted).alias(name))


def _mean(name):
    return (F.sum("prevailing_wage") / F.count("prevailing_wage")).alias(name)


def _employer_join(p):
    named = _per_key(p.where(certified()), "employer_name", "employer_name", "application_count")
    return p.join(named, "employer_name").groupBy("employer_name", "application_count").agg(_mean("average_pay"))


def _full_time_join(p):
    total = _per_key(p, "full_time_position", "case_status", "total")
    hit = p.where(certified()).join(total, "full_time_position").groupBy("full_time_position", "total")
    return hit.agg(F.count("case_status").alias("n")).select("full_time_position", (F.col("n") / F.col("total")).alias("rate_certified"))


def _soc_wage_join(p):
    sides = [
        p.where(pred & F.col("soc_name").isNotNull()).groupBy("soc_name").agg(*aggs)
        for pred, aggs in (
            (denied(), [F.count("soc_name").alias("denied_visa_count"), _mean("avg_denied_wage")]),
            (certified(), [_mean("avg_certified_wage")]),
        )
    ]
    return sides[0].join(sides[1], "soc_name")


#: The comparisons that are not a chain of years, which tools/oracle_sql.py has in join form.
JOIN_FORMS = {
    "employer_certs_and_pay": _employer_join,
    "cert_rate_by_full_time": _full_time_join,
    "soc_denied_vs_cert_wage": _soc_wage_join,
}


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def _build_and_run(make) -> tuple[float, float]:
    """(seconds to build and analyse the DataFrame on the driver, seconds to execute it)."""
    t = time.perf_counter()
    df = make()
    built = time.perf_counter()
    _noop(df)
    return built - t, time.perf_counter() - built


def _event_metrics(log_dir: str) -> dict[str, dict[str, int]]:
    """Per job group: Parquet rows read, shuffle bytes written, jobs, stages."""
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if not os.path.isfile(path) or os.path.basename(path).startswith("."):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        out[group]["jobs"] += 1
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    sid = ev["Stage Info"]["Stage ID"]
                    if sid in stage_group:
                        out[stage_group[sid]]["stages"] += 1
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if group:
                        out[group]["rows_read"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                        out[group]["shuffle_bytes"] += (m.get("Shuffle Write Metrics") or {}).get(
                            "Shuffle Bytes Written", 0
                        )
    return {g: dict(v) for g, v in out.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    scratch = tempfile.mkdtemp(prefix="petitionlens-bench-")
    events = os.path.join(scratch, "events")
    os.makedirs(events)
    conf = {
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{events}",
        "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false",
    }
    spark = local_session(cpus, shuffle_partitions=int(cpus), **conf)
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    # The session's spark.checkpoint.dir if it has one; a scratch folder only when unset.
    table = f"{ensure_shared_dir(spark, os.path.join(scratch, 'shared'))}/run-{os.getpid()}/petitions"

    # Stage 1: ingest (RAW records -> clean -> Parquet partitioned by year).
    def ingest(path: str) -> None:
        write_petitions(clean_petitions(raw_petitions(spark, sf_dir)), path, "overwrite", partition_by=("year",))

    sc.setJobGroup("warmup", "warmup")
    ingest(f"{table}-warmup")
    sc.setJobGroup("ingest", "ingest")
    ingest_sec = _timed(lambda: ingest(table))
    sc.setJobGroup("count", "count")
    stored = read_petitions(spark, table)
    rows = stored.count()

    def run(key: str):
        w = CATALOGUE[key]
        if w.source == "raw":
            return w.run(raw_petitions(spark, sf_dir))
        if key == "cert_state_year_count":
            return cert_state_year_count(stored, state="AMERICA")
        return w.run(stored)

    stored.createOrReplaceTempView("bench_petitions")
    stmts = oracle_sql.statements()

    def join_form(key: str):
        by, tie = JOIN_FORM_ORDER[key]
        if key in JOIN_FORMS:
            df = JOIN_FORMS[key](stored)
        else:
            df = spark.sql(stmts[key].replace(oracle_sql.PETITIONS, "SELECT * FROM bench_petitions"))
        return ordered(df, [F.desc(by)], [tie])

    # Final adaptive plan shape per query (scans, joins, exchanges): what grows with the data.
    shapes = {k: summary(final_plan(run(k))) for k in CATALOGUE}
    join_shapes = {k: summary(final_plan(join_form(k))) for k in JOIN_FORM_KEYS}

    sc.setJobGroup("warmup", "warmup")
    for key in CATALOGUE:
        _noop(run(key))
    for key in JOIN_FORM_KEYS:
        _noop(join_form(key))

    times: dict[str, list[tuple[float, float]]] = defaultdict(list)
    jtimes: dict[str, list[tuple[float, float]]] = defaultdict(list)
    for rep in range(reps):
        for key in CATALOGUE:
            sc.setJobGroup(f"sp|{key}|{rep}", key)
            times[key].append(_build_and_run(lambda: run(key)))
        for key in JOIN_FORM_KEYS:
            sc.setJobGroup(f"jf|{key}|{rep}", key)
            jtimes[key].append(_build_and_run(lambda: join_form(key)))

    # The whole catalogue with shared scans: one summary per group-by key.
    def shared_pass() -> None:
        answers = run_catalogue_shared(stored, {"cert_state_year_count": {"state": "AMERICA"}})
        for df in answers.values():
            _noop(df)

    def shared_pass_concurrent() -> None:
        answers = run_catalogue_shared(stored, {"cert_state_year_count": {"state": "AMERICA"}})
        act_concurrently(answers, lambda name, df: _noop(df), concurrency=4)

    sc.setJobGroup("warmup", "warmup")
    shared_pass()
    shared_pass_concurrent()
    shared_times, concurrent_times = [], []
    for rep in range(reps):
        sc.setJobGroup(f"shared|all|{rep}", "shared")
        shared_times.append(_timed(shared_pass))
        sc.setJobGroup(f"concurrent|all|{rep}", "concurrent")
        concurrent_times.append(_timed(shared_pass_concurrent))
    sc.setJobGroup("done", "done")

    def med(v, part=None):
        xs = [b + e for b, e in v] if part is None else [x[part] for x in v]
        return round(statistics.median(xs), 4)

    per_query = {k: med(v) for k, v in times.items()}
    exec_sec = {k: med(v, 1) for k, v in times.items()}
    build_sec = {k: med(v, 0) for k, v in times.items()}
    join_sec = {k: med(v) for k, v in jtimes.items()}
    join_exec = {k: med(v, 1) for k, v in jtimes.items()}
    spark.stop()

    metrics = _event_metrics(events)

    def pick(form: str, keys) -> dict[str, dict[str, int]]:
        return {k: metrics.get(f"{form}|{k}|0", {}) for k in keys}

    total = round(sum(per_query.values()), 4)
    clean_keys = [k for k, w in CATALOGUE.items() if w.source == "clean"]
    alone_work = {
        m: sum(metrics.get(f"sp|{k}|0", {}).get(m, 0) for k in clean_keys) for m in ("rows_read", "jobs", "shuffle_bytes")
    }
    print(
        json.dumps(
            {
                "metric": "catalogue_total_median_sec",
                "value": total,
                "unit": "sec",
                "queries": per_query,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "rows": rows,
                "ingest_sec": round(ingest_sec, 4),
                "ingest_work": metrics.get("ingest", {}),
                "exec_sec": exec_sec,
                "build_sec": build_sec,
                "join_form_sec": join_sec,
                "single_pass_sec": {k: per_query[k] for k in JOIN_FORM_KEYS},
                "join_form_exec_sec": join_exec,
                "single_pass_exec_sec": {k: exec_sec[k] for k in JOIN_FORM_KEYS},
                "join_form_work": pick("jf", JOIN_FORM_KEYS),
                "single_pass_work": pick("sp", CATALOGUE),
                "baseline_metrics": {
                    "T1_six_year_certs_sql_form_sec": per_query["soc_six_year_certs"],
                    "T1_six_year_certs_row_form_sec": per_query["soc_years_pivot"],
                    "T2_certs_by_soc_sql_form_sec": per_query["certs_by_soc"],
                    "T2_certs_by_soc_row_form_sec": per_query["certs_by_soc_rows"],
                    "T3_rows_of_one_year_sec": per_query["petitions_in_year"],
                    "join_form_vs_single_pass_exec_sec": {
                        k: [join_exec[k], exec_sec[k]] for k in JOIN_FORM_KEYS
                    },
                },
                "shared_catalogue_sec": round(statistics.median(shared_times), 4),
                "shared_catalogue_concurrent_sec": round(statistics.median(concurrent_times), 4),
                "one_at_a_time_catalogue_sec": round(sum(per_query[k] for k in clean_keys), 4),
                "shared_catalogue_work": metrics.get("shared|all|0", {}),
                "one_at_a_time_catalogue_work": alone_work,
                "plan_shape": shapes,
                "join_form_plan_shape": join_shapes,
                "cpus": cpus,
                "reps": reps,
            }
        )
    )


if __name__ == "__main__":
    main()
