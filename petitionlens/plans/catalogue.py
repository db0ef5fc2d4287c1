"""The catalogue of named analyses over the clean petition table.

Every entry is a thin call of a generic operator; the keys are what
``__spark_entry__.queries()`` registers.  Each function takes the clean
petition DataFrame (plus parameters whose defaults are the original
questions') and returns a DataFrame sorted the way the question reads, with
the key appended as a final tie-break so the order is total.

Every aggregate analysis also has a ``*_spec`` form (a :class:`Grouped`):
the same plan as data, so :func:`petitionlens.plans.shared.run_shared` can
answer all analyses with the same key from one scan and one group-by.

Groups (a caller can run a subset): ``basic`` (B), ``additional`` (A),
``task`` (K), ``timing`` (T), ``ingest`` (E).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petitionlens.functions.predicates import certified, denied, mentions_certified, withdrawn
from petitionlens.operators import (
    SIX_YEARS,
    clean_petitions,
    extreme_rate,
    modal_by,
    ordered,
    yearly_counts,
    yearly_means,
)
from petitionlens.operators.counting import count_by_spec, count_where_spec, extreme_by_spec
from petitionlens.operators.grouped import Grouped
from petitionlens.operators.identity import count_by_id_match
from petitionlens.operators.rates import rate_by_spec, top_k_rates_spec
from petitionlens.operators.wages import key_profile_spec, wage_contrast_by_spec, wage_contrast_total_spec
from petitionlens.operators.yearly import yearly_counts_spec, yearly_means_spec, yearly_pivot_spec

SOC = "soc_name"
JOB = "job_title"
WAGE = "prevailing_wage"


def _by_desc(col: str, key: str) -> Callable[[DataFrame], DataFrame]:
    return lambda r: ordered(r, [F.desc(col)], [key])


# --- basic -----------------------------------------------------------------


def cert_state_year_count_spec(state: str = "FLORIDA", year: int = 2016) -> Grouped:
    pred = certified() & (F.col("state") == F.lit(state)) & (F.col("year") == F.lit(year))
    return count_where_spec(pred, "certified_count")


def cert_state_year_count(p: DataFrame, state: str = "FLORIDA", year: int = 2016) -> DataFrame:
    """B1: certified petitions in one state and year."""
    return cert_state_year_count_spec(state, year).run(p)


def top10_soc_max_rate_spec(k: int = 10) -> Grouped:
    name = "max_certification_rate"
    return top_k_rates_spec(SOC, certified(), name, k=k).then(lambda r: extreme_rate(r, SOC, name, highest=True))


def top10_soc_max_rate(p: DataFrame, k: int = 10) -> DataFrame:
    """B2: among the k most frequent occupations, the highest certification rate."""
    return top10_soc_max_rate_spec(k).run(p)


def top10_soc_min_rate_spec(k: int = 10) -> Grouped:
    name = "min_certification_rate"
    return top_k_rates_spec(SOC, certified(), name, k=k).then(lambda r: extreme_rate(r, SOC, name, highest=False))


def top10_soc_min_rate(p: DataFrame, k: int = 10) -> DataFrame:
    """Among the k most frequent occupations, the lowest certification rate."""
    return top10_soc_min_rate_spec(k).run(p)


def cert_rate_by_year_spec() -> Grouped:
    spec = rate_by_spec(
        "year", certified(), "case_status", "certification_rate",
        hits_name="certifications", total_name="total_cases",
    )
    return spec.then(lambda r: r.orderBy("year"))


def cert_rate_by_year(p: DataFrame) -> DataFrame:
    """(year, certifications, cases with a status, rate), years with a certification."""
    return cert_rate_by_year_spec().run(p)


# --- additional --------------------------------------------------------------


def all_petitions(p: DataFrame) -> DataFrame:
    """A1: every row."""
    return p.select("*")


def max_cert_wage_by_job_spec() -> Grouped:
    spec = extreme_by_spec(JOB, WAGE, certified(), "highest_salary", kind="max")
    return spec.then(_by_desc("highest_salary", JOB))


def max_cert_wage_by_job(p: DataFrame) -> DataFrame:
    """A2: highest certified wage per job title (NULL title kept)."""
    return max_cert_wage_by_job_spec().run(p)


def min_cert_wage_by_job_spec() -> Grouped:
    spec = extreme_by_spec(JOB, WAGE, certified(), "lowest_salary", kind="min", require_value=True)
    return spec.then(lambda r: ordered(r, [F.asc("lowest_salary")], [JOB]))


def min_cert_wage_by_job(p: DataFrame) -> DataFrame:
    """A3: lowest known certified wage per job title."""
    return min_cert_wage_by_job_spec().run(p)


def employer_certs_and_pay_spec() -> Grouped:
    spec = key_profile_spec("employer_name", WAGE, certified(), "application_count", "average_pay")
    return spec.then(_by_desc("application_count", "employer_name"))


def employer_certs_and_pay(p: DataFrame) -> DataFrame:
    """A4: certified petitions per employer and the mean wage over all its petitions."""
    return employer_certs_and_pay_spec().run(p)


def soc_yoy_spec(first: int, second: int) -> Grouped:
    spec = yearly_counts_spec(SOC, [first, second], certified(), change_name="yoy_change")
    return spec.then(_by_desc("yoy_change", SOC))


def soc_yoy(p: DataFrame, first: int, second: int, exact_ids: bool = False) -> DataFrame:
    """Certifications per occupation in two years and the change."""
    if not exact_ids:
        return soc_yoy_spec(first, second).run(p)
    r = yearly_counts(p, SOC, [first, second], certified(), change_name="yoy_change", exact_ids=True)
    return _by_desc("yoy_change", SOC)(r)


def soc_six_year_certs_spec(years: Sequence[int] = SIX_YEARS) -> Grouped:
    return yearly_counts_spec(SOC, years, certified()).then(_by_desc("net_change", SOC))


def soc_six_year_certs(p: DataFrame, years: Sequence[int] = SIX_YEARS, exact_ids: bool = False) -> DataFrame:
    """A10 (and the timed T1 query): occupations certified in every year."""
    if not exact_ids:
        return soc_six_year_certs_spec(years).run(p)
    return _by_desc("net_change", SOC)(yearly_counts(p, SOC, years, certified(), exact_ids=True))


def job_six_year_certs_spec(years: Sequence[int] = SIX_YEARS) -> Grouped:
    return yearly_counts_spec(JOB, years, certified()).then(_by_desc("net_change", JOB))


def job_six_year_certs(p: DataFrame, years: Sequence[int] = SIX_YEARS, exact_ids: bool = False) -> DataFrame:
    """Job titles certified in every year."""
    if not exact_ids:
        return job_six_year_certs_spec(years).run(p)
    return _by_desc("net_change", JOB)(yearly_counts(p, JOB, years, certified(), exact_ids=True))


def certs_by_state_spec() -> Grouped:
    spec = count_by_spec("state", certified(), "visa_requests", counted="case_status")
    return spec.then(_by_desc("visa_requests", "state"))


def certs_by_state(p: DataFrame, exact_ids: bool = False) -> DataFrame:
    """Certified petitions per state (NULL state kept)."""
    if not exact_ids:
        return certs_by_state_spec().run(p)
    r = count_by_id_match(p, "state", certified(), "visa_requests", counted="case_status")
    return _by_desc("visa_requests", "state")(r)


def certs_by_worksite_spec() -> Grouped:
    spec = count_by_spec("worksite", certified(), "visa_requests", counted="case_status")
    return spec.then(_by_desc("visa_requests", "worksite"))


def certs_by_worksite(p: DataFrame, exact_ids: bool = False) -> DataFrame:
    """Certified petitions per worksite."""
    if not exact_ids:
        return certs_by_worksite_spec().run(p)
    r = count_by_id_match(p, "worksite", certified(), "visa_requests", counted="case_status")
    return _by_desc("visa_requests", "worksite")(r)


def cert_rate_by_full_time_spec() -> Grouped:
    spec = rate_by_spec("full_time_position", certified(), "case_status", "rate_certified")
    return spec.then(_by_desc("rate_certified", "full_time_position"))


def cert_rate_by_full_time(p: DataFrame) -> DataFrame:
    """Certification rate per full-time flag."""
    return cert_rate_by_full_time_spec().run(p)


def denied_vs_cert_wage_spec() -> Grouped:
    return wage_contrast_total_spec(WAGE, denied(), certified(), count_name="num_visas", mean_name="avg_wage")


def denied_vs_cert_wage(p: DataFrame) -> DataFrame:
    """(rows, mean wage) of denied and of certified petitions, distinct rows."""
    return denied_vs_cert_wage_spec().run(p)


def denials_by_job_spec() -> Grouped:
    return count_by_spec(JOB, denied(), "visa_count", counted=JOB).then(_by_desc("visa_count", JOB))


def denials_by_job(p: DataFrame) -> DataFrame:
    """Denied petitions per job title (NULL title kept with 0)."""
    return denials_by_job_spec().run(p)


def denial_rate_by_state_spec() -> Grouped:
    return rate_by_spec("state", denied(), "state", "denied_ratio").then(_by_desc("denied_ratio", "state"))


def denial_rate_by_state(p: DataFrame) -> DataFrame:
    """Share of a state's petitions that were denied."""
    return denial_rate_by_state_spec().run(p)


def denial_rate_by_worksite_spec() -> Grouped:
    spec = rate_by_spec("worksite", denied(), "worksite", "denied_ratio")
    return spec.then(_by_desc("denied_ratio", "worksite"))


def denial_rate_by_worksite(p: DataFrame) -> DataFrame:
    """Share of a worksite's petitions that were denied."""
    return denial_rate_by_worksite_spec().run(p)


def modal_soc_by_state(p: DataFrame) -> DataFrame:
    """Most frequent occupation(s) per state, ties kept."""
    r = modal_by(p, "state", SOC, "num_jobs")
    return ordered(r, [F.desc("num_jobs"), F.asc("state")], [SOC])


def withdrawn_count_spec() -> Grouped:
    return count_where_spec(withdrawn(), "withdrawn_visas")


def withdrawn_count(p: DataFrame) -> DataFrame:
    """Withdrawn petitions (any status ending in WITHDRAWN)."""
    return withdrawn_count_spec().run(p)


def withdrawn_by_soc_spec() -> Grouped:
    spec = count_by_spec(SOC, withdrawn(), "withdrawn_visas", counted=SOC)
    return spec.then(_by_desc("withdrawn_visas", SOC))


def withdrawn_by_soc(p: DataFrame) -> DataFrame:
    """Withdrawn petitions per occupation (NULL kept with 0)."""
    return withdrawn_by_soc_spec().run(p)


def withdrawn_by_job_spec() -> Grouped:
    spec = count_by_spec(JOB, withdrawn(), "withdrawn_visas", counted=JOB)
    return spec.then(_by_desc("withdrawn_visas", JOB))


def withdrawn_by_job(p: DataFrame) -> DataFrame:
    """Withdrawn petitions per job title (NULL kept with 0)."""
    return withdrawn_by_job_spec().run(p)


# --- tasks -------------------------------------------------------------------


def soc_denied_vs_cert_wage_spec() -> Grouped:
    spec = wage_contrast_by_spec(
        SOC, WAGE, denied(), certified(),
        first_count="denied_visa_count", first_mean="avg_denied_wage", second_mean="avg_certified_wage",
    )
    return spec.then(_by_desc("denied_visa_count", SOC))


def soc_denied_vs_cert_wage(p: DataFrame) -> DataFrame:
    """K1: per occupation with both outcomes: denials, mean denied wage, mean certified wage."""
    return soc_denied_vs_cert_wage_spec().run(p)


def soc_six_year_wages_spec(years: Sequence[int] = SIX_YEARS) -> Grouped:
    return yearly_means_spec(SOC, WAGE, years, certified()).then(_by_desc("net_change", SOC))


def soc_six_year_wages(p: DataFrame, years: Sequence[int] = SIX_YEARS, exact_ids: bool = False) -> DataFrame:
    """K2: mean certified wage per occupation per year, occupations certified every year."""
    if not exact_ids:
        return soc_six_year_wages_spec(years).run(p)
    return _by_desc("net_change", SOC)(yearly_means(p, SOC, WAGE, years, certified(), exact_ids=True))


def job_six_year_wages_spec(years: Sequence[int] = SIX_YEARS) -> Grouped:
    return yearly_means_spec(JOB, WAGE, years, certified()).then(_by_desc("net_change", JOB))


def job_six_year_wages(p: DataFrame, years: Sequence[int] = SIX_YEARS, exact_ids: bool = False) -> DataFrame:
    """K3: mean certified wage per job title per year, titles certified every year."""
    if not exact_ids:
        return job_six_year_wages_spec(years).run(p)
    return _by_desc("net_change", JOB)(yearly_means(p, JOB, WAGE, years, certified(), exact_ids=True))


# --- timing group (the row-form answers differ from the SQL ones) ------------------------


def soc_years_pivot_spec(years: Sequence[int] = SIX_YEARS) -> Grouped:
    return yearly_pivot_spec(SOC, years, mentions_certified()).then(_by_desc("net_change", SOC))


def soc_years_pivot(p: DataFrame, years: Sequence[int] = SIX_YEARS) -> DataFrame:
    """T1 row form: yearly counts for EVERY occupation whose status mentions CERTIFIED.

    Missing years are NULL and the change is 0 unless both end years exist.
    """
    return soc_years_pivot_spec(years).run(p)


def certs_by_soc_spec() -> Grouped:
    spec = count_by_spec(SOC, certified(), "number_certified_jobs", counted=SOC)
    return spec.then(_by_desc("number_certified_jobs", SOC))


def certs_by_soc(p: DataFrame) -> DataFrame:
    """T2 SQL form: certified petitions per occupation (NULL kept with 0)."""
    return certs_by_soc_spec().run(p)


def certs_by_soc_rows_spec() -> Grouped:
    spec = count_by_spec(SOC, mentions_certified(), "number_certified_rows")
    return spec.then(_by_desc("number_certified_rows", SOC))


def certs_by_soc_rows(p: DataFrame) -> DataFrame:
    """T2 row form: rows whose status mentions CERTIFIED, per occupation; NULL counted."""
    return certs_by_soc_rows_spec().run(p)


def petitions_in_year(p: DataFrame, year: int = 2011) -> DataFrame:
    """The rows of one year."""
    return p.where(F.col("year") == F.lit(year))


# --- registry ----------------------------------------------------------------


@dataclass(frozen=True)
class Workload:
    ident: str
    group: str
    run: Callable[..., DataFrame]
    source: str = "clean"  # "clean": takes the clean table; "raw": takes RAW rows
    spec: Callable[..., Grouped] | None = None  # the same analysis as a Grouped, when it is one

    @property
    def id_sensitive(self) -> bool:
        """True when the written-out form self-joins on id (``exact_ids`` applies)."""
        import inspect

        return "exact_ids" in inspect.signature(self.run).parameters


def _yoy(first: int) -> tuple[Callable[..., DataFrame], Callable[[], Grouped]]:
    def run(p: DataFrame, exact_ids: bool = False) -> DataFrame:
        return soc_yoy(p, first, first + 1, exact_ids=exact_ids)

    run.__name__ = f"soc_yoy_{first}_{first + 1}"
    run.__doc__ = f"Certifications per occupation, {first} vs {first + 1}."
    return run, lambda: soc_yoy_spec(first, first + 1)


def _w(ident: str, group: str, run: Callable[..., DataFrame], spec: Callable[..., Grouped] | None = None):
    return Workload(ident, group, run, spec=spec)


CATALOGUE: dict[str, Workload] = {
    "clean_petitions": Workload("E1", "ingest", clean_petitions, source="raw"),
    "cert_state_year_count": _w("B1", "basic", cert_state_year_count, cert_state_year_count_spec),
    "top10_soc_max_rate": _w("B2", "basic", top10_soc_max_rate, top10_soc_max_rate_spec),
    "top10_soc_min_rate": _w("B3", "basic", top10_soc_min_rate, top10_soc_min_rate_spec),
    "cert_rate_by_year": _w("B4", "basic", cert_rate_by_year, cert_rate_by_year_spec),
    "all_petitions": _w("A1", "additional", all_petitions),
    "max_cert_wage_by_job": _w("A2", "additional", max_cert_wage_by_job, max_cert_wage_by_job_spec),
    "min_cert_wage_by_job": _w("A3", "additional", min_cert_wage_by_job, min_cert_wage_by_job_spec),
    "employer_certs_and_pay": _w("A4", "additional", employer_certs_and_pay, employer_certs_and_pay_spec),
    **{
        f"soc_yoy_{y}_{y + 1}": _w(f"A{5 + i}", "additional", *_yoy(y))
        for i, y in enumerate(range(2011, 2016))
    },
    "soc_six_year_certs": _w("A10", "additional", soc_six_year_certs, soc_six_year_certs_spec),
    "job_six_year_certs": _w("A11", "additional", job_six_year_certs, job_six_year_certs_spec),
    "certs_by_state": _w("A12", "additional", certs_by_state, certs_by_state_spec),
    "certs_by_worksite": _w("A13", "additional", certs_by_worksite, certs_by_worksite_spec),
    "cert_rate_by_full_time": _w("A14", "additional", cert_rate_by_full_time, cert_rate_by_full_time_spec),
    "denied_vs_cert_wage": _w("A15", "additional", denied_vs_cert_wage, denied_vs_cert_wage_spec),
    "denials_by_job": _w("A16", "additional", denials_by_job, denials_by_job_spec),
    "denial_rate_by_state": _w("A17", "additional", denial_rate_by_state, denial_rate_by_state_spec),
    "denial_rate_by_worksite": _w("A18", "additional", denial_rate_by_worksite, denial_rate_by_worksite_spec),
    "modal_soc_by_state": _w("A19", "additional", modal_soc_by_state),
    "withdrawn_count": _w("A20", "additional", withdrawn_count, withdrawn_count_spec),
    "withdrawn_by_soc": _w("A21", "additional", withdrawn_by_soc, withdrawn_by_soc_spec),
    "withdrawn_by_job": _w("A22", "additional", withdrawn_by_job, withdrawn_by_job_spec),
    "soc_denied_vs_cert_wage": _w("K1", "task", soc_denied_vs_cert_wage, soc_denied_vs_cert_wage_spec),
    "soc_six_year_wages": _w("K2", "task", soc_six_year_wages, soc_six_year_wages_spec),
    "job_six_year_wages": _w("K3", "task", job_six_year_wages, job_six_year_wages_spec),
    "soc_years_pivot": _w("T1r", "timing", soc_years_pivot, soc_years_pivot_spec),
    "certs_by_soc": _w("T2s", "timing", certs_by_soc, certs_by_soc_spec),
    "certs_by_soc_rows": _w("T2r", "timing", certs_by_soc_rows, certs_by_soc_rows_spec),
    "petitions_in_year": _w("T3", "timing", petitions_in_year),
}


# Analyses that return rows of the table itself.
ROW_ANSWERS = ("all_petitions", "petitions_in_year")


def select(groups: Sequence[str] | None = None) -> dict[str, Workload]:
    """The catalogue entries of the given groups (all when ``None``)."""
    if groups is None:
        return dict(CATALOGUE)
    return {k: w for k, w in CATALOGUE.items() if w.group in set(groups)}
