"""Named analyses (the catalogue) and the jobs that run them."""

from petitionlens.plans.catalogue import CATALOGUE, Workload, select

__all__ = ["CATALOGUE", "Workload", "select"]
