"""Column-expression building blocks (predicates, cleaning, aggregates)."""

from petitionlens.functions.aggregates import count_of, exact_mean, hits
from petitionlens.functions.cleaning import (
    missing_to_null,
    split_field,
    to_double,
    truncating_integral,
)
from petitionlens.functions.predicates import (
    certified,
    denied,
    in_year,
    mentions_certified,
    withdrawn,
)

__all__ = [
    "certified",
    "count_of",
    "denied",
    "exact_mean",
    "hits",
    "in_year",
    "mentions_certified",
    "missing_to_null",
    "split_field",
    "to_double",
    "truncating_integral",
    "withdrawn",
]
