"""Generic, parameterised DataFrame operators (DataFrame in, DataFrame out).

Each aggregate operator also has a ``*_spec`` form returning a
:class:`Grouped`, the same analysis as data, so analyses with the same key
can share one scan (:mod:`petitionlens.plans.shared`).
"""

from petitionlens.operators.clean import clean_petitions
from petitionlens.operators.counting import (
    count_by,
    count_by_spec,
    count_where,
    count_where_spec,
    extreme_by,
    extreme_by_spec,
)
from petitionlens.operators.grouped import Grouped
from petitionlens.operators.identity import count_by_id_match, match_weights, with_match_weight
from petitionlens.operators.modal import modal_by
from petitionlens.operators.quality import duplicate_ids, row_count
from petitionlens.operators.ranking import with_place
from petitionlens.operators.rates import extreme_rate, rate_by, rate_by_spec, top_k_rates, top_k_rates_spec
from petitionlens.operators.shape import PREVIEW_ROWS, ordered, preview, top_n
from petitionlens.operators.wages import (
    key_profile,
    key_profile_spec,
    wage_contrast_by,
    wage_contrast_by_spec,
    wage_contrast_total,
    wage_contrast_total_spec,
)
from petitionlens.operators.yearly import (
    SIX_YEARS,
    yearly_counts,
    yearly_counts_spec,
    yearly_means,
    yearly_means_spec,
    yearly_pivot,
    yearly_pivot_spec,
)

__all__ = [
    "PREVIEW_ROWS",
    "SIX_YEARS",
    "Grouped",
    "clean_petitions",
    "count_by",
    "count_by_id_match",
    "count_by_spec",
    "count_where",
    "count_where_spec",
    "duplicate_ids",
    "extreme_by",
    "extreme_by_spec",
    "extreme_rate",
    "key_profile",
    "key_profile_spec",
    "match_weights",
    "modal_by",
    "ordered",
    "preview",
    "rate_by",
    "rate_by_spec",
    "row_count",
    "top_k_rates",
    "top_k_rates_spec",
    "top_n",
    "wage_contrast_by",
    "wage_contrast_by_spec",
    "wage_contrast_total",
    "wage_contrast_total_spec",
    "with_match_weight",
    "with_place",
    "yearly_counts",
    "yearly_counts_spec",
    "yearly_means",
    "yearly_means_spec",
    "yearly_pivot",
    "yearly_pivot_spec",
]
