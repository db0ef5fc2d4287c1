"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import op2_decontamination
from .exact_dedup import OP13_SQL, op13_exact_dedup
from .html_extract import op6_html_extraction
from .importance_sampling import op12_importance_sampling
from .lexical_search import OP11_SQL, op11_lexical_search
from .packing import op1_packing
from .quality_rules import op4_quality_rules
from .simhash import op5_simhash_dedup
from .suffix_dedup import op7_suffix_array_dedup
from .token_counts import op10_token_counts
from .toxicity import op8_toxicity
from .training_order import op9_training_order
from .warc import OP3_SQL, op3_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_decontamination,
        op3_warc,
        op4_quality_rules,
        op5_simhash_dedup,
        op6_html_extraction,
        op7_suffix_array_dedup,
        op8_toxicity,
        op9_training_order,
        op10_token_counts,
        op11_lexical_search,
        op12_importance_sampling,
        op13_exact_dedup,
    )
}

ORACLE_SQL: dict[str, str] = {"op3_warc": OP3_SQL, "op11_lexical_search": OP11_SQL, "op13_exact_dedup": OP13_SQL}
