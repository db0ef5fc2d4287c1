"""From raw documents to packed training sequences.

Each stage applies one corpus operator to all that its predecessor kept; its
result is written as Parquet and read again.  Null and empty texts fail the
quality rules; null ids are kept apart from others; repeated rows are copies of
which one stays; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from petitionlens.llm import decontaminate, packing, quality_rules, simhash, suffix_dedup
from petitionlens.llm.common import materialise, read_table, utf8
from petitionlens.llm.suffix_dedup import text_key


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that fail the base rules or a certified cutoff go."""
    return quality_rules.filter_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of near copies the document with the smallest id stays."""
    return simhash.drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: passages of at least 50 words that also stand elsewhere are cut out."""
    cut = suffix_dedup.remove_repeats(docs, rule=suffix_dedup.WORDS)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold a benchmark item go."""
    keyed = docs.withColumn("__text__", text_key(utf8("text")))
    found = decontaminate.contaminated(keyed, read_table(spark, sf_dir, "benchmark"), key="__text__")
    return keyed.join(found.select("__text__").distinct(), "__text__", "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: pieces of packed sequences, with their token ids (little-endian unsigned 32-bit)."""
    import public_tokenizers

    return packing.packed_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("packing", pack),
]

#: Neither the fingerprints nor the suffix sort can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
