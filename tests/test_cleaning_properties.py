"""The ANSI-safe integral parse equals Spark's own legacy (non-ANSI) cast.

Ground truth is the cast itself, evaluated with ``spark.sql.ansi.enabled``
switched off for the duration of one query; the library expression runs
with ANSI on, as in production.
"""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from petitionlens.functions.cleaning import truncating_integral

ALPHABET = "0123456789.+- \t\n\x00\x01\x7fe,xNA\xa0"
TEXT = st.one_of(
    st.text(alphabet=ALPHABET, max_size=8),
    st.from_regex(r"\A[ \t]?[+-]?[0-9]{0,21}(\.[0-9]{0,3})?[ \x00]?\Z", fullmatch=True),
    st.integers(min_value=-(2**70), max_value=2**70).map(str),
)


def _legacy(spark, df, type_name):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        return [r[0] for r in df.select(F.col("v").cast(type_name)).orderBy("i").collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(TEXT, min_size=1, max_size=60))
def test_truncating_integral_matches_legacy_cast(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    for type_name in ("bigint", "int"):
        want = _legacy(spark, df, type_name)
        got = [r[0] for r in df.select(truncating_integral("v", type_name)).orderBy(F.col("i")).collect()]
        assert got == want, [(v, g, w) for v, g, w in zip(values, got, want) if g != w]


FIELD = st.one_of(
    st.sampled_from(["NA", "na", "Na", " NA", "", "  ", "CERTIFIED", "a,b", "X, Y, Z", "Dev Ops", "A,"]),
    st.text(alphabet="abAB ,.-+0123456789NA\t", max_size=10),
    TEXT,
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(*[FIELD] * 10), min_size=1, max_size=40))
def test_clean_matches_legacy_semantics(spark, rows):
    """The whole transform vs the same rules written with legacy casts and ANSI off."""
    from petitionlens.operators import clean_petitions
    from petitionlens.schema import RAW

    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], RAW)

    def na(c):
        return F.when(c == "NA", None).otherwise(c)

    upper_soc = F.upper("soc_name")
    parts = F.split("worksite", ",")
    legacy_cols = [
        F.col("id"),
        na(F.col("case_status")).alias("case_status"),
        na(F.col("employer_name")).alias("employer_name"),
        F.when(upper_soc == "NA", None).otherwise(upper_soc).alias("soc_name"),
        na(F.col("job_title")).alias("job_title"),
        na(F.col("full_time_position")).alias("full_time_position"),
        na(F.col("prevailing_wage")).cast("bigint").alias("prevailing_wage"),
        na(F.col("year")).cast("int").alias("year"),
        F.col("worksite"),
        na(F.col("lon")).cast("double").alias("lon"),
        na(F.col("lat")).cast("double").alias("lat"),
        F.trim(parts.getItem(0)).alias("city"),
        F.trim(parts.getItem(1)).alias("state"),
    ]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = [tuple(map(repr, r)) for r in df.select(*legacy_cols).orderBy("id").collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    got = [tuple(map(repr, r)) for r in clean_petitions(df).orderBy("id").collect()]
    assert got == want  # repr: NaN equals NaN
