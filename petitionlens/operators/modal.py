"""Most frequent item per group, with ties kept.

Plan: one group-by on (group, item); the per-group maximum is a second,
tiny aggregate over those counts (Spark reuses the first shuffle for it);
then the counts are equi-joined back on (group, maximum).  No window is
used, so no single task ever holds every item of a hot group, and no
broadcast is forced: AQE turns the join into a broadcast at run time only
when the measured size of the per-group maxima is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, and keeps a shuffle join
otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def modal_by(df: DataFrame, group: str, item: str, name: str) -> DataFrame:
    """(group, item, n) for the item(s) with the largest ``COUNT(item)`` per group.

    NULL groups are dropped.  A NULL item forms its own group with count 0,
    so it is reported only when every item of the group is NULL.
    """
    counts = (
        df.where(F.col(group).isNotNull())
        .groupBy(group, item)
        .agg(F.count(F.col(item)).alias(name))
    )
    best = counts.groupBy(group).agg(F.max(name).alias("_best")).withColumnRenamed(group, "_group")
    joined = counts.join(
        best, (counts[group] == best["_group"]) & (counts[name] == best["_best"]), "inner"
    )
    return joined.select(counts[group], counts[item], counts[name])
