"""Acting on many DataFrames at once: bounded concurrent job submission."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame


def act_concurrently(
    answers: dict[str, DataFrame],
    action: Callable[[str, DataFrame], object],
    *,
    concurrency: int = 4,
    pool: str | None = None,
) -> dict[str, object]:
    """Run ``action(name, df)`` for every answer, up to ``concurrency`` jobs at a time.

    Spark runs jobs submitted from separate threads in parallel, so the many
    small jobs of a catalogue run overlap instead of queueing.  ``pool``
    names a scheduler pool (``spark.scheduler.mode=FAIR``) so a big run
    shares the cluster fairly with other work.  Nothing is collected unless
    ``action`` does so.
    """
    if not answers:
        return {}
    sc = next(iter(answers.values())).sparkSession.sparkContext

    def one(item: tuple[str, DataFrame]) -> tuple[str, object]:
        name, df = item
        if pool:
            sc.setLocalProperty("spark.scheduler.pool", pool)
        return name, action(name, df)

    with ThreadPoolExecutor(max_workers=max(1, concurrency)) as workers:
        # each wrapped call carries the caller's job group and other local properties to its thread
        jobs = [workers.submit(inheritable_thread_target(one), item) for item in answers.items()]
        return dict(job.result() for job in jobs)
