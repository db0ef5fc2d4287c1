"""Session helpers for tests and the benchmark, and the shared scratch location.

Library functions never create a session; they take one (or a DataFrame).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("petitionlens")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide scratch folder named by ``spark.checkpoint.dir``.

    Materialised tables and checkpoints go here, never to a machine-local
    temporary folder.  The setting is read from the session; set it yourself
    only where it is unset (tests, single-machine runs).
    """
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set; point it at a shared folder")
    spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def ensure_shared_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's ``spark.checkpoint.dir``; set ``fallback`` only when unset.

    Only a ``local`` master, whose tasks all see the driver's folders, may
    fall back.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set; point it at a shared folder")
        spark.conf.set(CHECKPOINT_CONF, fallback)
    return shared_dir(spark)
