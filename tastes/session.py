"""Session helpers for local runs (tests, bench) and the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

CHECKPOINT_DIR_CONF = "spark.checkpoint.dir"


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "tastes",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks.

    On a cluster, build the session with `spark-submit` instead; nothing in
    the library depends on these settings.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # A session that runs many distinct queries keeps their compiled
        # whole-stage code; the default of 100 classes is exceeded by a
        # dozen multi-stage queries, and each run would compile again.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    return spark.conf.get(CHECKPOINT_DIR_CONF, None) or None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint folder; set `fallback` only when none is set."""
    current = checkpoint_dir(spark)
    if current:
        return current
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir() or fallback
