"""Session helpers: a UTC session, the shared checkpoint folder, stage caching."""

from __future__ import annotations

import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "remarklab", **conf: str) -> SparkSession:
    """Session with the settings every operator here relies on (UTC, AQE)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a temporary one only in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="remarklab-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cache_stage(df: DataFrame, durable: bool = False) -> DataFrame:
    """Keep a frame that several actions read.

    ``durable=False`` persists it (memory, then disk): a lost executor costs a recomputation.
    ``durable=True`` checkpoints it in the shared folder, which also cuts the lineage.
    """
    if durable:
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


# an input of up to this many splits (of 128 MB by default) counts as small
SMALL_SPLITS = 16


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Spread the scan of a small input over all cores; leave any other input alone.

    A single small Parquet file is one task however costly the text work on it is. The exchange
    moves at most ``SMALL_SPLITS`` splits. Meant for plain scans: it asks for their split count.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if cores <= 1 or df.rdd.getNumPartitions() >= min(cores, SMALL_SPLITS):
        return df
    return df.repartition(cores, *keys)
