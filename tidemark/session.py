"""Spark settings the library relies on, and the two knobs it reads back."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Rows of one key that a single window task may hold before the key is split.
MAX_GROUP_ROWS_KEY = "spark.tidemark.maxGroupRows"
MAX_GROUP_ROWS = 10_000_000

# Rows aimed at per slice of a key that is split.
ROWS_PER_SLICE_KEY = "spark.tidemark.rowsPerSlice"
ROWS_PER_SLICE = 10_000_000

CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **confs: str) -> SparkSession:
    """A session with the settings above; keyword arguments override or extend them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**CONFS, **confs}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def max_group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(MAX_GROUP_ROWS_KEY, str(MAX_GROUP_ROWS)))


def rows_per_slice(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_PER_SLICE_KEY, str(ROWS_PER_SLICE)))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a folder of its own: a machine-local folder
    would lose the data with the executor that wrote it.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared)
    elif context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
