"""Session settings the package is tuned for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


# One shuffle partition should hold about this much, so that it sorts in memory or spills little.
PARTITION_BYTES = 128 * 1024 * 1024


def partitions_for(shuffle_bytes: int, cores: int) -> int:
    """Initial shuffle partitions for a volume: AQE merges partitions that turn out small but never adds any,
    so a large input needs a large number from the start (about 800,000 for 100 TB)."""
    return max(2 * cores, -(-shuffle_bytes // PARTITION_BYTES))


def build_session(
    app: str, master: str | None = None, shuffle_partitions: int | None = None, input_bytes: int | None = None,
) -> SparkSession:
    """A session with AQE, skew-join handling and UTC. Give ``shuffle_partitions``, or ``input_bytes`` to have
    the number derived from the volume of a run."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    if input_bytes and not shuffle_partitions:
        wanted = partitions_for(input_bytes, spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only where that is unset *and* the master is local does a temporary folder stand in for it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@lru_cache
def _local_dir(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"tidemark-{application_id}-")


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever reused or cleared."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
