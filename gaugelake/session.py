"""Session settings and scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Also the size at which the rebalancing writes split a month into files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Let AQE turn a shuffled join into a broadcast only after the side's size is known.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # Series and station keys recur in every report; a bloom filter trims the fact side of the
    # joins too big to broadcast.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Session windows of one busy series shrink before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Keys in state are not bounded by executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "gaugelake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tuned(spark: SparkSession) -> SparkSession:
    """A sibling session (same application and catalog) with this package's SQL settings."""
    session = spark.newSession()
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    for key in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"):
        session.conf.set(key, spark.conf.get(key))
    return session


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Of writes begun inside, shuffle files are deleted as soon as the write has ended. By default they lie on the executors'
    disks until the driver's garbage collection finds them unused, so that those of all steps of a job add up."""
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


_local_base: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The folder that holds everything this application writes aside.

    Lives under the shared folder the cluster names in ``spark.checkpoint.dir``. Where that is unset a temporary
    folder stands in on one machine (tests); on a cluster executors would not see it, so there it is an error.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="gaugelake-")
        base = _local_base
    return f"{base.rstrip('/')}/gaugelake/{spark.sparkContext.applicationId}"


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path for written intermediate tables, below :func:`scratch_root`.

    Results are lazy and may still read it, so it is left to the application to delete the root at its end
    (``sinks.tables.delete(spark, scratch_root(spark))``, as ``bench.py`` and ``check.py`` do).
    """
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"
