"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that may be changed on a running session.
RUNTIME_CONF = {
    # Fixed zone: stored times carry none, and epoch seconds must not depend on the host.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A row may be a whole chunk of cells, so few rows make a batch.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # A table partitioned by cell may join on (cell, orbit pair) without a second exchange.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


# Settings fixed at start. Call sites recorded per column would double the time to build large plans.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app="rasterloom", master=None, **extra):
    """A session for jobs and tests. On a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_CONF, **RUNTIME_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark):
    """Put the runtime settings on a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark, name):
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir`` when the cluster names one. Only a local session may fall
    back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
