"""Finished intermediates, kept by what they were made from.

An intermediate's key is a digest of its name, its parameters and the files of its inputs: path, size and time of
change of each. A job that asks for a key that is there reads it; else it makes the table, writes it aside and
moves it to its place, so a table in its place is whole. A changed input has another key.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.session import scratch_dir

_roots: dict = {}


def store_root(spark: SparkSession) -> str:
    """Where intermediates are kept: beside the checkpoints if the cluster names a folder, else for this session only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is not None:
        return f"{shared.rstrip('/')}/intermediates"
    application = spark.sparkContext.applicationId
    if application not in _roots:
        _roots[application] = scratch_dir(spark, "intermediates")
    return _roots[application]


def files_digest(table: DataFrame) -> str:
    """Digest of the files behind a plain file scan: their number and a sum of hashes, combined before the shuffle. One row reaches the driver."""
    files = table.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    lane = lambda seed: F.sum(F.xxhash64(F.lit(seed), "file_path", "file_size", "file_modification_time").cast("decimal(38,0)")).alias(f"h{seed}")
    return str(tuple(files.agg(F.count(F.lit(1)).alias("n"), lane(1), lane(2)).first()))


def intermediate(spark: SparkSession, name: str, inputs: list[DataFrame], parameters: dict, build: Callable[[], DataFrame], root: str | None = None) -> DataFrame:
    """The table ``name`` made from ``inputs`` (plain file scans) with ``parameters``: read if it is there, else built and kept.

    ``build`` is called only if it has to be. Two jobs that build one key at a time both end with a whole table: the
    one that comes second reads the first one's. Nothing is ever deleted; clear the folder when its inputs are gone.
    """
    text = json.dumps([name, sorted(parameters.items()), [files_digest(t) for t in inputs]], default=str)
    path = f"{(root or store_root(spark)).rstrip('/')}/{name}-{hashlib.sha256(text.encode()).hexdigest()[:32]}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    place = jvm_path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(jvm_path(path, "_SUCCESS")):
        aside = f"{path}.{uuid.uuid4().hex}"
        build().write.parquet(aside)
        if not files.exists(place):
            files.rename(jvm_path(aside), place)
        if not files.exists(jvm_path(path, "_SUCCESS")):  # moved into a folder that another job was just putting there
            path = aside
    return spark.read.parquet(path)
