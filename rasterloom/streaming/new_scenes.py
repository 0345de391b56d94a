"""Incremental scenes: the streaming form of parsing names and dropping what is stored."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasterloom.functions import names


def read_landing(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """File stream over a landing folder.

    A batch may be one large file, which few tasks can read; its rows are spread over all before anything is made of them.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder).repartition(max(2, spark.sparkContext.defaultParallelism))


class Runs:
    """The runs of a job, kept beside its checkpoint: one that was not finished goes on under its own name.

    Every record is a small file of its own, written whole or not at all.
    """

    SCHEMA = "run string, state int"
    STARTED, FINISHED = 1, 2

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.path = spark, f"{checkpoint.rstrip('/')}-runs"

    def _record(self, run, state):
        self.spark.createDataFrame([(run, state)], self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def begin(self) -> str:
        """The name of the run that a crash left open, or a new one."""
        self.spark.createDataFrame([], self.SCHEMA).write.mode("ignore").parquet(self.path)
        last = self.spark.read.schema(self.SCHEMA).parquet(self.path).agg(F.max(F.struct("run", "state")).alias("x")).first().x
        if last is not None and last.state == self.STARTED:
            return last.run
        run = f"{time.time_ns():020d}"
        self._record(run, self.STARTED)
        return run

    def finish(self, run):
        self._record(run, self.FINISHED)


class Job:
    """A running stream. Its run is finished once the folder is drained and that was waited for."""

    def __init__(self, query, runs: Runs, run: str):
        self.query, self.runs, self.run, self.stopped = query, runs, run, False

    def awaitTermination(self, timeout=None):
        """As of a query: raises what the stream failed with. A run that failed or was stopped stays open."""
        done = self.query.awaitTermination(timeout) if timeout is not None else self.query.awaitTermination()
        if not self.query.isActive and not self.stopped and self.query.exception() is None:
            self.runs.finish(self.run)
            self.stopped = True
        return done

    def stop(self):
        self.stopped = True
        self.query.stop()

    def __getattr__(self, name):
        return getattr(self.query, name)


def stream_new_scenes(scenes: DataFrame, table: str, checkpoint: str, key: str = "stamp") -> Job:
    """Append scenes whose key is not stored yet to a Parquet table, then stop once the folder is drained.

    ``scenes`` holds ``region, name``. As in ``anti_new_scenes``, stored means stored before the run
    began: several new scenes of one second are all kept, however the files fall into batches. Within
    a run a scene is kept once by its full name.

    The state is the table itself, so no streaming state grows with time. It is partitioned by day, run
    and batch; a batch reads the days it holds scenes of, and no others. A run that broke off is taken up
    under its own name (see ``Runs``) by the next job on its checkpoint, so what it stored is not taken
    for older than what is still to come, and a batch is stored whole or not at all: a broken
    run leaves the table that an unbroken one would have left. Read the table by ``read_scenes``, which also
    knows days that ``compact`` has put together.
    """
    def keyed(df):
        parsed = df.select("*", *names.scene_name_columns(F.col("name")))
        return parsed.withColumn(key, F.regexp_replace("datetime", r"\D", "")).withColumn("day", F.substring(key, 1, 8))

    spark = scenes.sparkSession
    rest = [f for f in keyed(scenes).schema.fields if f.name != "day"]
    # An empty folder gives the table its columns; a later job leaves the table as it is.
    spark.createDataFrame([], T.StructType(rest)).write.mode("ignore").parquet(f"{table}/day=none/job=none/batch=-1")
    runs = Runs(spark, checkpoint)
    run = runs.begin()

    def append(batch: DataFrame, batch_id: int):
        # Its days are asked for before it is stored, so the batch is kept meanwhile and its files are read once.
        batch.persist()
        try:
            days = [r.day for r in keyed(batch).select("day").distinct().collect()]  # a batch spans few days, and at most all days
            once = keyed(batch.groupBy("region", "name").agg(F.any_value(F.struct(*batch.columns)).alias("s")).select("s.*"))
            stored = read_scenes(batch.sparkSession, table, rest).where(F.col("day").isin(days))
            # The stored table packs well, so its files tell little of its rows: it is never broadcast.
            before = stored.where(F.col("job") != run).select("region", key).hint("merge")
            # Only earlier batches count, so a retried batch is not its own past.
            mine = stored.where((F.col("job") == run) & (F.col("batch") < batch_id)).select("region", "name").hint("merge")
            fresh = once.join(before, ["region", key], "left_anti").join(mine, ["region", "name"], "left_anti")
            fresh = fresh.select(*[f.name for f in rest], "day", F.lit(run).alias("job"), F.lit(batch_id).alias("batch"))
            # Rows of one day together, as far as a task's fair share allows: else every task writes a file for every day.
            fresh = fresh.hint("rebalance", F.col("day"))
            fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "job", "batch").parquet(table)
        finally:
            batch.unpersist()

    query = scenes.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    return Job(query, runs, run)


PLACES = [T.StructField("day", T.StringType()), T.StructField("job", T.StringType()), T.StructField("batch", T.LongType())]
COMPACTED = "compacted-"
COMPACTIONS = "day string, job string, name string"


def _compactions(spark, table):
    path = f"{table.rstrip('/')}-compactions"
    spark.createDataFrame([], COMPACTIONS).write.mode("ignore").parquet(path)
    return spark.read.schema(COMPACTIONS).parquet(path), path


def read_scenes(spark: SparkSession, table: str, columns=None) -> DataFrame:
    """The stored scenes with ``day, job, batch``, each once, also while a compaction is under way or after one broke off.

    A compacted folder counts from the moment its record is written; from then on the folders it was made of do not.
    """
    reader = spark.read
    if columns is not None:
        reader = reader.schema(T.StructType([*columns, *PLACES]))
    rows = reader.parquet(table)
    done = _compactions(spark, table)[0]
    # One row for each folder that was put together since the last clean-up: small, and broadcast only if it is.
    replaced = done.select("day", "job").distinct()
    valid = done.select("day", F.col("name").alias("job")).distinct()
    made = F.col("job").startswith(COMPACTED)
    plain = rows.where(~made).join(replaced, ["day", "job"], "left_anti")
    whole = rows.where(made).join(valid, ["day", "job"], "left_semi").join(replaced, ["day", "job"], "left_anti")
    return plain.unionByName(whole)


def compact(spark: SparkSession, table: str, checkpoint: str, most: int = 4) -> int:
    """Put the folders of each day that has more than ``most`` into one; how many days were.

    Only finished runs are touched. The new folders are written, then a record of what they replace, then
    the old folders are deleted: a job that dies in between loses and doubles nothing, and the next call
    deletes what was left. Rows keep nothing of the runs they came from but that these are over.
    """
    runs = Runs(spark, checkpoint)
    spark.createDataFrame([], Runs.SCHEMA).write.mode("ignore").parquet(runs.path)
    open_runs = spark.read.schema(Runs.SCHEMA).parquet(runs.path).groupBy("run").agg(F.max("state").alias("state")).where(
        F.col("state") == Runs.STARTED).select(F.col("run").alias("job"))
    rows = read_scenes(spark, table).where(F.col("job") != "none").join(open_runs, "job", "left_anti")
    folders = rows.select("day", "job", "batch").distinct()
    days = folders.groupBy("day").count().where(F.col("count") > most).select("day")
    name = f"{COMPACTED}{time.time_ns():020d}"
    replaced = folders.join(days, "day").select("day", "job").distinct().withColumn("name", F.lit(name))
    listed = [tuple(r) for r in replaced.collect()]  # a row for each folder to be put together
    record, path = _compactions(spark, table)
    if listed:
        whole = rows.join(days, "day").withColumns({"job": F.lit(name), "batch": F.lit(0).cast("bigint")})
        whole.repartition("day").write.mode("append").partitionBy("day", "job", "batch").parquet(table)
        spark.createDataFrame(listed, COMPACTIONS).coalesce(1).write.mode("append").parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    for day, job in {tuple(r) for r in record.select("day", "job").distinct().collect()} | {x[:2] for x in listed}:
        folder = hadoop.Path(f"{table}/day={day}/job={job}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len({day for day, _, _ in listed})
