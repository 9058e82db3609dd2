"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from curatio.session import checkpoint_dir

#: Shuffle files of a finished statement are of no use once its result is a
#: written table; this setting lets Spark drop them at the statement's end.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def cleaned_shuffles(spark: SparkSession):
    old = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, old)


#: Bytes of rows that a Python worker gets at a time: two workers of an executor
#: and the buffers that feed them hold several such batches.
_BATCH, _BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    old = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, _BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(_BATCH) if old is None else spark.conf.set(_BATCH, old)


def scratch_path(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared folder; deleted when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    _fs(spark, path)[0].deleteOnExit(_fs(spark, path)[1])
    return path


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


class Scratch:
    """Written tables of one operator run: ``put`` writes and rereads a
    table (lineage ends there, lost executors lose nothing), ``drop``
    removes one that no later step reads; ``options`` are the writer's."""

    def __init__(self, spark: SparkSession, what: str, options: dict[str, str] | None = None):
        self.spark, self.what, self.paths, self.options = spark, what, {}, options or {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.what}-{name}")
        with cleaned_shuffles(self.spark), small_batches(self.spark):
            df.write.options(**self.options).parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            drop(self.spark, self.paths.pop(name))
