"""Staged tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from covtab.paths import delete
from covtab.session import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, scheme included."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: later
    stages, and retries after a lost executor, start from the files."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Workspace:
    """The staged tables of one computation, which go when its result stands."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for path in self.paths:
            delete(self.spark, path)
        self.paths = []


BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of at most ``BATCH_BYTES`` (one row at
    least), however long the texts are."""
    now = spark.conf.get(_BATCH_CONF, None)
    if now is None or int(now.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
