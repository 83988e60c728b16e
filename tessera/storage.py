"""Shared storage: where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, a folder that all executors share; on a local master that has none, as in tests, a temporary one."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = getattr(context, "_tessera_dir", None) or "file://" + tempfile.mkdtemp(prefix="tessera-")
        context._tessera_dir = named
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """The same rows without their lineage, written to shared storage, so that what follows computes them once and survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free(spark: SparkSession) -> None:
    """Have Spark remove the shuffles that nothing needs any more: it does so when the driver collects garbage, which may be long after."""
    spark._jvm.System.gc()


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Broadcast a table that has been written if a count shows at most `rows` rows; otherwise Spark shuffles it."""
    return F.broadcast(df) if df.count() <= rows else df


class Scratch:
    """A folder in shared storage, removed when the block ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def __enter__(self) -> str:
        return self.path

    def __exit__(self, *_) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
