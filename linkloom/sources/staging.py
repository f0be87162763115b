"""Tables in the shared folder, where an iterative plan is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset in local mode, a temporary folder of this machine."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context._jsc.sc().getCheckpointDir().getOrElse(None)
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="linkloom-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark)}/linkloom/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stage(df: DataFrame, tag: str) -> DataFrame:
    """df written as Parquet and read again: short lineage, and nothing is lost with an executor."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def append_stages(spark: SparkSession, parts: Iterable[DataFrame], tag: str, schema: str) -> DataFrame:
    """Several tables of one schema, written one after the other and read as one."""
    path = shared_path(spark, tag)
    for number, part in enumerate(parts):
        part.write.parquet(f"{path}/block={number}")
    return spark.read.schema(schema).parquet(f"{path}/block=*")


#: A task of a spread table has at least about so many bytes of its files.
TASK_BYTES = 1 << 14


def spread(df: DataFrame) -> DataFrame:
    """df in as many partitions as there are cores, if it is a scan of fewer: one small file is not one task's work.

    A table of few bytes gets fewer partitions, so that a large cluster is not sent empty tasks.
    """
    execution = df._jdf.queryExecution()
    plan = execution.executedPlan().toString()
    if "Exchange" in plan or "AdaptiveSparkPlan" in plan:
        return df
    size = int(str(execution.optimizedPlan().stats().sizeInBytes()))
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, max(1, size // TASK_BYTES))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
