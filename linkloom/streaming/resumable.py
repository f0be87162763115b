"""Resumable scoring: a file stream that handles what is there, once, and stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import require_same_manifest


def run_available(spark: SparkSession, source: str, schema: str, checkpoint: str, output: str, manifest: dict, score: Callable[[DataFrame], DataFrame], files_per_batch: int = 8) -> int:
    """Scores new Parquet files of source into output and returns the number of batches.

    Each batch replaces a subfolder of its own, so one that is run again leaves its rows once. A checkpoint is
    bound to its manifest: with another model, threshold or catalog it is refused.
    """
    require_same_manifest(f"{checkpoint}/manifest.json", manifest)
    done = []

    def batch(df: DataFrame, number: int) -> None:
        score(df).write.mode("overwrite").parquet(f"{output}/batch={number:09d}")
        done.append(number)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{checkpoint}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)


def rows_of(spark: SparkSession, output: str) -> DataFrame:
    """All batches' rows."""
    return spark.read.parquet(output).drop("batch")
