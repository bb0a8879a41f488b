"""Tables that are written once and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, path: str) -> None:
    """Write rows as Parquet. The shuffle files of the job go when it ends, not when the driver collects its garbage."""
    with_shuffles_removed(lambda: df.write.mode("errorifexists").parquet(path), df.sparkSession)


def with_shuffles_removed(job: Callable, spark: SparkSession):
    """The result of a job whose shuffles nobody reads again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        return job()
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
