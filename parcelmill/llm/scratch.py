"""Tables that a job writes for itself, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset (a local test), one temporary folder a process."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="parcelmill-"))
    return "file://" + _own[0]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows and read them back: the lineage ends here, and a lost executor costs no recomputation of it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """Like `stored`, in a bucket of the keys for each shuffle partition, so that joins by the keys leave these rows where they are.

    Rows that are spread by the keys already make one file a bucket. The table is known to the catalog only while it is read in.
    """
    spark = df.sparkSession
    path, table = new_folder(spark, name), f"spark_catalog.default.parcelmill_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, *keys).saveAsTable(table, format="parquet", path=path, compression="zstd")
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # its path was given, so the files stay
    return rows
