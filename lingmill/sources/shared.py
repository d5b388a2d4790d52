"""The folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder named by the cluster in `spark.checkpoint.dir`.

    Only a local session without that setting (a test) gets a temporary folder of its own.
    """
    folder = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_KEY} to a folder that all executors share")
    folder = spark.sparkContext._jsc.sc().getCheckpointDir()
    if folder.isEmpty():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lingmill-"))
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
    return folder.get()


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives the planner the true size
    of the data, so that it broadcasts the table only if it is small.
    """
    spark = df.sparkSession
    path = path or run_folder(spark, "table")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system, if it is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
