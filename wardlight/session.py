"""Session settings, and tables written to cut long plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "wardlight", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here expects; the cluster's own settings stay."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, or a temporary one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="wardlight-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def write_stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df as parquet in the shared folder and read it back.

    The result has a one-scan plan, survives the loss of executors, and can be pruned and filtered
    at the scan like any other table.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the files of a table from write_stage once nothing reads it any more."""
    spark = df.sparkSession
    folder = work_folder(spark).rstrip("/")
    for file in df.inputFiles():
        parent = file.rsplit("/", 1)[0]
        name = parent.rsplit("/", 1)[1]
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        return
