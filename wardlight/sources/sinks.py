"""Writers. Every output is a folder of part files; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def folder_bytes(spark: SparkSession, path: str) -> int:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(target).getLength()


def flat_for_csv(df: DataFrame) -> DataFrame:
    """CSV has no arrays: lists of text become '{a, b}' again."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: F.concat(F.lit("{"), F.concat_ws(", ", F.col(c)), F.lit("}")) for c in lists})


def save_csv(df: DataFrame, path: str) -> str:
    flat_for_csv(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def save_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def save_merged(df: DataFrame, folder: str, name: str = "merged", csv: bool = True) -> dict[str, str]:
    """Parquet first; the CSV is written from it, so that the joins run once."""
    paths = {"parquet": save_parquet(df, f"{folder}/{name}.parquet")}
    if csv:
        paths["csv"] = save_csv(df.sparkSession.read.parquet(paths["parquet"]), f"{folder}/{name}.csv")
    return paths


def save_aggregations(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    return {name: save_csv(df, f"{folder}/{name}_summary") for name, df in tables.items()}


def save_all(df: DataFrame, tables: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Write the merged table in both formats and the summaries; return the sizes in MB."""
    spark = df.sparkSession
    paths = save_merged(df, folder)
    save_aggregations(tables, folder)
    csv_mb, parquet_mb = (folder_bytes(spark, paths[k]) / (1024 * 1024) for k in ("csv", "parquet"))
    smaller = (1 - parquet_mb / csv_mb) * 100 if csv_mb else None
    return spark.createDataFrame(
        [(csv_mb, parquet_mb, smaller, folder)], "csv_mb double, parquet_mb double, percent_smaller double, folder string"
    )
