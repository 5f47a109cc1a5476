"""Consecutive numbers in key order without sorting everything in one task."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 200_000
MAX_BUCKETS = 10_000


def add_dense_index(df: DataFrame, key: str, name: str, ties: tuple[str, ...] = (), rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add 0-based positions in the order of a numeric key and, within equal keys, of the `ties` columns.

    Quantiles cut the key range into buckets; each bucket is ranked by itself and shifted by the number
    of rows in the buckets before it. df is read several times, so it should be a table.
    """
    n = df.count()
    buckets = min(MAX_BUCKETS, math.ceil(n / rows_per_bucket))
    if buckets <= 1:
        bucketed, offset = df.withColumn("_bucket", F.lit(0)), F.lit(0)
    else:
        cuts = df.approxQuantile(key, [i / buckets for i in range(1, buckets)], 1 / (4 * buckets))
        splits = [-math.inf, *sorted(set(cuts)), math.inf]
        numbered = df.withColumn("_key", F.col(key).cast("double"))
        bucketed = Bucketizer(splits=splits, inputCol="_key", outputCol="_bucket").transform(numbered).drop("_key")
        bucketed = bucketed.withColumn("_bucket", F.col("_bucket").cast("int"))
        sizes = {r["_bucket"]: r["count"] for r in bucketed.groupBy("_bucket").count().collect()}
        starts, before = [], 0
        for b in range(len(splits) - 1):
            starts.append(F.lit(before))
            before += sizes.get(b, 0)
        offset = F.get(F.array(*starts), F.col("_bucket"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(key, *ties)) - 1
    return bucketed.withColumn(name, (rank + offset).cast("bigint")).drop("_bucket")
