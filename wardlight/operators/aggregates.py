"""Counts, cross-tabs, histograms and scalar metrics of the dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    DAY_NAMES, PM25_EDGES, PM25_LABELS, cut_fixed, equal_bin, equal_bin_mid, grid_floor,
)
from .clean import known, quoted


def counts_by(df: DataFrame, key: Column | str, name: str | None = None) -> DataFrame:
    """Rows per value; NULL keys are left out."""
    column = F.col(key) if isinstance(key, str) else key
    name = name or key
    return df.select(column.alias(name)).filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def top_counts(df: DataFrame, key: str, k: int = 15) -> DataFrame:
    """The k most frequent values, ties in order of the value."""
    return counts_by(df, key).orderBy(F.desc("n"), key).limit(k)


def count_range(df: DataFrame, key: str) -> DataFrame:
    """Smallest and largest count over all values (the colour range of the bar chart)."""
    return counts_by(df, key).agg(F.min("n").alias("min_n"), F.max("n").alias("max_n"))


def day_dimension(df: DataFrame) -> DataFrame:
    """Seven rows: day_index 0..6 and the English name, Monday first."""
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    days = df.sparkSession.range(len(DAY_NAMES))
    return days.select(F.col("id").cast("int").alias("day_index"), F.get(names, F.col("id").cast("int")).alias("day_name"))


def counts_by_day_of_week(df: DataFrame, time_column: str) -> DataFrame:
    """All seven days in order; a day without rows has a NULL count."""
    counted = counts_by(df, F.weekday(time_column), "day_index")
    return day_dimension(df).join(F.broadcast(counted), "day_index", "left").orderBy("day_index")


def day_hour_table(df: DataFrame, time_column: str) -> DataFrame:
    """Day of week x hour: columns h00..h23, zero-filled; days without rows are NULL."""
    hours = [f"h{h:02d}" for h in range(24)]
    parts = df.select(F.weekday(time_column).alias("day_index"), F.hour(time_column).alias("hour"))
    table = parts.groupBy("day_index").agg(*[F.count_if(F.col("hour") == h).alias(c) for h, c in enumerate(hours)])
    return day_dimension(df).join(F.broadcast(table), "day_index", "left").orderBy("day_index")


def metrics(df: DataFrame, district: str, averages: Sequence[str], maxima: Sequence[str] = (), sums: Sequence[str] = ()) -> DataFrame:
    """Row count, distinct districts and the mean, maximum and sum of the known values of columns, as one row."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(quoted(district)).alias("n_districts"),
        *[F.avg(known(df, c)).alias(f"avg_{c}") for c in averages],
        *[F.max(known(df, c)).alias(f"max_{c}") for c in maxima],
        *[F.sum(known(df, c)).alias(f"sum_{c}_over_rows") for c in sums],
    )


def equal_width_counts(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """(bin, mid, n) of right-closed equal-width ranges; empty ranges are kept.

    The two bounds are read first, so that the ranges are constants in the counting plan.
    """
    values = df.select(quoted(column).cast("double").alias("x")).filter("x is not null and not isnan(x)")
    low, high = (F.lit(v).cast("double") for v in values.agg(F.min("x"), F.max("x")).first())
    counted = values.select(equal_bin("x", low, high, bins).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counted), "bin", "left").select(
        "bin", equal_bin_mid(F.col("bin"), low, high, bins).alias("mid"), F.coalesce("n", F.lit(0)).alias("n")
    )


def fixed_range_counts(df: DataFrame, column: str, edges: Sequence[float] = PM25_EDGES, labels: Sequence[str] = PM25_LABELS) -> DataFrame:
    """(range_index, range_label, n); empty ranges are kept, values outside are not counted."""
    counted = counts_by(df, cut_fixed(quoted(column), edges, labels), "range_label")
    names = F.array(*[F.lit(x) for x in labels])
    index = F.col("id").cast("int")
    every = df.sparkSession.range(len(labels)).select(index.alias("range_index"), F.get(names, index).alias("range_label"))
    return every.join(F.broadcast(counted), "range_label", "left").select(
        "range_index", "range_label", F.coalesce("n", F.lit(0)).alias("n")
    )


def density(df: DataFrame, delta: float = 0.01) -> DataFrame:
    """Reports per grid cell, each with weight 1."""
    cell = df.select(grid_floor("longitude", delta).alias("lon_bin"), grid_floor("latitude", delta).alias("lat_bin"))
    return cell.groupBy("lon_bin", "lat_bin").agg(F.count(F.lit(1)).alias("n"))


def centroid(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))


def value_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[e for c in columns for e in (F.min(quoted(c)).alias(f"min_{c}"), F.max(quoted(c)).alias(f"max_{c}"))])


def modes(df: DataFrame, column: str) -> DataFrame:
    """All most frequent values."""
    counted = counts_by(df, column)
    return counted.filter(F.col("n") == counted.agg(F.max("n")).scalar())


def importance_by_category(importance: DataFrame) -> DataFrame:
    """Sum of importance per feature category, largest first."""
    from ..functions.scalars import feature_category

    named = importance.withColumn("category", feature_category("feature"))
    return named.groupBy("category").agg(F.sum("importance").alias("importance")).orderBy(F.desc("importance"), "category")


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(step, stage, n_rows): the funnel of row counts through a pipeline, in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "n_rows")
        for i, (name, df) in enumerate(stages.items())
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def filter_funnel(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """(step, stage, n_rows) of filters that follow each other on one table, counted in one scan."""
    passed, counts = F.lit(True), []
    for i, (name, condition) in enumerate(steps.items()):
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"), F.count_if(passed).alias("n_rows")))
    return df.agg(F.array(*counts).alias("steps")).select(F.inline("steps"))
