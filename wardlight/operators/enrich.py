"""Joins of reports with weather and air-quality series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import calculate_distances, grid_key, grid_nearest, hour_floor, parse_time, split_coordinates
from ..session import write_stage
from .clean import numeric_columns, quoted
from .skew import BROADCAST_ROWS, fits_broadcast, lookup_join


def mean_without_nan(name: str, kind: str):
    value = quoted(name)
    return F.avg(F.when(~F.isnan(value), value) if kind in ("double", "float") else value)


def daily_mean(df: DataFrame, time_column: str = "time", columns: Sequence[str] | None = None) -> DataFrame:
    """Mean of every numeric column per date; rows without a date are left out."""
    names = [c for c in numeric_columns(df) if c != "date"] if columns is None else list(columns)
    kinds = dict(df.dtypes)
    dated = df.select(F.to_date(quoted(time_column)).alias("date"), *[quoted(c) for c in names])
    means = [mean_without_nan(c, kinds[c]).alias(c) for c in names]
    return dated.filter(F.col("date").isNotNull()).groupBy("date").agg(*means)


def add_date(df: DataFrame, time_column: str, zone: str | None = None) -> DataFrame:
    """Add the date of a timestamp, in UTC or in the given zone."""
    t = quoted(time_column) if zone is None else F.from_utc_timestamp(quoted(time_column), zone)
    return df.withColumn("date", F.to_date(t))


def enrich_daily(reports: DataFrame, *daily: DataFrame | None, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join on date with each daily table that is given (one row per day).

    Daily tables are aggregates that are measured before they are joined, so they are computed once and written.
    """
    for table in daily:
        if table is not None:
            reports = lookup_join(reports, write_stage(table, "daily"), ["date"], "left", max_rows)
    return reports


def with_hour(df: DataFrame, time_column: str, name: str = "hour_ts") -> DataFrame:
    """Add the hour of a timestamp or of text that may not be one."""
    is_text = dict(df.dtypes)[time_column] == "string"
    t = parse_time(quoted(time_column), ()) if is_text else quoted(time_column)
    return df.withColumn(name, hour_floor(t))


def hour_join(left: DataFrame, right: DataFrame, how: str = "left", key: str = "hour_ts", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join on the hour: 'inner', 'left' or 'full'.

    A full join can use neither a broadcast nor a skew split, so it is the left join plus the right
    rows whose hour does not occur on the left; those hours are counted before they are broadcast. As the
    right side is measured and read twice, it is written first, and so are the hours of the left.
    """
    if how != "full":
        return lookup_join(left, right, [key], how, max_rows)
    right = write_stage(right, "hourly")
    matched = lookup_join(left, right, [key], "left", max_rows)
    hours = write_stage(left.select(key).filter(F.col(key).isNotNull()).distinct(), "hours")
    if fits_broadcast(hours, [key], max_rows):
        hours = F.broadcast(hours)
    return matched.unionByName(right.join(hours, [key], "left_anti"), allowMissingColumns=True)


def assign_grid_cells(df: DataFrame, delta: float = 0.1) -> DataFrame:
    """Nearest grid cell as degrees (grid_lat, grid_lon) and as integer join keys (lat_key, lon_key)."""
    return df.withColumns(
        {
            "grid_lat": grid_nearest("latitude", delta),
            "grid_lon": grid_nearest("longitude", delta),
            "lat_key": grid_key("latitude", delta),
            "lon_key": grid_key("longitude", delta),
        }
    )


def grid_hour_join(reports: DataFrame, weather: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join on grid cell and hour; clashing weather columns get the suffix _weather.

    Both sides carry lat_key and lon_key; reports carry hour_ts, weather carries time.
    """
    keys = ["lat_key", "lon_key", "hour_ts"]
    weather = weather.drop("grid_lat", "grid_lon").withColumn("hour_ts", F.col("time"))
    clash = [c for c in weather.columns if c in reports.columns and c not in keys]
    return lookup_join(reports, weather.withColumnsRenamed({c: f"{c}_weather" for c in clash}), keys, "left", max_rows)


def transform(reports: DataFrame, weather: DataFrame, delta: float = 0.1) -> DataFrame:
    """Coordinates, hours, distance to the station, grid cells, then the grid and hour join."""
    reports = split_coordinates(reports).withColumn("timestamp", parse_time("timestamp"))
    reports = calculate_distances(with_hour(reports, "timestamp"))
    return grid_hour_join(assign_grid_cells(reports, delta), assign_grid_cells(weather, delta))


def join_quality(df: DataFrame, weather_column: str, distance_column: str | None = None) -> DataFrame:
    """Rows, match rate in percent, missing rows and their share, and the mean distance if there is one."""
    found = quoted(weather_column).isNotNull()
    out = [
        F.count(F.lit(1)).alias("n_rows"),
        (F.avg(found.cast("double")) * 100).alias("match_rate"),
        F.count_if(~found).alias("n_missing"),
        (F.avg((~found).cast("double")) * 100).alias("missing_percent"),
    ]
    if distance_column:
        out.append(F.avg(quoted(distance_column)).alias("avg_distance_km"))
    return df.agg(*out)
