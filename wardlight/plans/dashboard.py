"""The queries behind the overview dashboard and the map page, each a table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import name_parts, parse_date, parse_time, split_coordinates
from ..operators import aggregates as A
from ..operators import clean as C
from ..operators import clusters, dedupe, labels, sampling
from ..session import write_stage
from ..sources.tables import WEATHER_COLUMNS

# Numeric columns of the dashboard table.
NUMERIC = (*WEATHER_COLUMNS, "pm25", "pm10", "o3", "no2")
# Columns that the map page leaves out.
MAP_UNUSED = (
    "timestamp", "o3", "no2", "dew_point_2m (°C)", "vapour_pressure_deficit (kPa)", "cloud_cover (%)",
    "wind_direction_10m (°)", "surface_pressure (hPa)", "wind_speed_10m (km/h)", "province", "rain (mm)", "coords",
)
MAP_EPS = 0.0008


def dashboard_table(merged: DataFrame) -> DataFrame:
    """Trimmed names, numeric weather and air columns, time, hour, day and month names."""
    df = C.coerce_numeric(C.strip_names(merged), NUMERIC)
    t = parse_time("timestamp") if dict(df.dtypes)["timestamp"] == "string" else F.col("timestamp")
    df = df.withColumn("timestamp", t)
    return df.withColumns({"hour": F.hour("timestamp"), **name_parts("timestamp")})


def dashboard(df: DataFrame, start: date, end: date, district: str | None = None, bins: int = 20) -> dict[str, DataFrame]:
    """All tables of one dashboard request over a date range and, if given, one district."""
    kept = C.equals_unless_all(C.between_dates(df, "timestamp", start, end), "district", district)
    present = [c for c in NUMERIC if c in df.columns]
    tables = {
        "metrics": A.metrics(kept, "district", present, present, [c for c in present if c == "rain (mm)"]),
        "top_districts": A.top_counts(kept, "district"),
        "district_count_range": A.count_range(kept, "district"),
        "by_date": A.counts_by(kept, F.to_date("timestamp"), "date"),
        "by_hour": A.counts_by(kept, "hour"),
        "by_day_of_week": A.counts_by_day_of_week(kept, "timestamp"),
        "day_hour": A.day_hour_table(kept, "timestamp"),
    }
    for name in ("rain (mm)", "pm25"):
        if name in df.columns:
            tables[f"bins_{name}"] = A.equal_width_counts(kept, name, bins)
    return tables


def map_table(merged: DataFrame) -> DataFrame:
    """Rows with a date, two coordinates and at least one label; types is the label list."""
    df = C.strip_names(merged)
    if dict(df.dtypes)["date"] == "string":
        df = df.withColumn("date", parse_date("date"))
    df = C.drop_incomplete(split_coordinates(df), ["date", "latitude", "longitude"])
    kind = dict(df.dtypes)["type"]
    types = F.col("type") if kind.startswith("array") else labels.label_list_without_braces(F.col("type"))
    df = df.withColumn("types", types).filter((F.size("types") > 0) & (F.col("types") != F.array(F.lit(""))))
    return C.coerce_numeric(C.drop_columns(df, MAP_UNUSED), ["pm25"])


def map_points(df: DataFrame, id_column: str, year: int, types: Sequence[str], max_rows: int | None = None, eps: float = MAP_EPS, min_samples: int = 1, seed: int = 42) -> DataFrame:
    """The clustered points of the map: year and labels, one row per place and day, the last 365 days, and
    their density clusters. A map that can draw no more may ask for a sample of max_rows points."""
    kept = clusters.round_coordinates(C.any_label(C.in_year(df, "date", year), types))
    single = dedupe.first_per_key(kept, ["latitude", "longitude", "date"], [id_column])
    recent = write_stage(C.trailing_days(write_stage(single, "places"), "date"), "places")
    shown = recent if max_rows is None else sampling.sample_data(recent, id_column, max_rows, seed)
    return clusters.dbscan(shown, id_column, eps, min_samples)


def map_tables(df: DataFrame, id_column: str, year: int, types: Sequence[str], histogram_bins: int = 10) -> dict[str, DataFrame]:
    """All tables of one map request. The PM2.5 ranges count rows before places are made unique."""
    chosen = C.any_label(C.in_year(df, "date", year), types)
    points = map_points(df, id_column, year, types)
    return {
        "pm25_ranges": A.fixed_range_counts(chosen, "pm25"),
        "points": points,
        "heat": A.density(points),
        "centre": A.centroid(df),
        "histogram": A.equal_width_counts(points, "pm25", histogram_bins),
        "types": dedupe.distinct_sorted(df.select(F.explode("types").alias("type")), "type"),
        "years": dedupe.distinct_sorted(df.select(F.year("date").alias("year")), "year"),
    }
