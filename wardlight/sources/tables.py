"""Readers. Text files are read as strings and typed later with expressions that cannot fail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import parse_time, to_number
from ..operators.clean import null_tokens_to_null, strip_names
from ..operators.dedupe import first_per_key
from ..operators.skew import lookup_join
from .quoted import read_quoted_csv

TIME_COLUMN = "time"
# Column names of the hourly weather files.
WEATHER_COLUMNS = (
    "temperature_2m (°C)",
    "dew_point_2m (°C)",
    "relative_humidity_2m (%)",
    "rain (mm)",
    "vapour_pressure_deficit (kPa)",
    "cloud_cover (%)",
    "wind_direction_10m (°)",
    "surface_pressure (hPa)",
    "wind_speed_10m (km/h)",
)
# Gases that the air-quality reader leaves out.
DROPPED_GASES = ("so2", "co")
SITE_IN_NAME = r"open-meteo-([0-9.]+)N([0-9.]+)E"
DATA_LINE = r'^\s*"?\d{4}-\d{2}-\d{2}'


def read_reports(spark: SparkSession, path: str | list[str], multi_line: bool = True, range_bytes: int | None = None) -> DataFrame:
    """Report CSV with quoted line breaks, all columns as text.

    Spark reads a file with quoted line breaks in one task. With range_bytes each file is read by many
    tasks, one for so many bytes (read_quoted_csv); pass multi_line=False when the free text is known to
    hold no line breaks.
    """
    if range_bytes:
        return null_tokens_to_null(read_quoted_csv(spark, path, range_bytes))
    raw = spark.read.csv(path, header=True, multiLine=multi_line, escape='"', quote='"')
    return null_tokens_to_null(raw)


#: Different header lines that the weather files of one read may have.
MAX_HEADERS = 1_000


def _weather_lines(spark: SparkSession, path: str | list[str]) -> list[tuple[list[str], DataFrame]]:
    """(column names, data lines with their file name) for every header among the files."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file"))
    heads = lines.filter(F.ltrim("value").startswith(TIME_COLUMN + ",")).select("file", F.trim("value").alias("head")).distinct()
    found = sorted(r["head"] for r in heads.select("head").distinct().limit(MAX_HEADERS + 1).collect())
    if not found or len(found) > MAX_HEADERS:
        raise ValueError(f"expected header lines starting with 'time,', at most {MAX_HEADERS} different ones")
    data = lines.filter(F.col("value").rlike(DATA_LINE))
    if len(found) == 1:
        return [(found[0].split(","), data)]
    with_head = lookup_join(data, heads, ["file"], "inner")
    return [(head.split(","), with_head.filter(F.col("head") == head)) for head in found]


def _typed_weather(names: list[str], lines: DataFrame, *extra: str) -> DataFrame:
    fields = ", ".join(f"`{n.strip()}` STRING" for n in names)
    row = lines.select(F.from_csv("value", fields).alias("r"), *extra)
    typed = [
        (parse_time(F.col(f"r.`{n}`")) if n == TIME_COLUMN else to_number(F.col(f"r.`{n}`"))).alias(n)
        for n in (name.strip() for name in names)
    ]
    return row.select(*typed, *extra)


def _read_weather(spark: SparkSession, path: str | list[str], *extra: str) -> DataFrame:
    """Files with different columns are put together by name; what a file lacks is NULL."""
    parts = [_typed_weather(names, lines, *extra) for names, lines in _weather_lines(spark, path)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_weather(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Hourly weather, with or without the coordinate lines that some files carry above the header.

    Header and data lines are told apart by their content, so files can be split at will.
    """
    return _read_weather(spark, path)


def read_weather_sites(spark: SparkSession, folder: str) -> DataFrame:
    """All weather files of a folder, with the site's coordinates taken from the file name.

    Of several rows for one hour and site, the one from the first file name is kept.
    """
    typed = _read_weather(spark, f"{folder.rstrip('/')}/*.csv", "file_name")
    sites = typed.withColumns(
        {
            "latitude": to_number(F.regexp_extract("file_name", SITE_IN_NAME, 1)),
            "longitude": to_number(F.regexp_extract("file_name", SITE_IN_NAME, 2)),
        }
    )
    return first_per_key(sites, [TIME_COLUMN, "latitude", "longitude"], ["file_name"]).drop("file_name")


def read_air_quality(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Daily air quality: trimmed names, DATE key, numeric values, without SO2 and CO."""
    raw = strip_names(spark.read.csv(path, header=True))
    raw = raw.drop(*[c for c in raw.columns if c.lower() in DROPPED_GASES])
    return raw.select(
        *[(F.to_date(parse_time(c)) if c == "date" else to_number(F.col(f"`{c}`"))).alias(c) for c in raw.columns]
    )


def read_air_quality_if_present(spark: SparkSession, path: str | None) -> DataFrame | None:
    """None when there is no air-quality file, so that the pipeline can go on without it."""
    if path is None:
        return None
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return read_air_quality(spark, path) if files.exists(target) else None


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Resume from a merged table written earlier."""
    return spark.read.parquet(path)


def extract(spark: SparkSession, reports_path: str, weather_path: str) -> tuple[DataFrame, DataFrame]:
    """(reports, weather)."""
    return read_reports(spark, reports_path), read_weather(spark, weather_path)
