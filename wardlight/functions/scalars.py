"""Column expressions: coordinates, time, binning and text. No Python runs per row."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KM_PER_DEGREE = 111
# Every character that counts as white space in Unicode.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
# Tried in this order once the ISO cast has failed.
TIMESTAMP_FORMATS = (
    "M/d/yyyy[ H:m[:s]]", "M/d/yyyy h:m[:s] a", "d/M/yyyy[ H:m[:s]]", "d/M/yyyy h:m[:s] a", "yyyy/M/d[ H:m[:s]]",
    "MMM d[,] yyyy[ H:m[:s]]", "MMMM d[,] yyyy[ H:m[:s]]", "d MMM yyyy[ H:m[:s]]", "d MMMM yyyy[ H:m[:s]]",
)

# Substring rules of the importance report, checked in this order.
FEATURE_CATEGORIES = (
    ("Temporal", ("hour", "day", "month", "weekend")),
    ("Air Quality", ("pm", "o3", "no2", "aqi")),
    ("Weather", ("temp", "rain", "wind", "humidity", "pressure", "cloud", "precipitation")),
    ("Location", ("lat", "long", "district")),
)
OTHER_CATEGORY = "Other"

# PM2.5 ranges of the map page.
PM25_EDGES = (0, 12, 35, 55, 150, 250, 500)
PM25_LABELS = ("0-12", "13-35", "36-55", "56-150", "151-250", "251+")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove surrounding white space of any kind, no-break spaces included."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def to_number(c: Column | str) -> Column:
    """Text to DOUBLE; anything that is not a number becomes NULL, NaN included."""
    text = _col(c).cast("string")
    # The JVM also reads type suffixes and hexadecimal floats, which are no numbers here.
    java_only = text.rlike(r"(?i)^\s*[+-]?[0-9.]+(e[+-]?[0-9]+)?[df]\s*$|0x")
    value = text.try_cast("double")
    return F.when(~java_only & ~F.isnan(value), value)


def round_even(c: Column | str, digits: int) -> Column:
    """Round half to even in binary floating point, the way numpy does."""
    scale = float(10**digits)
    return F.rint(_col(c) * scale) / scale


def split_coordinates(df: DataFrame, coord_column: str = "coords") -> DataFrame:
    """Add longitude and latitude from 'lon,lat'; both are NULL unless exactly two numbers are given."""
    parts = F.split(F.col(coord_column), ",")
    lon, lat = to_number(F.get(parts, F.lit(0))), to_number(F.get(parts, F.lit(1)))
    good = (F.size(parts) == 2) & lon.isNotNull() & lat.isNotNull()
    return df.withColumns({"longitude": F.when(good, lon), "latitude": F.when(good, lat)})


def grid_floor(c: Column | str, delta: float = 0.1) -> Column:
    """Lower edge of the grid cell, five decimals."""
    x, d = _col(c), F.lit(float(delta))
    return round_even(F.rint((x - F.pmod(x, d)) / d) * d, 5)


def grid_nearest(c: Column | str, delta: float = 0.1) -> Column:
    """Nearest grid line, one decimal."""
    d = F.lit(float(delta))
    return round_even(F.rint(_col(c) / d) * d, 1)


def grid_key(c: Column | str, delta: float = 0.1) -> Column:
    """grid_nearest in whole tenths, so that no floating point number is a join key."""
    return F.rint(grid_nearest(c, delta) * 10).cast("int")


def planar_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Straight-line distance with 111 km per degree on both axes."""
    dy, dx = lat1 - lat2, lon1 - lon2
    return F.sqrt(dy * dy + dx * dx) * KM_PER_DEGREE


def calculate_distances(df: DataFrame, weather_lat: float = 13.74, weather_lon: float = 100.50) -> DataFrame:
    """Add distance_to_weather_station_km."""
    km = planar_km(F.col("latitude"), F.col("longitude"), F.lit(weather_lat), F.lit(weather_lon))
    return df.withColumn("distance_to_weather_station_km", km)


def parse_time(c: Column | str, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Mixed-format text to TIMESTAMP; NULL where nothing fits. Text without a zone is session time (UTC)."""
    text = strip(_col(c).cast("string"))
    return F.coalesce(text.try_cast("timestamp"), *[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def parse_date(c: Column | str) -> Column:
    """Strict yyyy-MM-dd to DATE, NULL otherwise."""
    text = _col(c).cast("string")
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def hour_floor(c: Column | str) -> Column:
    return F.date_trunc("hour", _col(c))


def time_parts(ts: Column | str) -> dict[str, Column]:
    """hour, day_of_week (Monday = 0) and month."""
    t = _col(ts)
    return {"hour": F.hour(t), "day_of_week": F.weekday(t), "month": F.month(t)}


def name_parts(ts: Column | str) -> dict[str, Column]:
    """English day and month names."""
    t = _col(ts)
    return {"day_name": F.date_format(t, "EEEE"), "month_name": F.date_format(t, "MMMM")}


def cyclical(hour: Column, day_of_week: Column, month: Column) -> dict[str, Column]:
    """Sine and cosine of the position within the day, week and year."""
    out = {}
    for name, value, period in (("hour", hour, 24), ("day", day_of_week, 7), ("month", month, 12)):
        angle = value * (2 * math.pi) / period
        out[f"{name}_sin"], out[f"{name}_cos"] = F.sin(angle), F.cos(angle)
    return out


def cut_fixed(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed ranges; the first one also contains its lower edge; NULL outside."""
    x = _col(c)
    chain = F.when((x >= edges[0]) & (x <= edges[1]), labels[0])
    for low, high, label in zip(edges[1:], edges[2:], labels[1:]):
        chain = chain.when((x > low) & (x <= high), label)
    return chain


def equal_bin(c: Column | str, low: Column, high: Column, bins: int) -> Column:
    """Number (1..bins) of the right-closed equal-width range; one constant value lands in the middle."""
    x, step = _col(c), (high - low) / bins
    above = [(x > low + step * i).cast("int") for i in range(1, bins)]
    number = reduce(lambda a, b: a + b, above, F.lit(1))
    return F.when(x.isNotNull(), F.when(low == high, F.lit(math.ceil(bins / 2))).otherwise(number))


def equal_bin_mid(number: Column, low: Column, high: Column, bins: int) -> Column:
    """Middle of a range of equal_bin; the first range starts 0.1% of the span below the minimum."""
    pad = F.when(low == 0, F.lit(0.001)).otherwise(F.abs(low) * 0.001)
    flat = low == high
    start, end = F.when(flat, low - pad).otherwise(low), F.when(flat, high + pad).otherwise(high)
    step = (end - start) / bins
    left = start + step * (number - 1) - F.when(~flat & (number == 1), (end - start) * 0.001).otherwise(F.lit(0.0))
    return (left + start + step * number) / 2


def feature_category(name: Column | str) -> Column:
    """Group of a feature by the first rule whose substring occurs in its name."""
    text = F.lower(_col(name))
    chain = None
    for category, parts in FEATURE_CATEGORIES:
        hit = reduce(lambda a, b: a | b, [text.contains(p) for p in parts])
        chain = F.when(hit, category) if chain is None else chain.when(hit, category)
    return chain.otherwise(OTHER_CATEGORY)


def is_cyclical_name(name: Column | str) -> Column:
    return _col(name).rlike("_sin|_cos")


def is_district_name(name: Column | str) -> Column:
    return _col(name).contains("district_")


def drop_prefix(name: Column | str, prefix: str = "type_") -> Column:
    return F.regexp_replace(_col(name), f"^{prefix}", "")


def share(part: Column, whole: Column) -> Column:
    """part / whole, NULL for an empty whole."""
    return F.when(whole != 0, part / whole)


def percent_change(new: Column, old: Column) -> Column:
    return share((new - old) * 100.0, old)
