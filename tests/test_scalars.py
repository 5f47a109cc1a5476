import math
from datetime import date, datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardlight.functions import scalars as S
from wardlight.operators import aggregates as A


def values(df, *columns):
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()]


def test_split_coordinates_needs_exactly_two_numbers(spark):
    df = spark.createDataFrame([("100.5,13.7",), ("100.5",), ("100.5,13.7,1",), ("x,13.7",), (None,), (" 1 , 2 ",)], "coords string")
    got = values(S.split_coordinates(df), "longitude", "latitude")
    assert got == [(100.5, 13.7), (None, None), (None, None), (None, None), (None, None), (1.0, 2.0)]


def test_to_number_matches_a_coercing_parser(spark):
    texts = [" 45 ", " ", "NaN", "abc", "1e2", "1d", "2F", "0x10", "-3.5", None, ""]
    df = spark.createDataFrame([(x,) for x in texts], "a string")
    assert values(df.select(S.to_number("a").alias("n")), "n") == [45.0, None, None, None, 100.0, None, None, None, -3.5, None, None]


def test_strip_takes_all_white_space(spark):
    df = spark.createDataFrame([("  a b\t\n",), (" x　",), ("",)], "a string")
    assert values(df.select(S.strip("a").alias("s")), "s") == ["a b", "x", ""]


def test_parse_time_formats(spark):
    texts = ["2022-01-01 10:11:12.5+00", "2022-01-01 10:11:12+07:00", "2022-01-01", "01/02/2022", "x", None]
    df = spark.createDataFrame([(x,) for x in texts], "a string")
    got = values(df.select(F.date_format(S.parse_time("a"), "yyyy-MM-dd HH:mm:ss").alias("t")), "t")
    assert got == ["2022-01-01 10:11:12", "2022-01-01 03:11:12", "2022-01-01 00:00:00", "2022-01-02 00:00:00", None, None]


def test_parse_time_takes_other_orders_and_names(spark):
    texts = ["13/02/2022", "01/02/2022 3:04 PM", "Jan 2 2022", "January 2, 2022 05:06", "2 Jan 2022", "2022/1/2", "31/12/2021 23:59:58", "99/99/2022"]
    df = spark.createDataFrame([(x,) for x in texts], "a string")
    got = values(df.select(F.date_format(S.parse_time("a"), "yyyy-MM-dd HH:mm:ss").alias("t")), "t")
    assert got == [
        "2022-02-13 00:00:00", "2022-01-02 15:04:00", "2022-01-02 00:00:00", "2022-01-02 05:06:00",
        "2022-01-02 00:00:00", "2022-01-02 00:00:00", "2021-12-31 23:59:58", None,
    ]


def test_parse_date_is_strict(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("2024-1-1",), ("2024-01-01 10:00",)], "a string")
    assert values(df.select(S.parse_date("a").alias("d")), "d") == [date(2024, 2, 29), None, None, None]


def test_grids_match_numpy(spark):
    rng = np.random.default_rng(5)
    xs = np.concatenate([np.round(rng.uniform(-180, 180, 3000), 4), np.arange(130, 145) / 10, np.arange(-20, 20) / 20])
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = df.select("x", S.grid_floor("x").alias("f"), S.grid_nearest("x").alias("n"), S.round_even("x", 4).alias("r")).toPandas()
    x = got["x"]
    assert (got["f"] == ((x // 0.1) * 0.1).round(5)).all()
    assert (got["n"] == ((x / 0.1).round() * 0.1).round(1)).all()
    assert (got["r"] == x.round(4)).all()


def test_distance_is_planar(spark):
    df = spark.createDataFrame([(13.75, 100.60)], "latitude double, longitude double")
    got = values(S.calculate_distances(df), "distance_to_weather_station_km")[0]
    assert got == pytest.approx(math.hypot(0.01, 0.10) * 111)


def test_time_parts_and_cycle(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 7, 18, 30),)], "t timestamp_ntz")
    row = df.select(*[e.alias(n) for n, e in {**S.time_parts("t"), **S.name_parts("t")}.items()]).first()
    assert tuple(row) == (18, 6, 1, "Sunday", "January")
    turn = df.select(*[e.alias(n) for n, e in S.cyclical(F.lit(18), F.lit(6), F.lit(1)).items()]).first()
    assert turn["hour_sin"] == pytest.approx(-1) and turn["hour_cos"] == pytest.approx(0)
    assert turn["month_cos"] == pytest.approx(math.cos(2 * math.pi / 12))


def test_fixed_ranges_match_cut(spark):
    xs = [-1.0, 0.0, 5.0, 12.0, 12.5, 35.0, 55.0, 150.0, 250.0, 500.0, 501.0, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = values(df.select(S.cut_fixed("x", S.PM25_EDGES, S.PM25_LABELS).alias("r")), "r")
    want = pd.cut(pd.Series(xs, dtype=float), list(S.PM25_EDGES), labels=list(S.PM25_LABELS), include_lowest=True)
    assert got == [None if pd.isna(w) else w for w in want]


@pytest.mark.parametrize("bins", [5, 20])
def test_equal_width_counts_match_cut(spark, bins):
    xs = np.round(np.random.default_rng(bins).uniform(-3, 90, 800), 2)
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = A.equal_width_counts(df, "x", bins).orderBy("bin").toPandas()
    want = pd.cut(pd.Series(xs), bins=bins).value_counts(sort=False)
    assert got["n"].tolist() == want.tolist()
    assert np.allclose(got["mid"], [i.mid for i in want.index], atol=0.01)


@pytest.mark.parametrize("value", [0.0, 7.5])
def test_equal_width_counts_of_one_value(spark, value):
    df = spark.createDataFrame([(value,)] * 3, "x double")
    got = A.equal_width_counts(df, "x", 20).orderBy("bin").toPandas()
    assert got["n"].tolist() == pd.cut(pd.Series([value] * 3), bins=20).value_counts(sort=False).tolist()


def test_equal_width_counts_of_nothing(spark):
    got = A.equal_width_counts(spark.createDataFrame([], "x double"), "x", 4).toPandas()
    assert got["n"].tolist() == [0, 0, 0, 0]


def test_feature_categories(spark):
    names = ["hour_sin", "pm25", "temperature_2m (°C)", "longitude", "dew_point_2m", "district_x", "rain (mm)"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = values(df.select(S.feature_category("f").alias("c")), "c")
    assert got == ["Temporal", "Air Quality", "Weather", "Location", "Other", "Location", "Weather"]
