from datetime import date

import pytest

from wardlight.sources import sinks, tables

HEAD = "time,temperature_2m (°C),rain (mm)\n"


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_reports_with_quotes_breaks_and_null_tokens(spark, tmp_path):
    path = write(tmp_path / "r.csv", 'ticket_id,comment,province\n1,"a ""b""\nc",NA\n2,,NULL\n3, ,x\n')
    got = [tuple(r) for r in tables.read_reports(spark, path).orderBy("ticket_id").collect()]
    assert got == [("1", 'a "b"\nc', None), ("2", None, None), ("3", " ", "x")]


@pytest.mark.parametrize("preamble", ["", "latitude,longitude,elevation\n13.74,100.5,7.0\n\n"])
def test_weather_with_and_without_preamble(spark, tmp_path, preamble):
    path = write(tmp_path / "w.csv", preamble + HEAD + "2024-01-01T00:00,25.5,NaN\n2024-01-01T01:00,,0.5\n")
    got = tables.read_weather(spark, path).orderBy("time").collect()
    assert [tuple(r)[1:] for r in got] == [(25.5, None), (None, 0.5)]
    assert str(got[1]["time"]) == "2024-01-01 01:00:00"


def test_weather_sites_from_file_names(spark, tmp_path):
    write(tmp_path / "open-meteo-13.74N100.50E7m.csv", HEAD + "2024-01-01T00:00,25.5,0\n2024-01-01T01:00,26,0\n")
    write(tmp_path / "open-meteo-13.74N100.50E9m.csv", HEAD + "2024-01-01T01:00,99,0\n2024-01-01T02:00,27,0\n")
    write(tmp_path / "open-meteo-13.80N100.60E9m.csv", HEAD + "2024-01-01T01:00,30,0\n")
    got = tables.read_weather_sites(spark, str(tmp_path)).orderBy("latitude", "time").collect()
    assert [(r["latitude"], r["longitude"], r["temperature_2m (°C)"]) for r in got] == [
        (13.74, 100.5, 25.5), (13.74, 100.5, 26.0), (13.74, 100.5, 27.0), (13.8, 100.6, 30.0),
    ]


def test_weather_files_with_different_headers_are_put_together_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", HEAD + "2024-01-01T00:00,1,1\n")
    write(tmp_path / "b.csv", "time,extra,rain (mm)\n2024-01-01T01:00,7,2\n")
    got = tables.read_weather(spark, str(tmp_path)).orderBy("time").collect()
    assert [r["extra"] for r in got] == [None, 7.0] and [r["rain (mm)"] for r in got][1] == 2.0
    with pytest.raises(ValueError):
        tables.read_weather(spark, write(tmp_path / "c.csv", "no header\n"))


def test_air_quality(spark, tmp_path):
    path = write(tmp_path / "air.csv", "date, pm25, pm10, so2, co\n2024/1/2, 45 , ,1,1\n2024-01-03,abc,7,1,1\n")
    got = tables.read_air_quality(spark, path)
    assert got.columns == ["date", "pm25", "pm10"]
    assert [tuple(r) for r in got.orderBy("pm10").collect()][1] == (date(2024, 1, 3), None, 7.0)
    assert tables.read_air_quality_if_present(spark, str(tmp_path / "none.csv")) is None


def test_sinks_write_both_formats_and_sizes(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], 'q"uote\nline'), (2, [], None)], "id int, type array<string>, text string")
    sizes = sinks.save_all(df, {"by_id": df.groupBy("id").count()}, str(tmp_path)).first()
    assert sizes["csv_mb"] > 0 and sizes["parquet_mb"] > 0
    back = tables.read_reports(spark, str(tmp_path / "merged.csv")).orderBy("id").collect()
    assert [(r["type"], r["text"]) for r in back] == [("{a, b}", 'q"uote\nline'), ("{}", None)]
    assert tables.read_merged(spark, str(tmp_path / "merged.parquet")).count() == 2
    assert spark.read.csv(str(tmp_path / "by_id_summary"), header=True).count() == 2
