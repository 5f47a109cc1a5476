from datetime import date

import pytest

from wardlight.operators import clean as C
from wardlight.operators import forest as R
from wardlight.plans import batch, dashboard

SPACE = {**R.SEARCH_SPACE, "n_estimators": (3, 4), "max_depth": (3, 4)}


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    lines = ["ticket_id,type,organization,comment,coords,district,province,timestamp"]
    for i in range(240):
        day = 1 + i % 20
        kinds = ["{a, b}", "{a}", "{}", "{b,c}"][i % 4]
        place = C.PROVINCE if i % 12 else "elsewhere"
        lines.append(f'T{i},"{kinds}",o,"say ""hi""\nline {i}","100.{50 + i % 5},13.7{i % 7}",d{i % 3},{place},2024-01-{day:02d} {i % 24:02d}:15:00+00')
    (folder / "reports.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    weather = ["latitude,longitude,elevation", "13.74,100.5,7", "", "time,temperature_2m (°C),rain (mm),wind_speed_10m (km/h)"]
    weather += [f"2024-01-{d:02d}T{h:02d}:00,{20 + d},{h / 10},5" for d in range(1, 20) for h in range(24)]
    (folder / "weather.csv").write_text("\n".join(weather) + "\n", encoding="utf-8")
    air = ["date, pm25, pm10, so2"] + [f"2024-01-{d:02d}, {d * 10},{'' if d % 2 else ' '},3" for d in range(1, 21)]
    (folder / "air.csv").write_text("\n".join(air) + "\n", encoding="utf-8")
    return folder


def test_batch_run_from_files_to_summary(spark, files, tmp_path):
    paths = [str(files / n) for n in ("reports.csv", "weather.csv", "air.csv")]
    out = batch.run(spark, *paths, str(tmp_path), n_iter=1, min_samples=40, space=SPACE)
    merged = spark.read.parquet(str(tmp_path / "processed/merged.parquet"))
    assert merged.count() == 220 and "so2" not in merged.columns
    final = out["final"]
    # Without a label: every fourth row; without weather: day 20.
    assert final.count() == merged.filter("type <> '{}' and date < date'2024-01-20'").count()
    assert {"type_a", "type_b", "type_c", "district_d0", "hour_sin", "pm25"} <= set(final.columns)
    assert out["quality"].first()["match_rate"] == 100.0
    assert [r["label"] for r in out["label_counts"].collect()][:1] == ["b"] or out["label_counts"].count() == 3
    assert {r["type"] for r in out["summary"].collect()} == {"a", "b", "c"}
    assert spark.read.csv(str(tmp_path / "models/training_summary"), header=True).count() == 3

    funnel = {r["stage"]: r["n_rows"] for r in out["funnel"].orderBy("step").collect()}
    assert list(funnel) == ["raw", "clean", "merged", "labelled", "with weather"]
    assert funnel == {"raw": 240, "clean": 220, "merged": 220, "labelled": merged.filter("type <> '{}'").count(), "with weather": final.count()}
    assert spark.read.csv(str(tmp_path / "processed/funnel_summary"), header=True).count() == 5

    again = batch.run(spark, *paths, str(tmp_path), skip_etl=True, skip_training=True, sample_size=50)
    assert [r["stage"] for r in again["funnel"].orderBy("step").collect()] == ["merged", "labelled", "with weather", "sampled"]
    assert again["final"].count() == 50 and "summary" not in again


def test_missing_air_file_is_tolerated(spark, files, tmp_path):
    paths = [str(files / "reports.csv"), str(files / "weather.csv"), str(files / "absent.csv")]
    out = batch.run(spark, *paths, str(tmp_path), skip_training=True, province=None)
    assert "pm25" not in out["final"].columns


def test_clean_file_reports_counts(spark, files, tmp_path):
    got = batch.clean_file(spark, str(files / "reports.csv"), str(tmp_path / "clean"))
    assert {r["stage"]: r["n_rows"] for r in got.collect()} == {"raw": 240, "clean": 220}


def test_dashboard_and_map(spark, files, tmp_path):
    paths = [str(files / n) for n in ("reports.csv", "weather.csv", "air.csv")]
    batch.run(spark, *paths, str(tmp_path), skip_training=True)
    merged = spark.read.parquet(str(tmp_path / "processed/merged.parquet"))
    tables = dashboard.dashboard(dashboard.dashboard_table(merged), date(2024, 1, 1), date(2024, 1, 10), "d1")
    metrics = tables["metrics"].first()
    assert metrics["n_rows"] == sum(r["n"] for r in tables["by_date"].collect()) > 0
    assert metrics["n_districts"] == 1 and tables["top_districts"].count() == 1
    assert sum(r["n"] for r in tables["bins_pm25"].collect()) == metrics["n_rows"]

    shown = dashboard.map_tables(dashboard.map_table(merged), "row_id", 2024, ["a", "c"])
    points = shown["points"].collect()
    assert len({(p["latitude"], p["longitude"], p["date"]) for p in points}) == len(points)
    assert {p["cluster"] for p in points} == set(range(len({(p["latitude"], p["longitude"]) for p in points})))
    assert [r["type"] for r in shown["types"].collect()] == ["a", "b", "c"]
    assert [r["year"] for r in shown["years"].collect()] == [2024]


def test_districts_beyond_a_driver_keep_their_names_in_a_table(spark, monkeypatch):
    monkeypatch.setattr(batch.labels, "vocabularies", _refuse_districts(batch.labels.vocabularies))
    monkeypatch.setattr(batch.labels, "sparse_values", _refuse)
    rows = [(i, "{a}", f"d{i % 7}" if i % 5 else None, "2024-01-01 10:00:00", 1.0, 1.0, 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id bigint, type string, district string, timestamp string, `temperature_2m (°C)` double, `rain (mm)` double, `wind_speed_10m (km/h)` double")
    made = batch.prepare(df)
    names = {r["place"]: r["value"] for r in made.vectors["district_vector"].collect()}
    assert sorted(names) == list(range(7)) and not [c for c in made.table.columns if c.startswith("district_d")]
    for r in made.table.collect():
        assert [names[i] for i in r["district_vector"].indices] == ([r["district"]] if r["district"] else []) and r["district_vector"].size == 7


def _refuse(df, column, *rest):
    raise batch.labels.TooManyValues(column, 1)


def _refuse_districts(find):
    def found(df, columns, *rest):
        return _refuse(df, "district") if "district" in columns else find(df, columns, *rest)

    return found
