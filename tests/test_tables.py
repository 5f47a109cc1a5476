"""Cleaning, labels, joins, duplicates and dashboard aggregates on small tables with edge rows."""

from collections import Counter
from datetime import date, datetime

from pyspark.sql import functions as F

from wardlight.operators import aggregates as A
from wardlight.operators import clean as C
from wardlight.operators import dedupe as D
from wardlight.operators import enrich as E
from wardlight.operators import labels as L
from wardlight.operators import skew as W


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_null_tokens_spaces_and_incomplete_rows(spark):
    df = spark.createDataFrame([("NA", " ", 1.0), ("ok", "NULL", 2.0), ("ok", "x", float("nan")), ("ok", "x", 3.0)], "a string, b string, c double")
    clean = C.spaces_to_null(C.null_tokens_to_null(df))
    assert rows(C.drop_incomplete(clean)) == [("ok", "x", 3.0)]
    assert C.drop_incomplete(clean, ["a"]).count() == 3


def test_clean_reports_defaults(spark):
    df = spark.createDataFrame(
        [(None, "{a}", C.PROVINCE), ("1", "{a}", "elsewhere"), ("2", None, C.PROVINCE)], "ticket_id string, type string, province string"
    )
    assert rows(C.clean_reports(df)) == [("{a}", C.PROVINCE)]
    assert C.clean_reports(df, province=None).count() == 2


def test_space_counts(spark):
    df = spark.createDataFrame([(" ", "a", 1), ("b", " ", 2), (" ", " ", 3), (None, "c", 4)], "x string, y string, n int")
    assert dict(rows(C.space_counts(df))) == {"*": 3, "n": 0, "x": 2, "y": 2}
    assert C.rows_with_space(df).count() == 3


def test_column_names_with_units(spark):
    df = spark.createDataFrame([("1.5", "x")], ["temperature_2m (°C)", " rain (mm)"])
    out = C.coerce_numeric(C.strip_names(df), ["temperature_2m (°C)", "rain (mm)", "absent"])
    assert rows(out) == [(1.5, None)]
    assert C.first_existing(out, "missing", "rain (mm)") == "rain (mm)"


def test_date_filters(spark):
    days = [date(2022, 1, 1), date(2022, 12, 31), date(2023, 6, 1), date(2023, 12, 31)]
    df = spark.createDataFrame([(d, datetime(d.year, d.month, d.day, 23, 59)) for d in days], "d date, t timestamp_ntz")
    assert C.in_year(df, "d", 2022).count() == C.in_year(df, "t", 2022).count() == 2
    assert C.between_dates(df, "t", date(2022, 12, 31), date(2023, 6, 1)).count() == 2
    assert [r["d"] for r in C.trailing_days(df, "d").orderBy("d").collect()] == days[1:]


def test_label_parsing(spark):
    texts = ["{a}", "{a, b}", "{}", "{ }", "{a,,b,}", None, "{ a ,b }", "{น้ำท่วม,ถนน}", "a"]
    df = spark.createDataFrame([(t,) for t in texts], "type string")
    want = [["a"], ["a", "b"], [], [], ["a", "", "b", ""], [], ["a", "b"], ["น้ำท่วม", "ถนน"], ["a"]]
    parsed = L.parse_type_column(df)
    assert [r["type"] for r in parsed.collect()] == want
    assert L.parse_type_column(parsed) is parsed
    kept = [w for w in want if w]
    assert [r["type"] for r in L.filter_empty_types(parsed).collect()] == kept
    assert [r["type"] for r in L.parse_type_column(L.filter_empty_types(df)).collect()] == kept
    marked = df.select(L.label_list_marked(F.col("type")).alias("t"))
    assert [r["t"] for r in marked.collect()][2:4] == [[], [""]]
    loose = spark.createDataFrame([("{a},{b}",)], "type string").select(L.label_list_without_braces(F.col("type")).alias("t"))
    assert loose.first()["t"] == ["a", "b"]


def test_targets_districts_and_counts(spark):
    df = spark.createDataFrame([(["a", "b", "a"], "x"), (["b"], None), ([], "y")], "type array<string>, district string")
    hot, names = L.create_binary_targets(df)
    assert names == ["type_a", "type_b"]
    assert [(r["type_a"], r["type_b"]) for r in hot.collect()] == [(1, 1), (0, 1), (0, 0)]
    coded = L.encode_districts(df)
    assert [(r["district_x"], r["district_y"]) for r in coded.collect()] == [(1, 0), (0, 0), (0, 1)]
    assert L.encode_districts(df, "absent") is df
    assert [tuple(r)[:2] for r in L.label_counts(df).collect()] == [("b", 2), ("a", 1)]
    assert L.trainable_types(df, min_samples=2) == ["b"]


def test_vocabulary_refuses_too_many_columns(spark):
    import pytest

    with pytest.raises(ValueError):
        L.vocabulary(spark.range(20).select(F.col("id").cast("string").alias("v")), "v", 10)


def test_strategy_boundaries(spark):
    df = spark.createDataFrame([(0.0499,), (0.05,), (0.1499,), (0.15,)], "r double")
    got = [r[0] for r in df.select(L.resampling_strategy(F.col("r"))).collect()]
    assert got == ["smote_under", "undersampling", "undersampling", "class_weight"]


def test_daily_mean_skips_nan_and_null(spark):
    t = datetime(2024, 1, 1, 5)
    df = spark.createDataFrame([(t, 1.0, 2), (t, float("nan"), 4), (t, None, None), (None, 9.0, 9)], "time timestamp_ntz, a double, b int")
    assert rows(E.daily_mean(df)) == [(date(2024, 1, 1), 1.0, 3.0)]


def test_hour_joins(spark):
    a, b, c = (datetime(2024, 1, 1, h) for h in (1, 2, 3))
    left = spark.createDataFrame([(1, a), (2, a), (3, b), (4, None)], "id int, hour_ts timestamp_ntz")
    right = spark.createDataFrame([(a, 10), (c, 30), (None, 99)], "hour_ts timestamp_ntz, v int")
    for how in ("inner", "left", "full"):
        for limit in (0, 1000):
            got = E.hour_join(left, right, how, max_rows=limit).select("id", "hour_ts", "v")
            assert rows(got) == rows(left.join(right, "hour_ts", how).select("id", "hour_ts", "v")), (how, limit)


def test_grid_hour_join_suffix(spark):
    t = datetime(2024, 1, 1, 7, 40)
    reports = spark.createDataFrame([("100.52,13.74", "2024-01-01 07:40:00"), ("101.0,13.0", "2024-01-01 07:40:00")], "coords string, timestamp string")
    weather = spark.createDataFrame([(t.replace(minute=0), 13.71, 100.49, 30.0)], "time timestamp, latitude double, longitude double, temp double")
    got = E.transform(reports, weather)
    assert {"latitude_weather", "longitude_weather"} <= set(got.columns)
    assert [r["temp"] for r in got.orderBy("longitude").collect()] == [30.0, None]
    quality = E.join_quality(got, "temp", "distance_to_weather_station_km").first()
    assert (quality["n_rows"], quality["match_rate"], quality["n_missing"]) == (2, 50.0, 1)


def test_salted_join_spreads_hot_keys(spark):
    left = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    right = spark.range(0, 5000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    hot = W.hot_keys(left, ["k"], min_rows=100)
    assert len(hot) == 1
    for how in ("inner", "left"):
        salted = W.salted_join(left, right, ["k"], how, min_rows=100, salts=8)
        assert rows(salted.select("id", "k", "v")) == rows(left.join(right, "k", how).select("id", "k", "v"))
    spread = left.filter("k = 7").select(F.pmod(F.xxhash64("id", "k"), F.lit(8)).alias("s")).distinct().count()
    assert spread == 8


def test_lookup_join_beyond_the_bound_does_not_broadcast(spark):
    left, right = spark.range(100).withColumnRenamed("id", "k"), spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in W.lookup_join(left, right, ["k"], max_rows=10)._jdf.queryExecution().toString()
        assert "Broadcast" in W.lookup_join(left, right, ["k"], max_rows=100)._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 9.0), (2, "c", None), (2, "c", 1.0)], "k int, o string, v double")
    assert rows(D.first_per_key(df, ["k"], ["o"])) == [(1, "a", 9.0), (2, "c", None)]


def test_day_tables_keep_all_days(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 3),), (datetime(2024, 1, 1, 3),), (datetime(2024, 1, 7, 0),)], "t timestamp_ntz")
    got = A.counts_by_day_of_week(df, "t").collect()
    assert [r["day_name"] for r in got][:2] == ["Monday", "Tuesday"]
    assert [r["n"] for r in got] == [2, None, None, None, None, None, 1]
    table = A.day_hour_table(df, "t").collect()
    assert table[0]["h03"] == 2 and table[0]["h00"] == 0 and table[1]["h00"] is None and table[6]["h00"] == 1


def test_modes_and_top(spark):
    df = spark.createDataFrame([(x,) for x in "aabbc"] + [(None,)], "v string")
    assert rows(A.modes(df, "v")) == [("a", 2), ("b", 2)]
    assert [tuple(r) for r in A.top_counts(df, "v", 2).collect()] == [("a", 2), ("b", 2)]
    assert tuple(A.count_range(df, "v").first()) == (1, 2)


def test_density_counts_every_row(spark):
    df = spark.range(1000).select((100 + F.col("id") % 7 / 100).alias("longitude"), (13 + F.col("id") % 3 / 100).alias("latitude"))
    got = A.density(df, 0.05).collect()
    assert sum(r["n"] for r in got) == 1000
    want = Counter(round(round((100 + i % 7 / 100) // 0.05 * 0.05, 5), 5) for i in range(1000))
    assert {x: sum(r["n"] for r in got if r["lon_bin"] == x) for x in want} == want


def test_equal_rows_of_a_hot_key_spread(spark):
    left = spark.range(8000).select(F.lit(1).alias("k"))
    right = spark.createDataFrame([(1, "a")], "k int, v string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = W.salted_join(left, right, ["k"], "left", min_rows=100, salts=16)
        sizes = joined.rdd.glom().map(len).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 8000 and max(sizes) < 4500


def test_nan_counts_as_unknown(spark):
    df = spark.createDataFrame([("a", float("nan")), ("b", 1.0), ("b", 3.0), (None, None)], "district string, x double")
    got = A.metrics(df, "district", ["x"], ["x"], ["x"]).first()
    assert (got["avg_x"], got["max_x"], got["sum_x_over_rows"]) == (2.0, 3.0, 4.0)
    assert sum(r["n"] for r in A.equal_width_counts(df, "x", 4).collect()) == 2
    assert sorted(r["x"] for r in C.fill_zero(df).collect()) == [0.0, 0.0, 1.0, 3.0]


def test_no_columns_to_look_at_keep_all_rows(spark):
    df = spark.createDataFrame([(None,), ("a",)], "x string")
    assert C.drop_missing_weather(df, []).count() == 2


def test_trainable_types_have_no_cap(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_COLUMNS", 2)
    df = spark.createDataFrame([(["a", "b", "c", "d"],)] * 3, "type array<string>")
    assert L.trainable_types(df, min_samples=3) == ["a", "b", "c", "d"]


def test_too_many_values_become_a_sparse_vector(spark, monkeypatch):
    import pytest
    from pyspark.ml.functions import vector_to_array

    from wardlight.operators import forest as R
    from wardlight.plans import batch

    rows = [("2024-01-01", f"d{i % 9}" if i else None, [f"t{i % 3}"], 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "timestamp string, district string, type array<string>, value double")
    made, places = L.sparse_values(df, "district", "v")
    want = {p: r for r, p in enumerate(places)}
    for r in made.withColumn("a", vector_to_array("v")).collect():
        assert [i for i, x in enumerate(r["a"]) if x] == ([want[r["district"]]] if r["district"] else [])
    with pytest.raises(L.TooManyValues):
        L.sparse_values(df, "district", "v", 8)
    few = L.vocabularies
    monkeypatch.setattr(L, "vocabularies", lambda df, columns, n=5: few(df, columns, n))
    ready = batch.prepare(df, id_column="value")
    assert list(ready.vectors) == ["district_vector"] and ready.type_columns == ["type_t0", "type_t1", "type_t2"]
    assert not [c for c in ready.table.columns if c.startswith("district_d")]
    matrix = R.assemble(ready.table, "value", ["value", "hour"], ["type"], ["district_vector"])
    assert matrix.first()["features"].size == 2 + len(places)
