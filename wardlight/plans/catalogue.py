"""Queries over the test tables: each operator on a stand-in table, next to SQL that gives the same result.

The tables hold no weather, so orders and events stand in for reports and series; coordinates are
derived from keys on a lattice of 1e-4 degrees.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import clean as C
from ..operators import clusters as K
from ..operators import dedupe as D
from ..operators import enrich as E
from ..operators import forest as R
from ..operators import labels as L
from ..operators import metrics as M
from ..operators import neighbours as N
from ..operators import resampling as B
from ..operators import sampling as P
from ..operators import trees as G
from ..session import work_folder, write_stage
from ..sources import sinks, tables
from . import batch
from . import dashboard as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    def add(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[run.__name__] = lambda spark, folder: run(Tables(spark, folder))
        if sql is not None:
            ORACLE[run.__name__] = sql
        return run

    return add


def big(c: Column) -> Column:
    return c.cast("bigint")


# --- stand-ins -------------------------------------------------------------------------------------

EVENT_SITES = """(SELECT *, (1004000 + (user_id * 7919) % 6000) / 10000.0::DOUBLE AS longitude,
  (135000 + (user_id * 104729) % 5000) / 10000.0::DOUBLE AS latitude FROM events)"""
ORDER_SITES = """(SELECT *, (1004000 + round(o_totalprice * 100)::BIGINT % 1500) / 10000.0::DOUBLE AS longitude,
  (136000 + (o_orderkey * 7919) % 1200) / 10000.0::DOUBLE AS latitude FROM orders)"""
ORDER_LABELS = """(SELECT *, CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN '{}'
  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '{' || o_orderstatus || '}'
  ELSE '{' || o_orderpriority || ', ' || o_orderstatus || '}' END AS type,
  CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN []
  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN [o_orderstatus]
  ELSE [o_orderpriority, o_orderstatus] END AS labels FROM orders)"""


def event_sites(t: Tables) -> DataFrame:
    return t.events.withColumns(
        {
            "longitude": (F.lit(1004000) + F.col("user_id") * 7919 % 6000) / 10000.0,
            "latitude": (F.lit(135000) + F.col("user_id") * 104729 % 5000) / 10000.0,
        }
    )


def order_sites(t: Tables) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return t.orders.withColumns(
        {
            "longitude": (F.lit(1004000) + cents % 1500) / 10000.0,
            "latitude": (F.lit(136000) + F.col("o_orderkey") * 7919 % 1200) / 10000.0,
        }
    )


def order_labels(t: Tables) -> DataFrame:
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    text = (
        F.when((p == "5-LOW") & (s == "P"), "{}")
        .when(p == "4-NOT SPECIFIED", F.concat(F.lit("{"), s, F.lit("}")))
        .otherwise(F.concat(F.lit("{"), p, F.lit(", "), s, F.lit("}")))
    )
    return t.orders.withColumn("type", text)


def messy_customers(t: Tables) -> DataFrame:
    """Customers as a CSV reader would deliver them: all text, with ' ' and NA cells."""
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.col("c_name").alias(" c_name "),
        F.when(F.col("c_nationkey") < 3, "NA").otherwise(F.col("c_nationkey").cast("string")).alias("district"),
        F.when(segment == "MACHINERY", " ").otherwise(segment).alias("province"),
        F.when(balance < 0, "NaN").when(balance > 9000, " ").otherwise(balance.cast("int").cast("string")).alias("pm25"),
        F.lit("x").alias("photo"),
    )


# --- joins and daily means -----------------------------------------------------------------------

@query("SELECT ts::DATE AS date, round(avg(value), 6) AS value FROM events GROUP BY 1")
def daily_mean(t):
    return E.daily_mean(t.events, "ts", ["value"]).select("date", F.round("value", 6).alias("value"))


DAILY_SQL = """WITH w AS (SELECT o_orderdate::DATE AS date, avg(o_totalprice) AS price FROM orders GROUP BY 1),
a AS (SELECT o_orderdate::DATE AS date, avg(o_totalprice) AS price_f FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
m AS (SELECT l.l_shipdate::DATE AS date, price, price_f FROM lineitem l
  LEFT JOIN w ON w.date = l.l_shipdate::DATE LEFT JOIN a ON a.date = l.l_shipdate::DATE) """


def daily_merged(t: Tables) -> DataFrame:
    weather = E.daily_mean(t.orders, "o_orderdate", ["o_totalprice"]).withColumnRenamed("o_totalprice", "price")
    air = E.daily_mean(t.orders.filter("o_orderstatus = 'F'"), "o_orderdate", ["o_totalprice"])
    reports = E.add_date(t.lineitem.select("l_shipdate"), "l_shipdate")
    return E.enrich_daily(reports, weather, air.withColumnRenamed("o_totalprice", "price_f"))


@query(DAILY_SQL + """SELECT date, count(*) AS n_rows, count(price) AS n_weather, count(price_f) AS n_air,
round(max(price), 6) AS price, round(max(price_f), 6) AS price_f FROM m GROUP BY date""")
def enrich_daily(t):
    return daily_merged(t).groupBy("date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("price").alias("n_weather"), F.count("price_f").alias("n_air"),
        F.round(F.max("price"), 6).alias("price"), F.round(F.max("price_f"), 6).alias("price_f"),
    )


@query(DAILY_SQL + """SELECT count(*) AS n_rows, round(count(price_f) * 100.0 / count(*), 6) AS match_rate,
count(*) - count(price_f) AS n_missing, round((count(*) - count(price_f)) * 100.0 / count(*), 6) AS missing_percent FROM m""")
def join_quality(t):
    q = E.join_quality(daily_merged(t), "price_f")
    return q.select("n_rows", F.round("match_rate", 6).alias("match_rate"), "n_missing", F.round("missing_percent", 6).alias("missing_percent"))


CELL_HOUR_SQL = f"""WITH e AS (SELECT event_id, event_type, value, date_trunc('hour', ts) AS h,
  round_even(round_even(latitude / 0.1::DOUBLE, 0) * 0.1::DOUBLE * 10, 0)::INT AS la,
  round_even(round_even(longitude / 0.1::DOUBLE, 0) * 0.1::DOUBLE * 10, 0)::INT AS lo FROM {EVENT_SITES}),
w AS (SELECT la, lo, h, avg(value) AS temperature FROM e WHERE event_type IN ('view', 'error') GROUP BY ALL) """


@query(CELL_HOUR_SQL + """SELECT e.event_id, e.la / 10.0::DOUBLE AS grid_lat, e.lo / 10.0::DOUBLE AS grid_lon,
round(w.temperature, 6) AS temperature FROM e LEFT JOIN w USING (la, lo, h) WHERE e.event_type NOT IN ('view', 'error')""")
def grid_hour_join(t):
    cells = E.with_hour(E.assign_grid_cells(event_sites(t)), "ts")
    series = F.col("event_type").isin("view", "error")
    weather = cells.filter(series).groupBy("lat_key", "lon_key", F.col("hour_ts").alias("time")).agg(F.avg("value").alias("temperature"))
    joined = E.grid_hour_join(cells.filter(~series), weather)
    return joined.select("event_id", "grid_lat", "grid_lon", F.round("temperature", 6).alias("temperature"))


HOUR_SQL = """WITH l AS (SELECT event_id, date_trunc('hour', ts) AS h FROM events WHERE event_type = 'click'),
r AS (SELECT date_trunc('hour', ts) AS h, avg(value) AS level FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT coalesce(event_id, -1) AS event_id, strftime(h, '%Y-%m-%d %H') AS hour_text, round(level, 6) AS level FROM l """


def hourly(t: Tables, how: str) -> DataFrame:
    left = E.with_hour(t.events.filter("event_type = 'click'"), "ts").select("event_id", "hour_ts")
    series = E.with_hour(t.events.filter("event_type = 'purchase'"), "ts").groupBy("hour_ts").agg(F.avg("value").alias("level"))
    joined = E.hour_join(left, series, how)
    return joined.select(F.coalesce("event_id", F.lit(-1)).alias("event_id"), F.date_format("hour_ts", "yyyy-MM-dd HH").alias("hour_text"), F.round("level", 6).alias("level"))


@query(HOUR_SQL + "FULL JOIN r USING (h)")
def outer_hour_join(t):
    return hourly(t, "full")


@query(HOUR_SQL + "LEFT JOIN r USING (h)")
def left_hour_join(t):
    return hourly(t, "left")


@query(HOUR_SQL + "JOIN r USING (h)")
def inner_hour_join(t):
    return hourly(t, "inner")


# --- cleaning ----------------------------------------------------------------------------------------

MESSY_SQL = """WITH m AS (SELECT c_custkey::VARCHAR AS c_custkey, c_name,
  CASE WHEN c_nationkey >= 3 THEN c_nationkey::VARCHAR END AS district,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN ' ' ELSE c_mktsegment END AS province,
  CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal > 9000 THEN ' ' ELSE trunc(c_acctbal)::INT::VARCHAR END AS pm25
  FROM customer) """


def tidy_customers(t: Tables) -> DataFrame:
    return C.null_tokens_to_null(C.strip_names(messy_customers(t)))


@query(MESSY_SQL + """SELECT c_custkey, c_name, district, province, pm25::DOUBLE AS pm25 FROM m
WHERE district IS NOT NULL AND province = 'BUILDING' AND pm25 IS NOT NULL AND pm25 <> ' '""")
def clean_filter(t):
    kept = C.clean_reports(C.spaces_to_null(tidy_customers(t)), province="BUILDING")
    return C.coerce_numeric(kept, ["pm25", "pm10"])


@query(MESSY_SQL + """, u AS (SELECT * FROM m)
SELECT 'c_custkey' AS column_name, 0::BIGINT AS n_space UNION ALL SELECT 'c_name', 0::BIGINT
UNION ALL SELECT 'district', count(*) FILTER (district = ' ') FROM u
UNION ALL SELECT 'province', count(*) FILTER (province = ' ') FROM u
UNION ALL SELECT 'pm25', count(*) FILTER (pm25 = ' ') FROM u UNION ALL SELECT 'photo', 0::BIGINT
UNION ALL SELECT '*', count(*) FILTER (coalesce(district = ' ', false) OR coalesce(province = ' ', false) OR coalesce(pm25 = ' ', false)) FROM u""")
def quality_scan(t):
    return C.space_counts(tidy_customers(t))


@query(MESSY_SQL + "SELECT c_custkey, province, pm25 FROM m WHERE province = ' ' OR pm25 = ' '")
def rows_with_space(t):
    return C.rows_with_space(tidy_customers(t)).select("c_custkey", "province", "pm25")


@query(MESSY_SQL + """SELECT 'c_custkey' AS column_name, 'string' AS data_type, count(c_custkey) AS n_non_null FROM m
UNION ALL SELECT 'c_name', 'string', count(c_name) FROM m UNION ALL SELECT 'district', 'string', count(district) FROM m
UNION ALL SELECT 'province', 'string', count(province) FROM m UNION ALL SELECT 'pm25', 'string', count(pm25) FROM m
UNION ALL SELECT 'photo', 'string', count(*) FROM m""")
def column_profile(t):
    return C.non_null_counts(tidy_customers(t))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1996-02-03' AND DATE '1997-04-05' AND o_orderstatus = 'F'")
def date_range_filter(t):
    kept = C.between_dates(t.orders, "o_orderdate", date(1996, 2, 3), date(1997, 4, 5))
    return C.equals_unless_all(C.equals_unless_all(kept, "o_orderstatus", "F"), "o_orderpriority", "All").select("o_orderkey")


@query(f"SELECT o_orderkey FROM {ORDER_LABELS} WHERE year(o_orderdate) = 1998 AND list_has_any(labels, ['1-URGENT', 'P'])")
def year_anyof(t):
    kept = C.in_year(order_labels(t), "o_orderdate", 1998)
    return C.any_label(L.parse_type_column(kept), ["1-URGENT", "P"], "type").select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE >= (SELECT max(o_orderdate::DATE) FROM orders) - 365")
def trailing_365(t):
    return C.trailing_days(t.orders, "o_orderdate").select("o_orderkey")


@query("""SELECT o_custkey, o_orderstatus, min(o_orderkey) AS o_orderkey, arg_min(o_totalprice, o_orderkey) AS o_totalprice
FROM orders GROUP BY ALL""")
def dedupe_first(t):
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")
    return D.first_per_key(rows, ["o_custkey", "o_orderstatus"], ["o_orderkey"])


@query("SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(t):
    return D.distinct_sorted(t.orders, "o_orderpriority")


@query("""SELECT kind, year(day) AS year, count(*) AS n, count(amount) AS n_amount FROM (
SELECT 'order' AS kind, o_orderdate AS day, o_totalprice AS amount FROM orders
UNION ALL SELECT 'ship', l_shipdate, NULL FROM lineitem) GROUP BY ALL""")
def concat_sources(t):
    orders = t.orders.select(F.lit("order").alias("kind"), F.col("o_orderdate").alias("day"), F.col("o_totalprice").alias("amount"))
    ships = t.lineitem.select(F.lit("ship").alias("kind"), F.col("l_shipdate").alias("day"))
    both = orders.unionByName(ships, allowMissingColumns=True)
    return both.groupBy("kind", big(F.year("day")).alias("year")).agg(F.count(F.lit(1)).alias("n"), F.count("amount").alias("n_amount"))


@query(f"""SELECT 0 AS step, 'raw' AS stage, count(*) AS n_rows FROM {ORDER_LABELS}
UNION ALL SELECT 1, 'labelled', count(*) FROM {ORDER_LABELS} WHERE len(labels) > 0
UNION ALL SELECT 2, 'in year', count(*) FROM {ORDER_LABELS} WHERE len(labels) > 0 AND year(o_orderdate) = 1998""")
def stage_funnel(t):
    steps = {"raw": F.lit(True), "labelled": L.has_labels(F.col("type")), "in year": F.year("o_orderdate") == 1998}
    return A.filter_funnel(order_labels(t), steps)


@query(f"""WITH e AS (SELECT DISTINCT o_orderkey, o_custkey % 25 AS district, unnest(labels) AS label FROM {ORDER_LABELS}),
c AS (SELECT district, label, count(*) AS n FROM e GROUP BY ALL)
SELECT district, label, n, row_number() OVER (PARTITION BY district ORDER BY n DESC, label)::INT AS rank FROM c QUALIFY rank <= 3""")
def top_types_by_district(t):
    table = L.parse_type_column(order_labels(t)).withColumn("district", F.col("o_custkey") % 25)
    return L.top_labels_by(table, "district", "type", 3)


@query("""WITH c AS (SELECT DISTINCT o_custkey::VARCHAR AS v FROM orders), p AS (SELECT v, row_number() OVER (ORDER BY ('0x' || substr(md5(v), 1, 15))::BIGINT, v) - 1 AS place FROM c)
SELECT o_orderkey, place::VARCHAR AS places, 1::BIGINT AS n_set, (SELECT count(*) FROM c) AS size FROM orders JOIN p ON v = o_custkey::VARCHAR""")
def encoded_by_table(t):
    """A column with as many values as there are customers with orders, as sparse vectors; the vocabulary stays a table."""
    rows = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("district"))
    made, values = L.encode_by_table(rows, "district", "district_vector", "o_orderkey")
    made = made.withColumn("parts", L.vector_parts(F.col("district_vector")))
    n_set = F.aggregate("parts.values", F.lit(0.0), lambda a, x: a + x).cast("bigint")
    return made.select(
        "o_orderkey", F.array_join(F.transform("district_vector_places", lambda x: x.cast("string")), ",").alias("places"),
        n_set.alias("n_set"), F.col("parts.size").cast("bigint").alias("size"),
    )


# --- files ------------------------------------------------------------------------------------------------


def as_csv(t: Tables, df: DataFrame) -> str:
    return sinks.save_csv(df, f"{work_folder(t.spark)}/csv-{uuid.uuid4().hex}")


@query("SELECT doc_id, md5(text) AS text_md5, n_chars, CASE WHEN lang <> 'de' THEN lang END AS lang FROM documents")
def report_csv(t):
    """Free text with quotes and line breaks survives the CSV; NULL stands for a missing-value token."""
    messy = t.documents.select("doc_id", "text", "n_chars", F.when(F.col("lang") == "de", "NULL").otherwise(F.col("lang")).alias("lang"))
    back = tables.read_reports(t.spark, as_csv(t, messy))
    return back.select(big(F.col("doc_id")).alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("text_md5"), big(F.col("n_chars")).alias("n_chars"), "lang")


@query(ORACLE["report_csv"])
def report_csv_by_ranges(t):
    """The same files, each read by many tasks."""
    messy = t.documents.select("doc_id", "text", "n_chars", F.when(F.col("lang") == "de", "NULL").otherwise(F.col("lang")).alias("lang"))
    back = tables.read_reports(t.spark, as_csv(t, messy), range_bytes=1 << 20)
    return back.select(big(F.col("doc_id")).alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("text_md5"), big(F.col("n_chars")).alias("n_chars"), "lang")


@query("""SELECT ts::DATE AS date, round(avg(value), 6) AS "rain (mm)", count(*) AS n_rows, count(*) FILTER (event_type <> 'view') AS n_wind FROM events GROUP BY 1""")
def weather_csv(t):
    wind = F.when(F.col("event_type") == "view", "NaN").otherwise("1.5")
    hourly_rows = t.events.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), F.col("value").alias("rain (mm)"), wind.alias("wind_speed_10m (km/h)")
    )
    weather = tables.read_weather(t.spark, as_csv(t, hourly_rows))
    daily = weather.groupBy(F.to_date("time").alias("date"))
    return daily.agg(
        F.round(F.avg("rain (mm)"), 6).alias("rain (mm)"), F.count(F.lit(1)).alias("n_rows"), F.count("wind_speed_10m (km/h)").alias("n_wind")
    )


@query("""SELECT o_orderdate::DATE AS date, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS pm25, o_orderkey::DOUBLE AS pm10 FROM orders""")
def air_csv(t):
    daily_rows = t.orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.when(F.col("o_orderstatus") == "F", "n/a ").otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("string"))).alias(" pm25"),
        F.col("o_orderkey").alias(" pm10"), F.lit(1).alias(" so2"), F.lit(1).alias(" co"),
    )
    return tables.read_air_quality(t.spark, as_csv(t, daily_rows))


PREPARED_TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "F", "O", "P"]


@query(f"""WITH w AS (SELECT l_shipdate::DATE AS date, avg(l_quantity) AS rain FROM lineitem GROUP BY 1)
SELECT o_orderkey, round(rain, 6) AS rain, hour(o_orderdate)::INT AS hour, (isodow(o_orderdate) - 1)::INT AS day_of_week, month(o_orderdate)::INT AS month,
round(sin(2 * pi() * month(o_orderdate) / 12), 9) + 0 AS month_sin, (o_orderstatus = 'F')::INT AS "district_F", (o_orderstatus = 'O')::INT AS "district_O", (o_orderstatus = 'P')::INT AS "district_P",
""" + ", ".join(f"""list_contains(labels, '{v}')::INT AS "type_{v}" """ for v in PREPARED_TYPES) + f"""
FROM {ORDER_LABELS} o JOIN w ON w.date = o.o_orderdate::DATE WHERE len(labels) > 0""")
def prepared_table(t):
    """Daily weather joined to reports, rows without weather dropped, then all features and targets."""
    reports = order_labels(t).select("o_orderkey", "type", F.col("o_orderdate").alias("timestamp"), F.col("o_orderstatus").alias("district"))
    weather = E.daily_mean(t.lineitem, "l_shipdate", ["l_quantity"]).withColumnRenamed("l_quantity", "rain (mm)")
    made = batch.prepare(E.enrich_daily(E.add_date(reports, "timestamp"), weather), id_column="o_orderkey").table
    kept = [c for c in made.columns if c.startswith(("district_", "type_"))]
    return made.select(
        "o_orderkey", F.round("rain (mm)", 6).alias("rain"), "hour", "day_of_week", "month", (F.round("month_sin", 9) + 0.0).alias("month_sin"), *kept
    )


# --- coordinates and time ------------------------------------------------------------------------------

@query(f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN longitude END AS longitude,
CASE WHEN o_orderstatus = 'O' THEN latitude END AS latitude FROM {ORDER_SITES}""")
def coords_split(t):
    sites = order_sites(t)
    pair = F.concat_ws(",", F.col("longitude").cast("string"), F.col("latitude").cast("string"))
    text = F.when(F.col("o_orderstatus") == "F", F.concat(pair, F.lit(",1"))).when(F.col("o_orderstatus") == "P", F.col("longitude").cast("string"))
    return S.split_coordinates(sites.select("o_orderkey", text.otherwise(pair).alias("coords"))).drop("coords")


@query(f"""SELECT DISTINCT
round_even(round_even((longitude - longitude % 0.1::DOUBLE) / 0.1::DOUBLE, 0) * 0.1::DOUBLE * 100000, 0) / 100000.0::DOUBLE AS lon_bin,
round_even(round_even((latitude - latitude % 0.1::DOUBLE) / 0.1::DOUBLE, 0) * 0.1::DOUBLE * 100000, 0) / 100000.0::DOUBLE AS lat_bin
FROM {EVENT_SITES}""")
def coords_grid(t):
    return D.grid_coordinates(event_sites(t))


@query(f"""SELECT o_orderkey, round(sqrt((latitude - 13.74::DOUBLE) ^ 2 + (longitude - 100.50::DOUBLE) ^ 2) * 111, 6)
AS distance_to_weather_station_km FROM {ORDER_SITES}""")
def distance(t):
    km = "distance_to_weather_station_km"
    return S.calculate_distances(order_sites(t)).select("o_orderkey", F.round(km, 6).alias(km))


@query("""SELECT event_id, hour(ts)::INT AS hour, (isodow(ts) - 1)::INT AS day_of_week, month(ts)::INT AS month,
dayname(ts) AS day_name, monthname(ts) AS month_name FROM events""")
def time_features(t):
    return t.events.select("event_id", *[e.alias(n) for n, e in {**S.time_parts("ts"), **S.name_parts("ts")}.items()])


@query("""SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 9) + 0 AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 9) + 0 AS hour_cos,
round(sin(2 * pi() * (isodow(ts) - 1) / 7), 9) + 0 AS day_sin, round(cos(2 * pi() * (isodow(ts) - 1) / 7), 9) + 0 AS day_cos,
round(sin(2 * pi() * month(ts) / 12), 9) + 0 AS month_sin, round(cos(2 * pi() * month(ts) / 12), 9) + 0 AS month_cos FROM events""")
def cyclical(t):
    made = S.cyclical(*S.time_parts("ts").values())
    return t.events.select("event_id", *[(F.round(e, 9) + 0.0).alias(n) for n, e in made.items()])


@query("""SELECT o_orderkey, o_orderdate::DATE AS day, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS iso_day FROM orders""")
def parse_times(t):
    day = F.col("o_orderdate")
    text = F.when(F.col("o_orderstatus") == "P", F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    rows = t.orders.select("o_orderkey", text.alias("text"))
    return rows.select("o_orderkey", F.to_date(S.parse_time("text")).alias("day"), S.parse_date("text").alias("iso_day"))


@query("""SELECT CASE WHEN o_orderstatus = 'P' THEN 'invalid' ELSE 'valid' END AS kind, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1""")
def valid_and_invalid_times(t):
    text = F.when(F.col("o_orderstatus") == "P", "NULL").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    rows = E.with_hour(C.null_tokens_to_null(t.orders.select("o_orderkey", text.alias("timestamp"))), "timestamp")
    valid, invalid = C.valid_and_invalid(rows, "hour_ts")
    both = valid.select(F.lit("valid").alias("kind"), "o_orderkey").unionAll(invalid.select(F.lit("invalid"), "o_orderkey"))
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query(f"""WITH e AS (SELECT event_id, event_type, value, longitude, latitude, date_trunc('hour', ts) AS h,
  round_even(round_even(latitude / 0.1::DOUBLE, 0) * 0.1::DOUBLE * 10, 0)::INT AS la,
  round_even(round_even(longitude / 0.1::DOUBLE, 0) * 0.1::DOUBLE * 10, 0)::INT AS lo FROM {EVENT_SITES}),
w AS (SELECT la, lo, h, avg(value) AS temp FROM e WHERE event_type = 'view' GROUP BY ALL)
SELECT e.event_id, round(w.temp, 6) AS temp, round(sqrt((latitude - 13.74::DOUBLE) ^ 2 + (longitude - 100.5::DOUBLE) ^ 2) * 111, 6) AS km
FROM e LEFT JOIN w USING (la, lo, h) WHERE e.event_type <> 'view'""")
def station_transform(t):
    """The whole transform step, from text coordinates and times to the joined table."""
    sites = event_sites(t)
    pair = F.concat_ws(",", F.col("longitude").cast("string"), F.col("latitude").cast("string"))
    reports = sites.filter("event_type <> 'view'").select("event_id", pair.alias("coords"), F.col("ts").cast("string").alias("timestamp"))
    cells = E.with_hour(E.assign_grid_cells(sites.filter("event_type = 'view'")), "ts", "time")
    weather = cells.groupBy("time", F.col("grid_lat").alias("latitude"), F.col("grid_lon").alias("longitude")).agg(F.avg("value").alias("temp"))
    return E.transform(reports, weather).select("event_id", F.round("temp", 6).alias("temp"), F.round("distance_to_weather_station_km", 6).alias("km"))


@query("""SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END, 0) AS pm25 FROM orders""")
def fill_and_rename(t):
    price = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice"))
    rows = C.rename_if_present(t.orders.select("o_orderkey", price.alias(" pm25")), {" pm25": "pm25", " pm10": "pm10"})
    return C.fill_zero(rows, C.columns_containing(rows, "pm"))


@query(f"""SELECT o.o_orderkey, o_orderdate::DATE AS date, longitude, latitude, array_to_string(labels, '|') AS labels, o.o_totalprice AS pm25
FROM {ORDER_SITES} o JOIN (SELECT o_orderkey, labels FROM {ORDER_LABELS}) l USING (o_orderkey) WHERE len(labels) > 0 AND o_orderstatus <> 'O'""")
def map_table(t):
    """Bad dates, bad coordinates and reports without a label are left out of the map."""
    sites = order_sites(t).select("o_orderkey", "longitude", "latitude")
    pair = F.concat_ws(",", F.col("longitude").cast("string"), F.col("latitude").cast("string"))
    bad = (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") < 50_000)
    raw = order_labels(t).join(sites, "o_orderkey").select(
        "o_orderkey", "type", F.col("o_totalprice").cast("string").alias(" pm25"), F.lit("1").alias(" o3"),
        F.when(bad, "x").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.when(F.col("o_orderstatus") == "O", F.lit("100.5")).otherwise(pair).alias("coords"),
    )
    return V.map_table(raw).select("o_orderkey", "date", "longitude", "latitude", F.array_join("types", "|").alias("labels"), "pm25")


@query("""SELECT hour(ts)::INT AS hour, dayname(ts) AS day_name, monthname(ts) AS month_name, count(*) AS n, round(sum(value), 4) AS pm25 FROM events GROUP BY ALL""")
def dashboard_table(t):
    raw = t.events.select(F.col("ts").cast("string").alias("timestamp"), F.col("value").cast("string").alias(" pm25 "))
    table = V.dashboard_table(raw)
    return table.groupBy("hour", "day_name", "month_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("pm25"), 4).alias("pm25"))


# --- labels ---------------------------------------------------------------------------------------------

LABEL_ROWS = "SELECT o_orderkey, len({0})::INT AS n_labels, array_to_string({0}, '|') AS labels FROM {1}"


def label_rows(df: DataFrame, types: Column) -> DataFrame:
    return df.select("o_orderkey", F.size(types).alias("n_labels"), F.array_join(types, "|").alias("labels"))


@query(LABEL_ROWS.format("labels", ORDER_LABELS))
def parse_types(t):
    return label_rows(L.parse_type_column(order_labels(t)), F.col("type"))


@query(LABEL_ROWS.format("labels", ORDER_LABELS))
def parse_types_marked(t):
    marked = order_labels(t).replace("{}", L.NO_LABEL, ["type"])
    return label_rows(marked, L.label_list_marked(F.col("type")))


@query(LABEL_ROWS.format("labels", ORDER_LABELS) + " WHERE len(labels) > 0")
def parse_types_no_braces(t):
    types = order_labels(t).withColumn("type", L.label_list_without_braces(F.col("type")))
    return label_rows(types.filter(F.size(F.array_remove("type", "")) > 0), F.col("type"))


LABEL_COUNT_SQL = f"""WITH b AS (SELECT * FROM {ORDER_LABELS} WHERE len(labels) > 0), n AS (SELECT count(*) AS n FROM b),
c AS (SELECT label, count(*) AS positive FROM (SELECT unnest(labels) AS label FROM b) GROUP BY 1) """


def labelled_orders(t: Tables) -> DataFrame:
    return L.parse_type_column(L.filter_empty_types(order_labels(t)))


@query(LABEL_COUNT_SQL + "SELECT label, positive, round(positive * 100.0 / n, 6) AS percent FROM c, n")
def type_counts(t):
    return L.label_counts(labelled_orders(t)).withColumn("percent", F.round("percent", 6))


@query(LABEL_COUNT_SQL + """SELECT label, positive, n - positive AS negative, round(positive / n::DOUBLE, 9) AS ratio,
round((n - positive) / positive::DOUBLE, 6) AS imbalance FROM c, n ORDER BY positive DESC, label LIMIT 15""")
def class_distribution(t):
    d = L.class_distribution(labelled_orders(t), first=15)
    return d.withColumns({"ratio": F.round("ratio", 9), "imbalance": F.round("imbalance", 6)})


TRAINABLE_SQL = """WITH c AS (SELECT label::VARCHAR AS label, count(*) AS positive FROM embeddings GROUP BY 1),
n AS (SELECT count(*) AS n FROM embeddings)
SELECT label, positive, positive >= 50 AS trainable, CASE WHEN positive / n::DOUBLE >= 0.15 THEN 'class_weight'
WHEN positive / n::DOUBLE >= 0.05 THEN 'undersampling' ELSE 'smote_under' END AS strategy FROM c, n"""


@query(TRAINABLE_SQL)
def trainable_types(t):
    return L.trainable_flags(t.embeddings.select(F.array(F.col("label").cast("string")).alias("type")))


HOT = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "F", "O", "P"]


@query("SELECT o_orderkey, " + ", ".join(f"""list_contains(labels, '{v}')::INT AS "type_{v}" """ for v in HOT) + f"FROM {ORDER_LABELS} WHERE len(labels) > 0")
def multi_hot(t):
    return L.create_binary_targets(labelled_orders(t).select("o_orderkey", "type"))[0].drop("type")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("SELECT c_custkey, " + ", ".join(f"(c_mktsegment = '{v}')::INT AS district_{v}" for v in SEGMENTS) + " FROM customer")
def one_hot(t):
    return L.encode_districts(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment").drop("c_mktsegment")


@query("""WITH w AS (SELECT unnest(string_split(text, ' ')) AS feature FROM documents),
k AS (SELECT feature, CASE WHEN regexp_matches(lower(feature), 'hour|day|month|weekend') THEN 'Temporal'
WHEN regexp_matches(lower(feature), 'pm|o3|no2|aqi') THEN 'Air Quality'
WHEN regexp_matches(lower(feature), 'temp|rain|wind|humidity|pressure|cloud|precipitation') THEN 'Weather'
WHEN regexp_matches(lower(feature), 'lat|long|district') THEN 'Location' ELSE 'Other' END AS category FROM w)
SELECT category, count(*) AS n, count(DISTINCT feature) AS n_distinct FROM k GROUP BY 1""")
def feature_categories(t):
    words = t.documents.select(F.explode(F.split("text", " ", -1)).alias("feature"))
    counted = words.groupBy("feature").count().withColumn("category", S.feature_category("feature"))
    return counted.groupBy("category").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("n_distinct"))


@query("""SELECT CASE WHEN regexp_matches(p_name, 'rain|wind|temp') THEN 'Weather' WHEN regexp_matches(p_name, 'lat|long|district') THEN 'Location'
ELSE 'Other' END AS category, round(sum(p_retailprice), 4) AS importance FROM part GROUP BY 1""")
def importance_by_category(t):
    importance = t.part.select(F.col("p_name").alias("feature"), F.col("p_retailprice").alias("importance"))
    return A.importance_by_category(importance).withColumn("importance", F.round("importance", 4))


@query(f"""WITH c AS (SELECT 'type_' || label AS name, count(*) AS n FROM (SELECT unnest(labels) AS label FROM {ORDER_LABELS}) GROUP BY 1),
t AS (SELECT count(*) AS total FROM orders) SELECT replace(name, 'type_', '') AS label, round(n / total::DOUBLE, 9) AS ratio,
round((n - total) * 100.0 / total, 6) AS change_percent FROM c, t WHERE name NOT LIKE '%\\_sin%' ESCAPE '\\' AND name NOT LIKE '%district\\_%' ESCAPE '\\'""")
def label_report(t):
    rows = L.label_counts(L.parse_type_column(order_labels(t)))
    total = t.orders.agg(F.count(F.lit(1))).scalar()
    named = rows.select(F.concat(F.lit("type_"), "label").alias("name"), "positive").withColumn("total", total)
    kept = named.filter(~S.is_cyclical_name("name") & ~S.is_district_name("name"))
    return kept.select(
        S.drop_prefix("name").alias("label"),
        F.round(S.share(F.col("positive"), F.col("total")), 9).alias("ratio"),
        F.round(S.percent_change(F.col("positive"), F.col("total")), 6).alias("change_percent"),
    )


# --- dashboard ---------------------------------------------------------------------------------------------

@query("""SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_districts, round(avg(value), 6) AS avg_value,
max(value) AS max_value, round(sum(value), 2) AS sum_value_over_rows FROM events""")
def dashboard_metrics(t):
    m = A.metrics(t.events, "user_id", ["value"], ["value"], ["value"])
    return m.withColumns({"avg_value": F.round("avg_value", 6), "sum_value_over_rows": F.round("sum_value_over_rows", 2)})


@query("SELECT ts::DATE AS date, count(*) AS n FROM events GROUP BY 1")
def by_date(t):
    return A.counts_by(t.events, F.to_date("ts"), "date")


@query("SELECT hour(ts)::INT AS hour, count(*) AS n FROM events GROUP BY 1")
def by_hour(t):
    return A.counts_by(t.events, F.hour("ts"), "hour")


DAYS_SQL = """WITH d AS (SELECT i::INT AS day_index, ['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'][i + 1]
AS day_name FROM range(7) r(i)) """


@query(DAYS_SQL + """SELECT day_index, day_name, n FROM d LEFT JOIN
(SELECT (isodow(ts) - 1)::INT AS day_index, count(*) AS n FROM events GROUP BY 1) USING (day_index)""")
def by_day_of_week(t):
    return A.counts_by_day_of_week(t.events, "ts")


@query(DAYS_SQL + "SELECT day_index, day_name, " + ", ".join(f"h{h:02d}" for h in range(24)) + """ FROM d LEFT JOIN
(SELECT (isodow(ts) - 1)::INT AS day_index, """ + ", ".join(f"count(*) FILTER (hour(ts) = {h}) AS h{h:02d}" for h in range(24)) + """
FROM events GROUP BY 1) USING (day_index)""")
def day_hour_table(t):
    return A.day_hour_table(t.events, "ts")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 15")
def top_districts(t):
    return A.top_counts(t.events, "user_id")


@query("SELECT min(n) AS min_n, max(n) AS max_n FROM (SELECT count(*) AS n FROM events GROUP BY user_id)")
def district_count_range(t):
    return A.count_range(t.events, "user_id")


@query("""WITH l AS (SELECT * FROM (VALUES (0, '0-12', -1, 12), (1, '13-35', 12, 35), (2, '36-55', 35, 55), (3, '56-150', 55, 150),
(4, '151-250', 150, 250), (5, '251+', 250, 500)) v(range_index, range_label, lo, hi))
SELECT range_index, range_label, count(value) AS n FROM l LEFT JOIN events ON value > lo AND value <= hi AND value >= 0 GROUP BY ALL""")
def pm25_ranges(t):
    return A.fixed_range_counts(t.events, "value")


BINS_SQL = """WITH s AS (SELECT min({c}) AS lo, max({c}) AS hi FROM {t}), i AS (SELECT i::INT AS bin FROM range(1, {n} + 1) r(i)),
b AS (SELECT 1 + list_sum([({c} > lo + k * ((hi - lo) / {n}))::INT FOR k IN range(1, {n})]) AS bin FROM {t}, s)
SELECT i.bin, round((lo + (i.bin - 1) * ((hi - lo) / {n}) - CASE WHEN i.bin = 1 THEN (hi - lo) * 0.001 ELSE 0 END + lo + i.bin * ((hi - lo) / {n})) / 2, 6) AS mid,
(SELECT count(*) FROM b WHERE b.bin = i.bin) AS n FROM i, s"""


@query(BINS_SQL.format(c="value", t="events", n=20))
def rain_bins(t):
    return A.equal_width_counts(t.events, "value").withColumn("mid", F.round("mid", 6))


@query(BINS_SQL.format(c="o_totalprice", t="orders", n=35))
def pm25_histogram(t):
    return A.equal_width_counts(t.orders, "o_totalprice", 35).withColumn("mid", F.round("mid", 6))


@query(f"""SELECT round_even(round_even((longitude - longitude % 0.01::DOUBLE) / 0.01::DOUBLE, 0) * 0.01::DOUBLE * 100000, 0) / 100000.0::DOUBLE AS lon_bin,
round_even(round_even((latitude - latitude % 0.01::DOUBLE) / 0.01::DOUBLE, 0) * 0.01::DOUBLE * 100000, 0) / 100000.0::DOUBLE AS lat_bin,
count(*) AS n FROM {ORDER_SITES} GROUP BY ALL""")
def heat_density(t):
    return A.density(order_sites(t))


@query(f"SELECT round(avg(latitude), 9) AS latitude, round(avg(longitude), 9) AS longitude FROM {ORDER_SITES}")
def map_centre(t):
    return A.centroid(order_sites(t)).select(F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"))


@query("""WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) SELECT * FROM c WHERE n = (SELECT max(n) FROM c)""")
def mode_values(t):
    return A.modes(t.orders, "o_orderpriority")


@query(f"""SELECT min(latitude) AS min_latitude, max(latitude) AS max_latitude, min(longitude) AS min_longitude,
max(longitude) AS max_longitude FROM {ORDER_SITES}""")
def value_range(t):
    return A.value_range(order_sites(t), ["latitude", "longitude"])


# --- samples, splits, metrics --------------------------------------------------------------------------------

@query("SELECT event_id, value FROM events ORDER BY md5('42:' || event_id) LIMIT 2500")
def sample_exact(t):
    return P.sample_data(t.events.select("event_id", "value"), "event_id", 2500)


@query("""WITH s AS (SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY md5('42:under:' || doc_id)) AS r FROM labels)
SELECT doc_id, toxic FROM s WHERE toxic = 1 OR r <= floor((SELECT count(*) FROM labels WHERE toxic = 1) / 0.5)""")
def undersample(t):
    return P.undersample(t.labels.select("doc_id", "toxic"), "toxic", "doc_id")


@query("""WITH s AS (SELECT *, row_number() OVER (ORDER BY md5('42:split:' || event_id)) AS r, count(*) OVER () AS n FROM events)
SELECT event_id, r <= ceil(n * 0.2) AS is_test FROM s""")
def random_split(t):
    return P.mark_test(t.events.select("event_id"), "event_id")


@query("""WITH s AS (SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY md5('42:split:' || doc_id)) AS r FROM labels),
k AS (SELECT toxic, count(*) AS n, ceil((SELECT count(*) FROM labels) * 0.2) AS tests, (SELECT count(*) FROM labels) AS total FROM labels GROUP BY 1),
f AS (SELECT *, floor(tests * n / total) AS base, tests * n / total - floor(tests * n / total) AS rest FROM k),
a AS (SELECT toxic, base + (row_number() OVER (ORDER BY rest DESC, toxic) <= tests - sum(base) OVER ())::INT AS cut FROM f)
SELECT doc_id, toxic, r <= cut AS is_test FROM s JOIN a USING (toxic)""")
def stratified_split(t):
    return P.mark_test(t.labels.select("doc_id", "toxic"), "doc_id", stratify="toxic")


@query("""WITH s AS (SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY md5('42:fold:' || doc_id)) AS r,
count(*) OVER (PARTITION BY toxic) AS n FROM labels)
SELECT doc_id, toxic, list_sum([(r > ceil(n * i / 5))::INT FOR i IN range(1, 5)])::INT AS fold FROM s""")
def stratified_folds(t):
    return P.add_folds(t.labels.select("doc_id", "toxic"), "toxic", "doc_id")


@query("""WITH s AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY md5('42:split:' || o_orderkey)) AS r FROM orders),
k AS (SELECT o_custkey, count(*) AS n, ceil((SELECT count(*) FROM orders) * 0.2) AS tests, (SELECT count(*) FROM orders) AS total FROM orders GROUP BY 1),
f AS (SELECT *, floor(tests * n / total) AS base, floor(tests * n / total) - tests * n / total AS less FROM k),
a AS (SELECT o_custkey, base + (row_number() OVER (ORDER BY less, o_custkey::VARCHAR) <= tests - sum(base) OVER ())::INT AS cut FROM f)
SELECT o_orderkey, o_custkey, r <= cut AS is_test FROM s JOIN a USING (o_custkey)""")
def stratified_split_many(t):
    """As many classes as there are customers with orders."""
    return P.mark_test(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", stratify="o_custkey")


@query("""WITH s AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY md5('42:fold:' || o_orderkey)) AS r,
count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT o_orderkey, o_custkey, list_sum([(r > ceil(n * i / 5))::INT FOR i IN range(1, 5)])::INT AS fold FROM s""")
def stratified_folds_many(t):
    return P.add_folds(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey")


PREDICTED_SQL = "WITH p AS (SELECT quality AS label, 1 - toxic AS prediction FROM labels) "


def predicted(t: Tables) -> DataFrame:
    return t.labels.select(F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 9).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


@query(PREDICTED_SQL + """, c AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM p)
SELECT tp, fp, fn, tn, round((tp + tn) / (tp + tn + fp + fn)::DOUBLE, 9) AS accuracy, round(tp / (tp + fp)::DOUBLE, 9) AS precision,
round(tp / (tp + fn)::DOUBLE, 9) AS recall, round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 9) AS f1 FROM c""")
def binary_metrics(t):
    return rounded(M.binary_metrics(predicted(t)))


WEIGHTED_SQL = PREDICTED_SQL + """, k AS (SELECT * FROM (VALUES (0), (1)) v(c)), r AS (SELECT c, (SELECT count(*) FROM p WHERE label = c) AS support,
(SELECT count(*) FROM p WHERE prediction = c) AS predicted, (SELECT count(*) FROM p WHERE label = c AND prediction = c) AS hit FROM k),
m AS (SELECT *, hit / predicted::DOUBLE AS p, hit / support::DOUBLE AS q, 2 * hit / (predicted + support)::DOUBLE AS f FROM r) """


@query(WEIGHTED_SQL + """SELECT round(sum(hit) / sum(support), 9) AS accuracy, round(sum(p * support) / sum(support), 9) AS precision,
round(sum(q * support) / sum(support), 9) AS recall, round(sum(f * support) / sum(support), 9) AS f1_score FROM m""")
def weighted_metrics(t):
    return rounded(M.weighted_metrics(predicted(t)))


@query(WEIGHTED_SQL + """SELECT c::DOUBLE AS cls, support, hit, round(p, 9) AS precision, round(q, 9) AS recall, round(f, 9) AS f1 FROM m""")
def class_report(t):
    return rounded(M.class_report(predicted(t)))


@query(PREDICTED_SQL + "SELECT label, prediction, count(*) AS n FROM p GROUP BY ALL")
def confusion_counts(t):
    return M.confusion_counts(predicted(t))


@query("""WITH p AS (SELECT (l_returnflag = 'R')::INT AS y0, (l_linestatus = 'O')::INT AS y1, (l_discount > 0.05)::INT AS p0, (l_tax > 0.04)::INT AS p1 FROM lineitem),
c AS (SELECT avg((y0 = p0 AND y1 = p1)::INT) AS accuracy, sum(y0 * p0) AS t0, sum(y1 * p1) AS t1, sum(p0) AS q0, sum(p1) AS q1, sum(y0) AS a0, sum(y1) AS a1 FROM p)
SELECT round(accuracy, 9) AS accuracy, round((t0 + t1) / (q0 + q1), 9) AS precision_micro, round((t0 / q0 + t1 / q1) / 2, 9) AS precision_macro,
round((t0 + t1) / (a0 + a1), 9) AS recall_micro, round((t0 / a0 + t1 / a1) / 2, 9) AS recall_macro,
round(2 * (t0 + t1) / (q0 + q1 + a0 + a1), 9) AS f1_micro, round((2 * t0 / (q0 + a0) + 2 * t1 / (q1 + a1)) / 2, 9) AS f1_macro FROM c""")
def multilabel_metrics(t):
    flags = t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y0"), (F.col("l_linestatus") == "O").cast("int").alias("y1"),
        (F.col("l_discount") > 0.05).cast("int").alias("p0"), (F.col("l_tax") > 0.04).cast("int").alias("p1"),
    )
    return rounded(M.multilabel_metrics(flags, ["y0", "y1"], ["p0", "p1"]))


@query("""WITH p AS (SELECT (l_returnflag = 'R')::INT AS y0, (l_linestatus = 'O')::INT AS y1, (l_discount > 0.05)::INT AS p0, (l_tax > 0.04)::INT AS p1 FROM lineitem),
c AS (SELECT 'y0' AS target, sum(y0) AS support, sum(p0) AS predicted, sum(y0 * p0) AS hit FROM p UNION ALL SELECT 'y1', sum(y1), sum(p1), sum(y1 * p1) FROM p)
SELECT target, support::BIGINT AS support, predicted::BIGINT AS predicted, hit::BIGINT AS hit, round(hit / predicted, 9) AS precision, round(hit / support, 9) AS recall,
round(2 * hit / (predicted + support), 9) AS f1 FROM c""")
def multilabel_report(t):
    flags = t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y0"), (F.col("l_linestatus") == "O").cast("int").alias("y1"),
        (F.col("l_discount") > 0.05).cast("int").alias("p0"), (F.col("l_tax") > 0.04).cast("int").alias("p1"),
    )
    return rounded(M.multilabel_report(flags, ["y0", "y1"], ["p0", "p1"]))


@query("""WITH s AS (SELECT l_extendedprice AS s, count(*) FILTER (l_returnflag = 'R') AS p, count(*) FILTER (l_returnflag <> 'R') AS n FROM lineitem GROUP BY 1),
w AS (SELECT *, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT sum(p)::BIGINT AS positive, sum(n)::BIGINT AS negative, round(sum(p::HUGEINT * (2 * below + n)) / (2.0::DOUBLE * sum(p) * sum(n)), 9) AS auc FROM w""")
def roc_auc(t):
    scored = t.lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_extendedprice").alias("probability"))
    return rounded(M.roc_auc(scored, ranked_rows=5_000))


# --- clusters ----------------------------------------------------------------------------------------------------

def cluster_sql(rows: str, min_samples: int, columns: str = "") -> str:
    """DBSCAN by brute force: rows has o_orderkey, longitude and latitude; `columns` are passed through."""
    return f"""WITH RECURSIVE s AS MATERIALIZED (SELECT *, round(longitude * 10000)::INT AS x, round(latitude * 10000)::INT AS y FROM {rows}),
g AS MATERIALIZED (SELECT x, y, count(*) AS w, min(o_orderkey) AS id FROM s GROUP BY ALL),
o AS (SELECT i::INT AS dx, j::INT AS dy FROM range(-8, 9) a(i), range(-8, 9) b(j) WHERE i * i + j * j <= 64),
n AS MATERIALIZED (SELECT a.id AS u, b.id AS v, b.w FROM g a, o, g b WHERE b.x = a.x + o.dx AND b.y = a.y + o.dy),
k AS MATERIALIZED (SELECT u AS id FROM n GROUP BY u HAVING sum(w) >= {min_samples}),
e AS MATERIALIZED (SELECT u, v FROM n WHERE u <> v AND u IN (FROM k) AND v IN (FROM k)),
c(id, root) USING KEY (id) AS (SELECT id, id FROM k UNION
  (SELECT e.u, min(c.root) FROM c JOIN e ON e.v = c.id JOIN recurring.c AS r ON r.id = e.u WHERE c.root < r.root GROUP BY e.u)),
f AS (SELECT id, root FROM c UNION ALL
  SELECT n.u, min(c.root) FROM n JOIN c ON c.id = n.v WHERE n.u NOT IN (FROM k) GROUP BY n.u),
d AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM c))
SELECT s.o_orderkey, {columns} coalesce(d.cluster, -1) AS cluster FROM s JOIN g USING (x, y) LEFT JOIN f ON f.id = g.id LEFT JOIN d ON d.root = f.root"""


@query(cluster_sql(ORDER_SITES, 1))
def dbscan(t):
    return K.dbscan(order_sites(t), "o_orderkey").select("o_orderkey", "cluster")


@query(cluster_sql(ORDER_SITES, 4))
def dbscan_dense_cores(t):
    return K.dbscan(order_sites(t), "o_orderkey", min_samples=4).select("o_orderkey", "cluster")


WIDE_SITES = f"(SELECT o_orderkey, longitude * 10 - 900 AS longitude, latitude * 10 - 100 AS latitude FROM {ORDER_SITES})"
WIDE_SQL = cluster_sql(WIDE_SITES, 4).replace(
    "range(-8, 9) a(i), range(-8, 9) b(j) WHERE i * i + j * j <= 64", "range(-1, 2) a(i), range(-1, 2) b(j)"
).replace(
    "WHERE b.x = a.x + o.dx AND b.y = a.y + o.dy",
    "WHERE b.x // 100 = a.x // 100 + o.dx AND b.y // 100 = a.y // 100 + o.dy AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 10000",
)


@query(WIDE_SQL)
def dbscan_wide(t):
    """Cells wider than lists of points allow for."""
    sites = order_sites(t).select("o_orderkey", (F.col("longitude") * 10 - 900).alias("longitude"), (F.col("latitude") * 10 - 100).alias("latitude"))
    return K.dbscan(sites, "o_orderkey", eps=0.01, min_samples=4).select("o_orderkey", "cluster")


MAP_SQL = f"""(WITH q AS (SELECT o.o_orderkey, o.o_orderdate::DATE AS date, longitude, latitude FROM {ORDER_SITES} o JOIN {ORDER_LABELS} l USING (o_orderkey)
WHERE year(o.o_orderdate) = 1998 AND list_has_any(labels, ['1-URGENT', 'P'])),
u AS (SELECT min(o_orderkey) AS o_orderkey, date, longitude, latitude FROM q GROUP BY ALL)
SELECT * FROM u WHERE date >= (SELECT max(date) FROM u) - 365)"""


@query(cluster_sql(MAP_SQL, 1, "date, latitude, longitude,"))
def map_points(t):
    table = L.parse_type_column(order_labels(t)).select("o_orderkey", F.to_date("o_orderdate").alias("date"), F.col("type").alias("types"))
    places = order_sites(t).select("o_orderkey", "latitude", "longitude")
    points = V.map_points(table.join(places, "o_orderkey"), "o_orderkey", 1998, ["1-URGENT", "P"])
    return points.select("o_orderkey", "date", "latitude", "longitude", "cluster")


@query(cluster_sql(f"(SELECT * FROM {MAP_SQL} ORDER BY md5('42:' || o_orderkey) LIMIT 200)", 1, "date, latitude, longitude,"))
def map_points_sampled(t):
    """A map that can draw 200 points only gets a sample of exactly so many."""
    table = L.parse_type_column(order_labels(t)).select("o_orderkey", F.to_date("o_orderdate").alias("date"), F.col("type").alias("types"))
    points = V.map_points(table.join(order_sites(t).select("o_orderkey", "latitude", "longitude"), "o_orderkey"), "o_orderkey", 1998, ["1-URGENT", "P"], max_rows=200)
    return points.select("o_orderkey", "date", "latitude", "longitude", "cluster")


# --- imbalance -----------------------------------------------------------------------------------------------------


def vectors(t: Tables, positive: Column) -> DataFrame:
    doubles = F.col("embedding").cast("array<double>")
    return t.embeddings.select(F.col("vec_id").cast("string").alias("row_id"), array_to_vector(doubles).alias("features"), positive.cast("double").alias("label"))


@query("""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
d AS (SELECT a.vec_id AS id, b.vec_id AS nid, list_distance(a.e, b.e) AS dist FROM v a JOIN v b ON a.vec_id <> b.vec_id)
SELECT id, nid, row_number() OVER (PARTITION BY id ORDER BY dist, nid) AS rank, round(dist, 6) AS dist FROM d
QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist, nid) <= 5""")
def nearest_rows(t):
    points = t.embeddings.select(F.col("vec_id").cast("string").alias("id"), F.col("embedding").cast("array<double>").alias("features"))
    found = N.nearest_neighbours(points, 5)
    return found.select(big(F.col("id")).alias("id"), big(F.col("nid")).alias("nid"), big(F.col("rank")).alias("rank"), F.round("dist", 6).alias("dist"))


STATS_SQL = """WITH c AS (SELECT count(*) FILTER (label = 0) AS p, count(*) FILTER (label <> 0) AS n FROM embeddings),
s AS (SELECT p, n, greatest(floor(0.2::DOUBLE * n - p), 0)::BIGINT + p AS rp FROM c)
SELECT 'smote_under' AS strategy, p AS original_positive, n AS original_negative, p + n AS original_total, rp AS resampled_positive,
floor(rp / 0.3::DOUBLE)::BIGINT AS resampled_negative, rp + floor(rp / 0.3::DOUBLE)::BIGINT AS resampled_total,
round((rp + floor(rp / 0.3::DOUBLE) - p - n) * 100 / (p + n), 6) AS change_percent FROM s"""


@query(STATS_SQL)
def smote_under_stats(t):
    made, stats = B.resample(vectors(t, F.col("label") == 0), strategy="smote_under")
    counted = made.agg(F.count_if(F.col("label") == 1).alias("resampled_positive"), F.count(F.lit(1)).alias("resampled_total"))
    asked = stats.to_df(t.spark).drop("error", "resampled_positive", "resampled_negative", "resampled_total")
    return asked.join(counted.withColumn("strategy", F.lit("smote_under")), "strategy").select(
        "strategy", "original_positive", "original_negative", "original_total", "resampled_positive",
        (F.col("resampled_total") - F.col("resampled_positive")).alias("resampled_negative"), "resampled_total",
        F.round("change_percent", 6).alias("change_percent"),
    )


@query()
def smote_rows(t):
    rare = vectors(t, F.col("label") == 0)
    sizes = rare.agg(F.count_if(F.col("label") == 1).alias("p"), F.count(F.lit(1)).alias("n")).first()
    made = B.smote(rare.filter("label = 1"), 4 * sizes["p"])
    return made.select("row_id", F.col("features").cast("string").alias("features"))


# --- forests --------------------------------------------------------------------------------------------------------

@query("""SELECT event_id, hour(ts)::DOUBLE AS hour, (isodow(ts) - 1)::DOUBLE AS day_of_week, month(ts)::DOUBLE AS month, value,
(event_type = 'click')::INT::DOUBLE AS district_click, (event_type = 'error')::INT::DOUBLE AS district_error, (event_type = 'purchase')::INT::DOUBLE AS district_purchase,
(event_type = 'signup')::INT::DOUBLE AS district_signup, (event_type = 'view')::INT::DOUBLE AS district_view FROM events""")
def feature_matrix(t):
    made = L.prepare_features(t.events.select("event_id", "ts", "event_type", "value"), "ts", "event_type")
    names = R.feature_columns(made, exclude=["event_id"])
    matrix = R.assemble(made, "event_id", names)
    values = vector_to_array("features")
    out = {n: F.get(values, F.lit(i)).alias(n) for i, n in enumerate(names)}
    wanted = [n for n in names if n in ("hour", "day_of_week", "month", "value") or n.startswith("district_")]
    return matrix.select(F.col("row_id").cast("bigint").alias("event_id"), *[out[n] for n in wanted])


@query()
def forest_metrics(t):
    train, test = P.split_data(vectors(t, F.col("label") < 3), "row_id", stratify="label")
    model = R.train_classifier(train)
    return R.evaluate_classifier(model, test)


@query()
def forest_multi_output(t):
    rows = vectors(t, F.col("label") < 3).withColumnRenamed("label", "y0")
    both = rows.join(vectors(t, F.col("label") > 5).select("row_id", F.col("label").alias("y1")), "row_id")
    train, test = P.split_data(both, "row_id")
    models = R.train_classifier(train, ["y0", "y1"])
    return R.evaluate_classifier(models, test, ["y0", "y1"])


@query()
def forest_importance(t):
    model = R.train_classifier(vectors(t, F.col("label") == 0))
    names = ["hour", "pm25", "temperature_2m (°C)", "latitude", *[f"district_{i}" for i in range(60)]]
    return R.importance_report(R.feature_importance(model, names, t.spark))


@query()
def forest_cross_validation(t):
    return R.cross_validate(vectors(t, F.col("label") < 3), R.forest(), cv=3, scoring="f1")[0]


@query()
def forest_search(t):
    trained = R.train_single_type_model(vectors(t, F.col("label") < 3))
    return t.spark.createDataFrame([(k, v) for k, v in trained.metrics.items()], "metric string, value double")


@query()
def forest_all_types(t):
    rows = vectors(t, F.col("label") < 3).drop("label")
    kind = t.embeddings.select(F.col("vec_id").cast("string").alias("row_id"), F.array(F.concat(F.lit("g"), F.floor(F.col("label") / 4))).alias("type"))
    results = R.train_all_types(rows.join(kind, "row_id"), [])
    return R.training_summary(results, t.spark)


# --- facts about models and synthetic rows that SQL can derive ---------------------------------------------------------


def one_row(*rows: DataFrame) -> DataFrame:
    """One-row tables side by side."""
    keyed = [df.withColumn("_one", F.lit(1)) for df in rows]
    return reduce(lambda a, b: a.join(b, "_one"), keyed).drop("_one")


@query("""WITH c AS (SELECT (label < 3)::INT AS y, count(*) AS n, (SELECT count(*) FROM embeddings) AS total FROM embeddings GROUP BY 1),
f AS (SELECT *, ceil(total * 0.2) AS tests, floor(ceil(total * 0.2) * n / total) AS base, ceil(total * 0.2) * n / total - floor(ceil(total * 0.2) * n / total) AS rest FROM c),
a AS (SELECT y, tests, base + (row_number() OVER (ORDER BY rest DESC, y) <= tests - sum(base) OVER ())::INT AS cut FROM f)
SELECT max(tests)::BIGINT AS n_test, max(cut) FILTER (y = 1)::BIGINT AS n_positive, max(tests)::BIGINT AS n_predicted, 2::BIGINT AS n_classes,
true AS in_range, 1.0::DOUBLE AS importance_sum FROM a""")
def forest_facts(t):
    """Sizes of the test split and of the predictions on it, and bounds of all scores."""
    train, test = P.split_data(vectors(t, F.col("label") < 3), "row_id", stratify="label")
    model = R.train_classifier(train)
    made = R.evaluation(model, test)
    sizes = made["predictions"].agg(
        F.count(F.lit(1)).alias("n_test"), F.count_if(F.col("label") == 1).alias("n_positive"), F.count("prediction").alias("n_predicted")
    )
    scores = made["scores"].first().asDict()
    report = made["report"].agg(
        F.count(F.lit(1)).alias("n_classes"), F.coalesce(F.bool_and(F.col("f1").between(0, 1)), F.lit(False)).alias("report_in_range")
    )
    total = R.feature_importance(model, None, t.spark).agg(F.round(F.sum("importance"), 6).alias("importance_sum"))
    fine = all(0 <= v <= 1 for k, v in scores.items() if isinstance(v, float))
    return one_row(sizes, report, total).select(
        "n_test", "n_positive", "n_predicted", "n_classes", (F.col("report_in_range") & F.lit(fine)).alias("in_range"), "importance_sum"
    )


@query("""WITH s AS (SELECT (label < 3) AS y, count(*) AS n FROM embeddings GROUP BY 1), k AS (SELECT unnest(range(3)) AS fold)
SELECT fold::INT AS fold, sum(ceil(n * (fold + 1) / 3) - ceil(n * fold / 3))::BIGINT AS n_rows, true AS in_range FROM s, k GROUP BY 1""")
def forest_fold_facts(t):
    rows = vectors(t, F.col("label") < 3)
    table, mean, spread = R.cross_validate(rows, R.forest(), cv=3, scoring="f1")
    sizes = P.add_folds(rows, "label", "row_id", 3).groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"))
    fine = F.col("score").between(0, 1) & F.lit(0 <= mean <= 1 and 0 <= spread <= 1)
    return sizes.join(table, "fold").select(F.col("fold").cast("int").alias("fold"), "n_rows", fine.alias("in_range"))


@query("""WITH g AS (SELECT 'g' || (label // 4) AS type, count(*) AS n, (SELECT count(*) FROM embeddings) AS total FROM embeddings GROUP BY 1)
SELECT type, n / total AS minority_ratio,
CASE WHEN n / total >= 0.15 THEN 'class_weight' WHEN n / total >= 0.05 THEN 'undersampling' ELSE 'smote_under' END AS strategy,
ceil(total * 0.2)::BIGINT AS n_test, true AS scores_agree, true AS stored, true AS in_space, true AS in_summary
FROM g WHERE n >= 50""")
def training_facts(t):
    """One model per label: which are trained, with which strategy, and that the stored model, set on the test rows
    again, has the scores that training and the summary (sorted by f1) report."""
    rows = vectors(t, F.col("label") < 3).drop("label")
    kind = t.embeddings.select(F.col("vec_id").cast("string").alias("row_id"), F.array(F.concat(F.lit("g"), F.floor(F.col("label") / 4))).alias("type"))
    folder = f"{work_folder(t.spark)}/models-{uuid.uuid4().hex}"
    table = rows.join(kind, "row_id")
    results = R.train_all_types(table, [], output_dir=folder)
    stored = R.list_models(t.spark, folder)
    summary = [r.asDict() for r in R.training_summary(results, t.spark).collect()]
    ranked = [r["f1"] for r in summary] == sorted((r["f1"] for r in summary), reverse=True) and len(summary) == len(results)
    found = []
    for name, one in results.items():
        model, about = R.load_model(t.spark, one.path)
        data = table.select(F.concat(F.lit("row:"), "row_id").alias("row_id"), "features", F.array_contains("type", name).cast("double").alias("label"))
        test = P.mark_test(data, "row_id", stratify="label").filter("is_test")
        scores = model.transform(test)
        again = {**M.binary_metrics(scores).first().asDict(), "n": test.count()}
        agree = all(abs(again[k] - v) < 1e-9 for k, v in one.metrics.items())
        kept = about["metadata"]["label"] == name and one.path.rsplit("/", 1)[1] in stored
        space = all(v[0] <= one.best_params[k] <= v[1] if isinstance(v, tuple) else one.best_params[k] in v for k, v in R.SEARCH_SPACE.items())
        line = next(r for r in summary if r["type"] == name)
        listed = ranked and all(line[k] == v for k, v in one.metrics.items()) and line["n_estimators"] == one.best_params["n_estimators"]
        found.append((name, one.minority_ratio, one.resampling.strategy, again["n"], agree, kept, space, listed))
    return t.spark.createDataFrame(
        found, "type string, minority_ratio double, strategy string, n_test bigint, scores_agree boolean, stored boolean, in_space boolean, in_summary boolean"
    )


def _split_sql(number: int) -> str:
    """The best split of every node of the rows in level `number`, and the rows of the next level."""
    return f"""c{number} AS (SELECT node, f, v, sum(n0) OVER w AS l0, sum(n1) OVER w AS l1, sum(n0) OVER a AS t0, sum(n1) OVER a AS t1
  FROM (SELECT node, f, v, sum(1 - y) AS n0, sum(y) AS n1 FROM r{number}, (SELECT unnest(range(3)) AS f), LATERAL (SELECT x[f + 1] AS v) GROUP BY ALL)
  WINDOW w AS (PARTITION BY node, f ORDER BY v), a AS (PARTITION BY node, f)),
g{number} AS (SELECT node, f, v, l0, l1, t0, t1, w0 * t0 * w1 * t1 / (w0 * t0 + w1 * t1) - w0 * l0 * w1 * l1 / (w0 * l0 + w1 * l1)
  - w0 * (t0 - l0) * w1 * (t1 - l1) / (w0 * (t0 - l0) + w1 * (t1 - l1)) AS gain FROM c{number}, k
  WHERE l0 + l1 >= 2 AND t0 + t1 - l0 - l1 >= 2),
s{number} AS (SELECT * FROM g{number} QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 6) DESC, f, v) = 1),
r{number + 1} AS (SELECT 2 * node + (x[f + 1] > v)::INT AS node, x, y FROM r{number} JOIN s{number} USING (node))"""


@query(f"""WITH r1 AS MATERIALIZED (SELECT 1 AS node, [l_quantity::DOUBLE, l_discount::DOUBLE, l_tax::DOUBLE] AS x, (l_returnflag = 'R')::INT AS y FROM lineitem),
k AS (SELECT count(*) / (2.0 * sum(1 - y)) AS w0, count(*) / (2.0 * sum(y)) AS w1 FROM r1), {_split_sql(1)}, {_split_sql(2)}
SELECT node, f::INT AS feature, v AS threshold, t0::BIGINT AS n0, t1::BIGINT AS n1 FROM (FROM s1 UNION ALL FROM s2)
UNION ALL SELECT node, -1, NULL, sum(1 - y)::BIGINT, sum(y)::BIGINT FROM r3 GROUP BY node""")
def forest_first_splits(t):
    """The two first levels of a tree over all rows: the splits that lower the weighted Gini impurity most."""
    rows = t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_id"),
        array_to_vector(F.array(*[F.col(c).cast("double") for c in ("l_quantity", "l_discount", "l_tax")])).alias("features"),
        F.array(F.struct(F.lit(0).alias("label"), (F.col("l_returnflag") == "R").cast("int").alias("y"), F.lit(0).alias("fold"))).alias("entries"),
    )
    binning = G.bin_features(rows)
    blocks = G.pack_rows(rows, binning, 1)
    made = G.grow(blocks, [G.Forest(0, 1, 2, 2, 2, "all", "balanced", bootstrap=False)], binning)
    return G.node_table(made, binning).select(F.col("node").cast("int").alias("node"), "feature", "threshold", "n0", "n1")


@query("""WITH s AS (SELECT * FROM (VALUES ('balanced_subsample', 30, 2, 1), ('balanced', 30, 5, 3), ('balanced', 3, 2, 1), (NULL, 30, 12, 1)) v(class_weight, max_depth, min_split, min_leaf)),
n AS (SELECT count(*) FILTER (label < 3) AS positive, count(*) AS n FROM embeddings)
SELECT class_weight, max_depth, min_split, min_leaf, 20::BIGINT AS n_trees, CASE class_weight WHEN 'balanced_subsample' THEN 20 ELSE 1 END::BIGINT AS n_weights,
0::BIGINT AS n_broken, true AS near_all_rows,
CASE class_weight WHEN 'balanced' THEN round(n / (2.0 * positive), 9) WHEN 'balanced_subsample' THEN NULL ELSE 1.0 END AS w1 FROM s, n""")
def forest_settings(t):
    """What trees keep to under each setting: depth, rows to split, rows of leaves, and weights of all or of drawn rows."""
    rows = vectors(t, F.col("label") < 3).select("row_id", "features", F.array(F.struct(F.lit(0).alias("label"), F.col("label").cast("int").alias("y"), F.lit(0).alias("fold"))).alias("entries"))
    binning = G.bin_features(rows)
    blocks = G.pack_rows(rows, binning, 1)
    settings = [("balanced_subsample", 30, 2, 1), ("balanced", 30, 5, 3), ("balanced", 3, 2, 1), (None, 30, 12, 1)]
    trees = G.grow(blocks, [G.Forest(0, 20, depth, split, leaf, "sqrt", weight) for weight, depth, split, leaf in settings], binning)
    asked = t.spark.createDataFrame([(i, *s) for i, s in enumerate(settings)], "forest int, class_weight string, max_depth int, min_split int, min_leaf int")
    nodes = G.node_table(trees, binning).join(asked, "forest").withColumn("drawn", F.col("n0") + F.col("n1"))
    leaf, root = F.col("feature") == G.LEAF, F.col("node") == 1
    uneven = (F.col("class_weight") == "balanced_subsample") & root & (F.abs(F.col("w0") * F.col("n0") - F.col("w1") * F.col("n1")) > 1e-6 * F.col("drawn"))
    broken = (~leaf & (F.col("drawn") < F.col("min_split"))) | (leaf & (F.col("drawn") < F.col("min_leaf"))) | (F.col("node") >= 2 * F.pow(F.lit(2), "max_depth")) | uneven
    each = nodes.groupBy("forest", "tree", "w1").agg(
        F.count_if(F.coalesce(broken, F.lit(False))).alias("broken"), F.sum(F.when(root, F.col("drawn"))).alias("drawn"), F.sum(F.when(leaf, F.col("drawn"))).alias("parted")
    )
    found = each.groupBy("forest").agg(
        F.count(F.lit(1)).alias("n_trees"), F.count_distinct("w1").alias("n_weights"), F.sum(F.col("broken") + (F.col("drawn") != F.col("parted")).cast("int")).alias("n_broken"),
        (F.avg("drawn") / rows.count()).between(0.9, 1.1).alias("near_all_rows"), F.round(F.max("w1"), 9).alias("w1"),
    )
    drawn_weights = F.coalesce(F.col("class_weight") == "balanced_subsample", F.lit(False))
    return found.join(asked, "forest").drop("forest").withColumn("w1", F.when(~drawn_weights, F.col("w1")))


@query("""SELECT 4 * count(*) AS n_rows, 4 * count(*) AS n_known, 4 * count(*) AS n_between, 0::BIGINT AS n_outside FROM embeddings WHERE label = 0""")
def smote_facts(t):
    """Synthetic rows name the row they start from, and lie on the way from it to one of its five nearest rare rows."""
    rare = vectors(t, F.col("label") == 0).filter("label = 1")
    made = B.smote(rare, 4 * rare.count())
    points = write_stage(rare.select(F.col("row_id").alias("id"), vector_to_array("features").alias("features")), "points")
    near = N.nearest_neighbours(points, 5).select("id", "nid")
    base, other = points.withColumnRenamed("features", "base"), points.select(F.col("id").alias("nid"), F.col("features").alias("other"))
    split = made.select("row_id", F.split("row_id", ":")[1].alias("id"), vector_to_array("features").alias("made"))

    def way(a: str, b: str) -> Column:
        return F.sqrt(F.aggregate(F.arrays_zip(a, b), F.lit(0.0), lambda total, p: total + (p[a] - p[b]) * (p[a] - p[b])))

    met = split.join(base, "id").join(near, "id").join(other, "nid")
    detour = way("base", "made") + way("made", "other") - way("base", "other")
    each = met.groupBy("row_id").agg((F.min(detour) < 1e-6).alias("between"))
    facts = split.join(each, "row_id", "left").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("between").alias("n_known"), F.count_if("between").alias("n_between"),
        F.count_if(~F.coalesce("between", F.lit(False))).alias("n_outside"),
    )
    return facts


@query(LABEL_COUNT_SQL + """SELECT label, round(positive / n::DOUBLE, 9) AS ratio,
CASE WHEN positive / n::DOUBLE < 0.05 THEN 'smote_under' ELSE 'class_weight' END AS strategy FROM c, n""")
def older_strategies(t):
    counted = L.class_distribution(labelled_orders(t))
    return counted.select("label", F.round("ratio", 9).alias("ratio"), B.non_adaptive_column("ratio").alias("strategy"))


# --- files, continued ------------------------------------------------------------------------------------------------


def text_files(t: Tables, lines: DataFrame, folder: str, name: str) -> str:
    """Write lines, or a table as CSV with its header in every file, into files called <name>-<n>.csv."""
    made = f"{work_folder(t.spark)}/lines-{uuid.uuid4().hex}"
    if lines.columns == ["value"]:
        lines.write.text(made)
    else:
        lines.write.csv(made, header=True)
    path = t.spark._jvm.org.apache.hadoop.fs.Path
    files = path(made).getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    parts = sorted(s.getPath().toString() for s in files.listStatus(path(made)) if s.getPath().getName().startswith("part-"))
    for n, part in enumerate(parts):
        files.rename(path(part), path(f"{folder}/{name}-{n}.csv"))
    return folder


def event_lines(t: Tables, condition: str, column: str, *before: str) -> DataFrame:
    head = t.spark.createDataFrame([(x,) for x in (*before, f"time,{column}")], "value string")
    rows = t.events.filter(condition).select(F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.col("value").cast("string")).alias("value"))
    return head.coalesce(1).unionAll(rows)


@query("""SELECT ts::DATE AS date, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1""")
def weather_preamble(t):
    """Coordinate lines above the header are told apart by their content."""
    lines = event_lines(t, "true", "rain (mm)", "latitude,longitude,elevation", "13.74,100.5,7.0", "")
    one = text_files(t, lines, f"{work_folder(t.spark)}/weather-{uuid.uuid4().hex}", "weather")
    read = tables.read_weather(t.spark, one)
    return read.groupBy(F.to_date("time").alias("date")).agg(F.count("rain (mm)").alias("n"), F.round(F.sum("rain (mm)"), 4).alias("value"))


@query("""WITH s AS (SELECT CASE WHEN event_type = 'view' THEN 13.74 ELSE 13.8 END::DOUBLE AS latitude, CASE WHEN event_type = 'view' THEN 100.5 ELSE 100.6 END::DOUBLE AS longitude,
date_trunc('second', ts) AS time, event_type = 'view' AS v FROM events)
SELECT latitude, longitude, count(DISTINCT time) AS n, CASE WHEN bool_or(v) THEN count(DISTINCT time) ELSE 0 END AS n_rain, CASE WHEN bool_or(v) THEN 0 ELSE count(DISTINCT time) END AS n_wind
FROM s GROUP BY 1, 2""")
def weather_sites(t):
    """Files of two sites with different columns, put together by name; one row for each site and time."""
    folder = f"{work_folder(t.spark)}/sites-{uuid.uuid4().hex}"
    for condition, column, name in (("event_type = 'view'", "rain (mm)", "open-meteo-13.74N100.5E"), ("event_type <> 'view'", "wind_speed_10m (km/h)", "open-meteo-13.8N100.6E")):
        hours = t.events.filter(condition).select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("time"), F.col("value").alias(column))
        text_files(t, hours.repartition(4), folder, name)  # several files for each site
    read = tables.read_weather_sites(t.spark, folder)
    return read.groupBy("latitude", "longitude").agg(
        F.count(F.lit(1)).alias("n"), F.count("rain (mm)").alias("n_rain"), F.count("wind_speed_10m (km/h)").alias("n_wind")
    )


@query("""SELECT 'reports' AS source, count(*) AS n_rows FROM customer UNION ALL SELECT 'weather', count(*) FROM events""")
def extracted(t):
    weather = t.events.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), F.col("value").alias("rain (mm)"))
    read = tables.extract(t.spark, as_csv(t, C.strip_names(messy_customers(t))), as_csv(t, weather))
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("source"), "n_rows") for n, df in zip(("reports", "weather"), read, strict=True)]
    return parts[0].unionAll(parts[1])


@query(DAILY_SQL + """SELECT date, round(max(price), 4) AS price, count(*) AS n, count(*) AS n_csv FROM m GROUP BY 1""")
def merged_again(t):
    """The merged table as written, in both formats."""
    paths = sinks.save_merged(daily_merged(t), f"{work_folder(t.spark)}/merged-{uuid.uuid4().hex}")
    read = tables.read_merged(t.spark, paths["parquet"])
    csv = t.spark.read.csv(paths["csv"], header=True).groupBy(F.to_date("date").alias("date")).agg(F.count(F.lit(1)).alias("n_csv"))
    return read.groupBy("date").agg(F.round(F.max("price"), 4).alias("price"), F.count(F.lit(1)).alias("n")).join(csv, "date")


@query("""SELECT o_orderdate::DATE AS date, count(*) AS n FROM orders GROUP BY 1""")
def saved_aggregations(t):
    folder = f"{work_folder(t.spark)}/summaries-{uuid.uuid4().hex}"
    path = sinks.save_aggregations({"by_date": A.counts_by(t.orders, F.to_date("o_orderdate"), "date")}, folder)["by_date"]
    return t.spark.read.csv(path, header=True).select(F.to_date("date").alias("date"), big(F.col("n")).alias("n"))


@query("""SELECT count(*) AS n_rows, true AS both_written, true AS shares_agree FROM orders""")
def saved_sizes(t):
    folder = f"{work_folder(t.spark)}/all-{uuid.uuid4().hex}"
    sizes = sinks.save_all(t.orders, {"by_status": A.counts_by(t.orders, "o_orderstatus")}, folder)
    n = tables.read_merged(t.spark, f"{folder}/merged.parquet").agg(F.count(F.lit(1)).alias("n_rows"))
    wanted = (1 - F.col("parquet_mb") / F.col("csv_mb")) * 100
    return one_row(n, sizes).select(
        "n_rows", ((F.col("csv_mb") > 0) & (F.col("parquet_mb") > 0)).alias("both_written"), (F.abs(F.col("percent_smaller") - wanted) < 1e-6).alias("shares_agree")
    )


@query("""SELECT 0 AS step, 'raw' AS stage, count(*) AS n_rows FROM customer UNION ALL
SELECT 1, 'clean', count(*) FROM customer WHERE c_nationkey >= 3 AND c_acctbal BETWEEN 0 AND 9000 AND c_mktsegment = 'BUILDING'""")
def cleaned_file(t):
    target = f"{work_folder(t.spark)}/clean-{uuid.uuid4().hex}"
    return batch.clean_file(t.spark, as_csv(t, C.strip_names(messy_customers(t))), target, "BUILDING")


@query(f"""WITH r AS (SELECT *, o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AS clean, len(labels) > 0 AS labelled, year(o_orderdate) <> 1998 AS weather FROM {ORDER_LABELS})
SELECT 0 AS step, 'raw' AS stage, count(*) AS n_rows FROM r UNION ALL SELECT 1, 'clean', count(*) FROM r WHERE clean UNION ALL SELECT 2, 'merged', count(*) FROM r WHERE clean
UNION ALL SELECT 3, 'labelled', count(*) FROM r WHERE clean AND labelled UNION ALL SELECT 4, 'with weather', count(*) FROM r WHERE clean AND labelled AND weather""")
def batch_funnel(t):
    """The whole batch job from files to the feature table, and the rows that each of its stages let through."""
    reports = order_labels(t).select(
        F.col("o_orderkey").alias("ticket_id"), "type", F.lit("100.5,13.7").alias("coords"),
        F.when(F.col("o_orderkey") % 11 == 0, "NULL").otherwise(F.concat(F.lit("d"), F.col("o_custkey") % 25)).alias("district"),
        F.when(F.col("o_orderkey") % 7 == 0, "elsewhere").otherwise(C.PROVINCE).alias("province"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )
    days = t.orders.filter(F.year("o_orderdate") != 1998).select(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("time")).distinct()
    weather = days.select("time", F.lit("20").alias("temperature_2m (°C)"), F.lit("1").alias("rain (mm)"), F.lit("2").alias("wind_speed_10m (km/h)"))
    folder = f"{work_folder(t.spark)}/batch-{uuid.uuid4().hex}"
    return batch.run(t.spark, as_csv(t, reports), as_csv(t, weather), None, folder, skip_training=True)["funnel"]


@query(ORACLE["prepared_table"])
def final_table(t):
    """The feature table as written and read again."""
    path = sinks.save_parquet(QUERIES["prepared_table"](t.spark, t.folder), f"{work_folder(t.spark)}/final-{uuid.uuid4().hex}")
    return t.spark.read.parquet(path)


@query(f"""SELECT o_orderkey, '{{' || array_to_string(labels, ', ') || '}}' AS type FROM {ORDER_LABELS} WHERE len(labels) > 0""")
def lists_as_text(t):
    path = sinks.save_csv(labelled_orders(t).select("o_orderkey", "type"), f"{work_folder(t.spark)}/lists-{uuid.uuid4().hex}")
    read = tables.read_reports(t.spark, path, multi_line=False)
    return read.select(big(F.col("o_orderkey")).alias("o_orderkey"), "type")


@query("""SELECT 'value' AS column_name, round(avg(value), 6) AS mean FROM events""")
def named_fallback(t):
    name = C.first_existing(t.events, "temperature_2m (°C)", "temperature_2m", "value")
    return t.events.agg(F.round(F.avg(name), 6).alias("mean")).select(F.lit(name).alias("column_name"), "mean")
