"""Cleaning, filtering and column selection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import to_number

# Columns that cleaning leaves out.
UNUSED_COLUMNS = (
    "ticket_id", "organization", "photo", "photo_after", "address", "state", "star", "count_reopen", "last_activity",
)
# Fixed value: the province kept by default.
PROVINCE = "กรุงเทพมหานคร"
# Weather columns that must be present after preprocessing.
NEEDED_WEATHER = ("temperature_2m (°C)", "rain (mm)", "wind_speed_10m (km/h)")
# Cell texts that a pandas reader takes for missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def quoted(name: str) -> Column:
    """Column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def columns_containing(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part.lower() in c.lower()]


def first_existing(df: DataFrame, *names: str) -> str | None:
    return next((n for n in names if n in df.columns), None)


def strip_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def rename_if_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_columns(df: DataFrame, names: Sequence[str] = UNUSED_COLUMNS) -> DataFrame:
    """Columns that do not exist are ignored."""
    return df.drop(*names)


def null_tokens_to_null(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """One projection; must run before any typed comparison."""
    texts = set(text_columns(df))
    return df.select(
        *[
            (F.when(~quoted(c).isin(*tokens), quoted(c)) if c in texts else quoted(c)).alias(c)
            for c in df.columns
        ]
    )


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL or NaN in any column, or in any of `subset`."""
    kinds = dict(df.dtypes)
    present = [
        quoted(c).isNotNull() & (~F.isnan(quoted(c)) if kinds[c] in ("double", "float") else F.lit(True))
        for c in (df.columns if subset is None else subset)
    ]
    return df.filter(reduce(lambda a, b: a & b, present, F.lit(True)))


def clean_reports(df: DataFrame, drop: Sequence[str] | None = None, province: str | None = PROVINCE) -> DataFrame:
    """Drop unused columns, then incomplete rows, then other provinces (province=None keeps all)."""
    kept = drop_incomplete(drop_columns(df, UNUSED_COLUMNS if drop is None else drop))
    return kept if province is None else kept.filter(F.col("province") == F.lit(province))


def drop_missing_weather(df: DataFrame, columns: Sequence[str] = NEEDED_WEATHER) -> DataFrame:
    return drop_incomplete(df, columns)


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to DOUBLE with bad values as NULL; absent columns are skipped."""
    return df.withColumns({c: to_number(quoted(c)) for c in columns if c in df.columns})


def spaces_to_null(df: DataFrame) -> DataFrame:
    """A cell that is exactly one space becomes NULL."""
    return df.withColumns({c: F.when(quoted(c) != " ", quoted(c)) for c in text_columns(df)})


def has_space_cell(df: DataFrame) -> Column:
    cells = [F.coalesce(quoted(c) == " ", F.lit(False)) for c in text_columns(df)]
    return reduce(lambda a, b: a | b, cells, F.lit(False))


def rows_with_space(df: DataFrame) -> DataFrame:
    return df.filter(has_space_cell(df))


def space_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_space) for every column, and the number of affected rows as '*', in one pass."""
    texts = set(text_columns(df))
    counts = {c: F.count_if(quoted(c) == " ") if c in texts else F.lit(0).cast("bigint") for c in df.columns}
    one = df.agg(*[e.alias(c) for c, e in counts.items()], F.count_if(has_space_cell(df)).alias("*"))
    return one.unpivot([], [quoted(c) for c in one.columns], "column_name", "n_space")


def non_null_counts(df: DataFrame) -> DataFrame:
    """(column_name, data_type, n_non_null) for every column, in one pass."""
    one = df.agg(*[F.count(quoted(c)).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    long = one.unpivot([], [quoted(c) for c in one.columns], "column_name", "n_non_null")
    return long.select("column_name", types[F.col("column_name")].alias("data_type"), "n_non_null")


def between_dates(df: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """Both ends included. Written on the bare column, so that the scan can skip row groups."""
    t = F.col(column)
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return df.filter(t.between(F.lit(start), F.lit(end)))
    return df.filter((t >= F.lit(start).cast(kind)) & (t < F.date_add(F.lit(end), 1).cast(kind)))


def in_year(df: DataFrame, column: str, year: int) -> DataFrame:
    return between_dates(df, column, date(year, 1, 1), date(year, 12, 31))


def equals_unless_all(df: DataFrame, column: str, value: str | None, all_value: str = "All") -> DataFrame:
    return df if value is None or value == all_value else df.filter(F.col(column) == value)


def any_label(df: DataFrame, labels: Sequence[str], types_column: str = "types") -> DataFrame:
    return df.filter(F.arrays_overlap(F.col(types_column), F.array(*[F.lit(x) for x in labels])))


def trailing_days(df: DataFrame, date_column: str, days: int = 365) -> DataFrame:
    """Rows whose day is within `days` of the latest; the bound is a scalar subquery that the scan can use."""
    latest = df.agg(F.max(date_column)).scalar()
    return df.filter(F.col(date_column) >= F.date_sub(latest, days).cast(df.schema[date_column].dataType))


def known(df: DataFrame, column: str) -> Column:
    """The column with NaN as NULL."""
    floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return F.when(~F.isnan(quoted(column)), quoted(column)) if floating else quoted(column)


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """0 for NULL and NaN."""
    names = numeric_columns(df) if columns is None else columns
    return df.withColumns({c: F.coalesce(known(df, c), F.lit(0)) for c in names})


def valid_and_invalid(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    return df.filter(quoted(column).isNotNull()), df.filter(quoted(column).isNull())
