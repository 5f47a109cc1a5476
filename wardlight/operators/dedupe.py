"""Duplicates and distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import grid_floor, split_coordinates
from .clean import quoted


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by `order`, remaining ties broken by the other columns.

    A minimum over a struct is combined before the shuffle, so that a key with many copies costs one
    row per map task, where a ranking window would bring all copies into one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[quoted(c) for c in (*order, *rest)])
    best = df.groupBy(*[quoted(k) for k in keys]).agg(F.min(packed).alias("_row"))
    return best.select(*[(quoted(c) if c in keys else F.col("_row")[c]).alias(c) for c in df.columns])


def grid_coordinates(df: DataFrame, coord_column: str = "coords", delta: float = 0.1) -> DataFrame:
    """Distinct (lon_bin, lat_bin) cells of the reports."""
    if "longitude" not in df.columns or "latitude" not in df.columns:
        df = split_coordinates(df, coord_column)
    return df.select(
        grid_floor("longitude", delta).alias("lon_bin"), grid_floor("latitude", delta).alias("lat_bin")
    ).distinct()


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)
