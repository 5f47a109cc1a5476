"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
FIXED_CELL_BYTES = 16
HOT_SHARE = 0.005
HOT_ROWS = 1_000_000
SALTS = 128
SAMPLED_KEYS = 500_000


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE, min_rows: int = HOT_ROWS) -> list[int]:
    """xxhash64 of the keys that hold about `share` of the rows or more, and at least min_rows rows.

    They are estimated from a sample of the keys alone; at most 1/(0.8 share) of them can pass. A miss
    or a false alarm changes only how rows are spread, never a result.
    """
    n = df.count()
    if n < min_rows:
        return []
    fraction = min(1.0, SAMPLED_KEYS / n)
    least = 0.8 * max(share * n, min_rows) * fraction
    counted = df.select(F.xxhash64(*on).alias("kh")).sample(fraction, seed=1).groupBy("kh").count()
    return [r["kh"] for r in counted.filter(F.col("count") >= least).collect()]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
    salts: int = SALTS,
    rows: int | None = None,
) -> DataFrame:
    """Inner or left join; rows of hot left keys are spread over `salts` tasks.

    Only the right rows of hot keys are repeated, so the extra volume is (hot keys) x salts rows. A
    caller that knows a bound on the left rows passes it: below min_rows no key can be hot.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left")
    on = list(on)
    hot = [] if rows is not None and rows < min_rows else hot_keys(left, on, share, min_rows)
    if not hot:
        return left.join(right, on, how)
    is_hot = F.xxhash64(*on).isin(hot)
    # A row's number, not its content: equal rows of a hot key must spread as well.
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    repeat = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_left = left.withColumn("_salt", F.when(is_hot, spread).otherwise(F.lit(0)))
    salted_right = right.withColumn("_salt", F.explode(repeat))
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def fits_broadcast(df: DataFrame, on: Sequence[str], max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has been counted to have at most max_rows rows and about BROADCAST_BYTES.

    The row count reads the key columns alone; text and nested columns are measured only if it passes.
    """
    rows = df.select(*on).limit(max_rows + 1).count()
    if rows > max_rows:
        return False
    wide = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.BooleanType))]
    size = rows * FIXED_CELL_BYTES * len(df.columns)
    if wide:
        texts = [F.sum(F.octet_length(F.to_json(F.struct(df[f"`{c}`"])))) for c in wide]
        size += sum(v or 0 for v in df.agg(*texts).first())
    return size <= BROADCAST_BYTES


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    **salting,
) -> DataFrame:
    """Join a large table with a table that is usually small.

    The right side is broadcast only after it has been measured; a larger one is joined through the
    salted shuffle.
    """
    on = list(on)
    if fits_broadcast(right, on, max_rows):
        return left.join(F.broadcast(right), on, how)
    return salted_join(left, right, on, how, **salting)
