"""Label sets: parsing, multi-hot columns, frequencies, trainable labels; and one-hot districts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import functions as vectors
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.scalars import cyclical, parse_time, strip, time_parts
from ..session import write_stage
from .clean import quoted
from .indexing import add_dense_index
from .skew import salted_join

# Fixed value: text for reports without a label ("not specified").
NO_LABEL = "ไม่ระบุ"
MAX_COLUMNS = 5_000
#: Values of a column that may become places of a sparse vector; their names fit a driver.
MAX_SPARSE = 1_000_000


def _items(text: Column) -> Column:
    return F.transform(F.split(text, ",", -1), strip)


def has_labels(c: Column) -> Column:
    """Whether '{..}' text holds anything but white space."""
    return F.coalesce(F.length(strip(F.btrim(c, F.lit("{}")))) > 0, F.lit(False))


def label_list(c: Column) -> Column:
    """'{a, b}' to ['a', 'b']; blank or NULL to []; empty items between commas stay."""
    return F.when(has_labels(c), _items(F.btrim(c, F.lit("{}")))).otherwise(F.array().cast("array<string>"))


def label_list_marked(c: Column, marker: str = NO_LABEL) -> Column:
    """As the exploratory cleaning does: '{}' and the marker are [], other text is split as it stands."""
    blank = c.isNull() | c.isin("{}", marker)
    return F.when(blank, F.array().cast("array<string>")).otherwise(_items(F.btrim(c, F.lit("{}"))))


def label_list_without_braces(c: Column) -> Column:
    """As the map page does: all braces are removed wherever they are."""
    return _items(F.regexp_replace(c, "[{}]", ""))


def parse_type_column(df: DataFrame, column: str = "type") -> DataFrame:
    """Text to a list; a column that already is a list stays as it is."""
    if dict(df.dtypes)[column].startswith("array"):
        return df
    return df.withColumn(column, label_list(F.col(column)))


def filter_empty_types(df: DataFrame, column: str = "type") -> DataFrame:
    """Keep rows with labels. On text that is not parsed yet this spares parsing every row twice."""
    c = F.col(column)
    return df.filter(F.size(c) > 0 if dict(df.dtypes)[column].startswith("array") else has_labels(c))


class TooManyValues(ValueError):
    """A column has more values than there can be columns."""

    def __init__(self, name: str, most: int):
        super().__init__(f"{name} has more than {most} values; keep it as a list or a sparse vector instead of columns")
        self.name = name


def vocabularies(df: DataFrame, columns: Sequence[str], max_columns: int = MAX_COLUMNS) -> dict[str, list[str]]:
    """Sorted distinct values of several text or list columns in one pass, refused beyond max_columns each."""
    kinds = dict(df.dtypes)

    def tagged(name: str) -> Column:
        values = quoted(name) if kinds[name].startswith("array") else F.array(quoted(name))
        values = F.coalesce(values, F.array().cast("array<string>"))
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("c"), v.alias("v")))

    pairs = df.select(F.explode(F.concat(*map(tagged, columns))).alias("p")).select("p.*").filter("v is not null").distinct()
    found: dict[str, list[str]] = {name: [] for name in columns}
    for r in pairs.limit(max_columns * len(columns) + 1).collect():
        found[r["c"]].append(r["v"])
    # If the read ended at its bound, the column with most values is one that has too many.
    most = max(found, key=lambda name: len(found[name]))
    if len(found[most]) > max_columns:
        raise TooManyValues(most, max_columns)
    return {name: sorted(values) for name, values in found.items()}


def vocabulary(df: DataFrame, column: str, max_columns: int = MAX_COLUMNS) -> list[str]:
    return vocabularies(df, [column], max_columns)[column]


def sparse_values(df: DataFrame, column: str, output: str, max_values: int = MAX_SPARSE) -> tuple[DataFrame, list[str]]:
    """Add a sparse 0/1 vector of a text or list column, for more values than there can be columns.

    The place of each value is its place in the returned vocabulary, most frequent first. A NULL or
    empty cell is the empty vector. More than max_values values are refused, never cut; encode_by_table
    takes any number of them.
    """
    listed = quoted(column) if dict(df.dtypes)[column].startswith("array") else F.array(quoted(column))
    known = F.filter(F.coalesce(listed, F.array().cast("array<string>")), lambda v: v.isNotNull())
    counted = CountVectorizer(inputCol="_values", outputCol=output, binary=True, vocabSize=max_values + 1)
    listed_rows = df.withColumn("_values", known)
    if listed_rows.filter(F.size("_values") > 0).isEmpty():
        return df.withColumn(output, vectors.array_to_vector(F.array(F.lit(0.0)))), [""]
    model = counted.fit(listed_rows)
    if len(model.vocabulary) > max_values:
        raise TooManyValues(column, max_values)
    return model.transform(listed_rows).drop("_values"), model.vocabulary


def value_table(df: DataFrame, column: str) -> DataFrame:
    """(value, place): the distinct values of a text or list column, numbered from 0 in the order of their md5.

    The values stay a table, however many there are.
    """
    listed = quoted(column) if dict(df.dtypes)[column].startswith("array") else F.array(quoted(column))
    values = df.select(F.explode(listed).alias("value")).filter("value is not null").distinct()
    key = F.conv(F.substring(F.md5(F.col("value").cast("binary")), 1, 15), 16, 10).cast("bigint")
    keyed = write_stage(values.withColumn("key", key), "values")
    return write_stage(add_dense_index(keyed, "key", "place", ("value",)).select("value", "place"), "vocabulary")


def encode_by_table(df: DataFrame, column: str, output: str, id_column: str) -> tuple[DataFrame, DataFrame]:
    """(df with `output`, a sparse 0/1 vector of a text or list column, and `output`_places; the value_table).

    For any number of values below 2^31: rows meet the vocabulary in a join, in which frequent values are
    salted. A NULL or empty cell is the empty vector. Row ids must be unique.
    """
    table = value_table(df, column)
    size = table.count()
    listed = quoted(column) if dict(df.dtypes)[column].startswith("array") else F.array(quoted(column))
    each = df.select(quoted(id_column).alias("_id"), F.explode(F.array_distinct(listed)).alias("value")).filter("value is not null")
    met = salted_join(each, table, ["value"], "inner").groupBy("_id").agg(F.sort_array(F.collect_list(F.col("place").cast("int"))).alias("_places"))
    joined = df.join(met, quoted(id_column) == F.col("_id"), "left").drop("_id")
    places = F.coalesce("_places", F.array().cast("array<int>"))
    joined = joined.withColumn(f"{output}_places", places).drop("_places")
    return joined.withColumn(output, _sparse_vector(size, F.col(f"`{output}_places`"))), table


def _sparse_vector(size: int, places: Column) -> Column:
    """A sparse vector with ones; Spark reads the parts of the vector type from JSON without leaving the JVM."""
    kind = StructType([StructField("v", VectorUDT())])
    ones = F.transform(places, lambda _: F.lit(1.0))
    parts = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(max(1, size)).alias("size"), places.alias("indices"), ones.alias("values"))
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), kind)["v"]


def vector_parts(vector: Column) -> Column:
    """(size, indices, values) of a vector as it is stored: indices and values of a sparse one, without its zeros."""
    kind = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    parts = F.from_json(F.to_json(F.struct(vector.alias("v"))), f"struct<v: {kind}>")["v"]
    size = F.when(parts["type"] == 0, parts["size"]).otherwise(F.size(parts["values"]))
    return F.when(vector.isNotNull(), F.struct(size.alias("size"), parts["indices"].alias("indices"), parts["values"].alias("values")))


def create_binary_targets(df: DataFrame, column: str = "type", labels: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """One 0/1 column type_<label> per label, in one projection."""
    labels = vocabulary(df, column) if labels is None else list(labels)
    hot = {f"type_{v}": F.coalesce(F.array_contains(column, v), F.lit(False)).cast("int") for v in labels}
    return df.select("*", *[e.alias(n) for n, e in hot.items()]), list(hot)


def encode_districts(df: DataFrame, column: str = "district", values: Sequence[str] | None = None) -> DataFrame:
    """One 0/1 column district_<value> per value; NULL is 0 everywhere; no column, no change."""
    if column not in df.columns:
        return df
    values = vocabulary(df, column) if values is None else values
    return df.select("*", *[quoted(column).eqNullSafe(F.lit(v)).cast("int").alias(f"district_{v}") for v in values])


def extract_time_features(df: DataFrame, column: str = "timestamp") -> DataFrame:
    t = parse_time(quoted(column)) if dict(df.dtypes)[column] == "string" else quoted(column)
    df = df.withColumn("timestamp_col", t)
    return df.withColumns(time_parts("timestamp_col"))


def encode_cyclical_features(df: DataFrame) -> DataFrame:
    return df.withColumns(cyclical(F.col("hour"), F.col("day_of_week"), F.col("month")))


def prepare_features(df: DataFrame, timestamp_col: str = "timestamp", district_col: str = "district", districts: Sequence[str] | None = None) -> DataFrame:
    """Time parts, their cyclical encoding, and districts."""
    return encode_districts(encode_cyclical_features(extract_time_features(df, timestamp_col)), district_col, districts)


def label_counts(df: DataFrame, column: str = "type") -> DataFrame:
    """(label, positive, percent) for all labels in one pass over the lists, most frequent first."""
    total = df.agg(F.count(F.lit(1))).scalar()
    counted = df.select(F.explode(F.array_distinct(column)).alias("label")).groupBy("label").count()
    return counted.select(
        "label", F.col("count").alias("positive"), (F.col("count") * 100.0 / total).alias("percent")
    ).orderBy(F.desc("positive"), "label")


def class_distribution(df: DataFrame, column: str = "type", first: int | None = None) -> DataFrame:
    """positive, negative, ratio and imbalance (negatives per positive) of each label."""
    total = df.agg(F.count(F.lit(1))).scalar()
    negative = F.col("total") - F.col("positive")
    out = (
        label_counts(df, column)
        .withColumn("total", total)
        .select(
            "label",
            "positive",
            negative.alias("negative"),
            (F.col("positive") / F.col("total")).alias("ratio"),
            F.when(F.col("positive") == 0, F.lit(float("inf"))).otherwise(negative / F.col("positive")).alias("imbalance"),
        )
        .orderBy(F.desc("positive"), "label")
    )
    return out if first is None else out.limit(first)


def resampling_strategy(ratio: Column, high: float = 0.15, low: float = 0.05) -> Column:
    """class_weight from 15% positives, undersampling from 5%, otherwise smote_under."""
    return F.when(ratio >= high, "class_weight").when(ratio >= low, "undersampling").otherwise("smote_under")


def trainable_flags(df: DataFrame, column: str = "type", min_samples: int = 50) -> DataFrame:
    """Every label with its count, whether it has enough positives, and its resampling strategy."""
    return class_distribution(df, column).select(
        "label",
        "positive",
        (F.col("positive") >= min_samples).alias("trainable"),
        resampling_strategy(F.col("ratio")).alias("strategy"),
    )


def trainable_types(df: DataFrame, column: str = "type", min_samples: int = 50) -> list[str]:
    """Labels with enough positives, most frequent first."""
    kept = trainable_flags(df, column, min_samples).filter("trainable").orderBy(F.desc("positive"), "label")
    return [r["label"] for r in kept.select("label").collect()]


def top_labels_by(df: DataFrame, key: str, column: str = "type", k: int = 10, salts: int = 32) -> DataFrame:
    """(key, label, n, rank): the k most frequent labels of every value of key, ties in order of the label.

    Labels of one value compete in `salts` groups first, so that a value with very many labels is ranked by
    many tasks; NULL keys are left out.
    """
    each = df.select(quoted(key).alias(key), F.explode(F.array_distinct(column)).alias("label")).filter(quoted(key).isNotNull() & F.col("label").isNotNull())
    counted = each.groupBy(quoted(key), "label").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.col("label")]
    salted = counted.withColumn("_salt", F.pmod(F.xxhash64("label"), F.lit(salts)))
    first = salted.withColumn("_r", F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order))).filter(F.col("_r") <= k)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select(key, "label", "n", "rank")
