"""The batch job: read, clean, enrich, prepare features and targets, train, summarise."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import parse_time, split_coordinates
from ..operators import aggregates, clean, enrich, forest, labels, sampling
from ..sources import sinks, tables


@dataclass
class Prepared:
    """Features and targets; `vectors` names the sparse columns and the values of their places."""

    table: DataFrame
    type_columns: list[str]
    vectors: dict[str, list[str] | DataFrame] = field(default_factory=dict)


class Funnel:
    """Row counts of the stages of a job, observed while the tables are written rather than counted apart."""

    def __init__(self):
        self.seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, stage: str) -> DataFrame:
        """df itself; its rows are counted by the first job that reads it."""
        self.seen[stage] = Observation(stage)
        return df.observe(self.seen[stage], F.count(F.lit(1)).alias("n_rows"))

    def table(self, spark: SparkSession) -> DataFrame:
        """(step, stage, n_rows) in the order of the stages, once the job has run."""
        rows = [(i, stage, seen.get["n_rows"]) for i, (stage, seen) in enumerate(self.seen.items())]
        return spark.createDataFrame(rows, "step int, stage string, n_rows bigint")


def merge(
    reports: DataFrame, weather: DataFrame, air: DataFrame | None = None, zone: str | None = None, province: str | None = clean.PROVINCE,
    funnel: Funnel | None = None,
) -> DataFrame:
    """Cleaned reports with coordinates and date, joined with daily weather and air quality."""
    watch = (funnel or Funnel()).watch
    kept = watch(split_coordinates(clean.clean_reports(watch(reports, "raw"), province=province)), "clean")
    dated = enrich.add_date(kept.withColumn("timestamp", parse_time("timestamp")), "timestamp", zone)
    return enrich.enrich_daily(dated, enrich.daily_mean(weather), air)


def add_row_id(df: DataFrame) -> DataFrame:
    """A number per row, unique without a shuffle. It becomes stable when the table is written."""
    return df.withColumn("row_id", F.monotonically_increasing_id())


def prepare(merged: DataFrame, sample_size: int | None = None, id_column: str = "row_id", seed: int = 42, types: Sequence[str] | None = None, districts: Sequence[str] | None = None, funnel: Funnel | None = None) -> Prepared:
    """Label lists, complete weather, optional exact sample, features and 0/1 targets.

    Both vocabularies come from the rows that are left; pass them in to fix the columns across runs. A
    column with more values than there can be columns becomes a sparse vector, district_vector or
    type_vector; with more than a driver holds the names, its vocabulary is a table.
    """
    watch = (funnel or Funnel()).watch
    df = labels.parse_type_column(labels.filter_empty_types(clean.strip_names(watch(merged, "merged"))))
    df = clean.drop_missing_weather(watch(df, "labelled"), [c for c in clean.NEEDED_WEATHER if c in df.columns])
    df = watch(df, "with weather")
    if sample_size is not None:
        df = watch(sampling.sample_data(df, id_column, sample_size, seed), "sampled")
    unknown = [c for c, known in (("type", types), ("district", districts)) if known is None and c in df.columns]
    sparse: dict[str, list[str]] = {}
    while unknown:
        try:
            found = labels.vocabularies(df, unknown)
            types, districts = found.get("type", types), found.get("district", districts)
            break
        except labels.TooManyValues as many:
            unknown.remove(many.name)
            try:
                df, sparse[f"{many.name}_vector"] = labels.sparse_values(df, many.name, f"{many.name}_vector")
            except labels.TooManyValues:
                df, sparse[f"{many.name}_vector"] = labels.encode_by_table(df, many.name, f"{many.name}_vector", id_column)
            types, districts = ([] if many.name == "type" else types), ([] if many.name == "district" else districts)
    df = labels.prepare_features(df, districts=districts)
    table, type_columns = labels.create_binary_targets(df, labels=types)
    return Prepared(table, type_columns, sparse)


def run(
    spark: SparkSession,
    reports_path: str,
    weather_path: str,
    air_path: str | None,
    output: str,
    skip_etl: bool = False,
    skip_training: bool = False,
    sample_size: int | None = None,
    n_iter: int = 5,
    min_samples: int = 50,
    province: str | None = clean.PROVINCE,
    zone: str | None = None,
    space: dict | None = None,
) -> dict[str, DataFrame]:
    """Everything from files to the training summary; every stage restarts from a written table."""
    merged_path, funnel = f"{output}/processed/merged.parquet", Funnel()
    if not skip_etl:
        reports = tables.read_reports(spark, reports_path)
        weather = tables.read_weather(spark, weather_path)
        air = tables.read_air_quality_if_present(spark, air_path)
        merged = merge(reports, weather, air, zone, province, funnel)
        sinks.save_merged(add_row_id(merged), f"{output}/processed")
    merged = tables.read_merged(spark, merged_path)

    prepared = prepare(merged, sample_size, funnel=funnel)
    final_path = sinks.save_parquet(prepared.table, f"{output}/processed/final.parquet")
    final = spark.read.parquet(final_path)
    temperature = clean.first_existing(final, "temperature_2m (°C)", "temperature_2m")
    out = {"final": final, "label_counts": labels.label_counts(final), "funnel": funnel.table(spark)}
    if temperature:
        out["quality"] = enrich.join_quality(final, temperature)
    summaries = {"funnel": out["funnel"], "by_date": aggregates.counts_by(final, "date"), "by_hour": aggregates.counts_by(final, "hour")}
    if "district" in final.columns:
        summaries["by_district"] = aggregates.counts_by(final, "district")
    sinks.save_aggregations(summaries, f"{output}/processed")
    if skip_training:
        return out

    names = forest.feature_columns(final, prepared.type_columns, ["row_id"])
    places = prepared.vectors.get("district_vector", [])
    if isinstance(places, DataFrame):  # too many districts for features of their own
        places = []
    assembled = forest.assemble(final, "row_id", names, ["type"], ["district_vector"] if places else [])
    names = [*names, *[f"district_{v}" for v in places]]
    results = forest.train_all_types(assembled, names, n_iter, min_samples, f"{output}/models", space=space, keep_models=False)
    summary = forest.training_summary(results, spark)
    sinks.save_csv(summary, f"{output}/models/training_summary")
    return {**out, "summary": summary}


def clean_file(spark: SparkSession, source: str, target: str, province: str | None = clean.PROVINCE) -> DataFrame:
    """Read, clean and write one report file; returns the row counts before and after."""
    raw = tables.read_reports(spark, source)
    sinks.save_csv(clean.clean_reports(raw, province=province), target)
    written = spark.read.csv(target, header=True, multiLine=True, escape='"')
    return aggregates.stage_counts({"raw": raw, "clean": written})
