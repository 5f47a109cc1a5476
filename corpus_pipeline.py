"""Documents to packed training sequences: five stages, each one operator over all that the stage before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm import line_dedup, near_duplicates, packing, quality, toxicity
from wardlight.session import write_stage

#: Least similarity of near duplicates, in percent of the union of their five-word shingles.
SIMILAR = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5; the model is fitted on labelled documents that are not held out."""
    net = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, net)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.drop_rejected(docs)


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of lines that stand at an earlier place too; n_chars follows the text."""
    out = line_dedup.delete_repeats(docs, counts=False)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return near_duplicates.drop_near_duplicates(docs, percent=SIMILAR)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("line_dedup", delete_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("best_fit_packing", pack_sequences),
]
#: A trained network and a tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
