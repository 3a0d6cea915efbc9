"""From documents to packed training sequences: the stages, in order, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontaminate, language_id, line_dedup, near_dedup, packing
from millrace.llm.batches import importable
from millrace.session import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language: null texts, texts without a letter, and texts most of whose letters are
    of scripts that no labelled language has go. All documents teach; without any label all of them stay."""
    importable(spark)
    return language_id.keep_labelled(docs, language_id.fit(docs), least_known=0.5)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated runs of lines, n_chars to match; documents that lose all their lines go."""
    kept = line_dedup.without_repeats(docs).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    kept = kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest doc_id."""
    importable(spark)
    return near_dedup.one_per_class(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    importable(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontaminate", drop_benchmark),
    ("packing", pack_sequences),
]

# Language ID, near duplicates by texts that change on the way, and packing are beyond SQL; a test holds
# the rows against a brute-force run of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table documents in `sf_dir`; every stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
