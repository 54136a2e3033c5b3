"""A pipeline over `documents`: each stage works on all rows that the one before it kept.

All stages but the last return the columns of documents; the last returns the mix. Nulls, empty and very long texts, repeated
rows, empty tables and extra columns have the results that each operator's docstring states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import contamination, lines, mixing, near, toxicity
from changeloom.llm.tables import read, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not call toxic."""
    return toxicity.reject(docs, read(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier line repeats; n_chars follows the text."""
    found = lines.dedup(docs).select([F.col(f"`{c}`") for c in docs.columns] + ["n_removed"])
    if "n_chars" not in docs.columns:
        return found.drop("n_removed")
    size = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(dict(docs.dtypes)["n_chars"])
    return found.withColumn("n_chars", size).drop("n_removed")


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near.dedup(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no window of the benchmark."""
    return contamination.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix over what is left: one row per document with the words that the mix takes of it."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontamination", decontaminate),
    ("mix_sources", mix_sources),
]
#: The first stage fits a classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
