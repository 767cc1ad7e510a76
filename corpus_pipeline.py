"""A corpus from raw documents to a training mix, in five stages.

Each stage takes all that its predecessor kept, written as Parquet in the
shared folder and read again, so a lost executor or a restart repeats a stage
at most.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from flagstone.llm.common import save
from flagstone.llm.decontam import decontaminate
from flagstone.llm.linededup import drop_repeated_lines
from flagstone.llm.mixing import mixed_documents
from flagstone.llm.quality import keep_good
from flagstone.llm.simhash import drop_near_copies


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(docs, _table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of repeated three-line windows."""
    return drop_repeated_lines(docs, window=3)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs, shingle=3, radius=3)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"), window=13, share=20)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the number of times (``epochs``) each is taken."""
    return mixed_documents(docs, cycle=(5, 2, 1), max_epochs=3)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark),
    ("mixing sources to target weights", mixture),
]

# The classifier is a fitted model and the fingerprints are XXH64 values, so SQL cannot give the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
