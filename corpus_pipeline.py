"""A corpus pipeline of five stages, each one of the corpus operators.

Every stage takes the documents that the one before has kept, written as Parquet
and read again. A null or empty text passes through the stages like any other
until a stage rejects it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factprep.llm import decontaminate, line_dedup, packing, quality, simhash
from factprep.llm.common import bounded_batches, labelled, table
from factprep.session import scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit(labelled(docs, table(spark, sf_dir, "labels"), "quality"))
    return quality.with_scores(docs, model, score="__score").filter("__score >= 0.3").drop("__score")


def without_copied_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of later copies; those of which nothing is left go."""
    bounded_batches(spark)
    done = line_dedup.without_copies(docs, deleted="__deleted", lines="__lines")
    left = done.filter((F.size("__deleted") == 0) | (F.length("text") > 0))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group."""
    bounded_batches(spark)
    return simhash.first_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    bounded_batches(spark)
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_copied_lines),
    ("SimHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed_sequences),
]

#: The stages can't be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
