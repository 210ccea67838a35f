"""Helpers that the corpus operators share."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factprep.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = re.compile(r"[^\W_]+")
LEAST_LONG = -(2**63)
BATCH_BYTES = 4 << 20
#: Most labelled documents that a classifier learns from.
LABELLED = 1 << 18


def bounded_batches(spark: SparkSession) -> None:
    """Texts travel to Python in batches of at most BATCH_BYTES, or one text, whatever their length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{root}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again: cuts the lineage."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the column's text, modulo; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def labelled(docs: DataFrame, labels: DataFrame, label: str, divisor: int = 5, most: int = LABELLED) -> DataFrame:
    """(text, __label) of the documents that may be learned from.

    A document labelled more than once counts once, with its largest label. Of more
    than ``most`` labelled documents, those that come first by hash are taken, so
    that the labels can be sent to the texts instead of the texts to them.
    """
    known = (
        labels.filter(F.col(label).isin(0, 1) & (remainder("doc_id", divisor) != 0))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("__label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    return docs.select("doc_id", "text").join(F.broadcast(stored(known, "labels")), "doc_id").select("text", "__label")


def word_tokens(text: str) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return WORD.findall(text.lower())


def longs(values: Iterable[int]) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])
