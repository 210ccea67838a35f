"""Native and Python forms of the speed, compared by a checksum, and totals of measured seconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factprep.functions.features import with_speed
from factprep.functions.udfs import speed_arrow, speed_scalar

def speed(df: DataFrame, distance: str, duration: str, mode: str, name: str = "speed") -> DataFrame:
    """Add the speed in one of four forms.

    ``identity`` passes the distance through, ``native`` stays in the JVM,
    ``scalar`` and ``arrow`` call the Python function by row and by Arrow batch.
    """
    if mode == "native":
        return with_speed(df, distance, duration, name)
    forms = {
        "identity": lambda: F.col(distance),
        "scalar": lambda: speed_scalar(distance, duration),
        "arrow": lambda: speed_arrow(distance, duration),
    }
    return df.withColumn(name, forms[mode]())


def checksum(df: DataFrame, column: str | Column = "speed") -> DataFrame:
    """Sum of a column as a decimal, which does not depend on the order of rows."""
    value = F.col(column) if isinstance(column, str) else column
    return df.agg(F.sum(value.cast("decimal(28,6)")).alias("checksum"), F.count("*").alias("row_count"))


def bucket_counts(df: DataFrame, bucket: str = "bucket") -> DataFrame:
    return df.groupBy(bucket).agg(F.count("*").alias("row_count"))


def first_buckets(df: DataFrame, count: int, bucket: str = "bucket") -> DataFrame:
    """Rows of the first ``count`` non-empty buckets."""
    chosen = bucket_counts(df, bucket).orderBy(bucket).limit(count).select(bucket)
    return df.join(chosen, bucket, "left_semi")


def trial_totals(measured: DataFrame) -> DataFrame:
    """Seconds per trial over all buckets."""
    return measured.groupBy("trial").agg(
        F.sum("baseline_seconds").alias("baseline_seconds"), F.sum("udf_seconds").alias("udf_seconds")
    )


def summary(measured: DataFrame) -> DataFrame:
    """Median over trials; there are only as many rows as trials."""
    return trial_totals(measured).agg(
        F.median("baseline_seconds").alias("median_baseline_seconds"),
        F.median("udf_seconds").alias("median_udf_seconds"),
        F.count("*").alias("trials"),
    )
