"""Bucket counts, layout and skew."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sizing rule of the contract.
ROW_BYTES = 512
FEWEST_BUCKETS = 128
BUCKET_BYTES = 128 * 1024 * 1024

PARTITION_BYTES = 1 << 30
# Shuffle blocks are one for each map task and partition; fewer, larger splits keep them from getting tiny.
MOST_SPLITS = 1 << 17


def choose_count(rows: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets so that each holds about ``bucket_bytes``; a power of two, at least 128.

    For very large tables raise ``bucket_bytes``: every bucket becomes a
    directory, and Spark spills, so a bucket need not fit in memory.
    """
    if bucket_bytes <= 0:
        raise ValueError("bucket_bytes must be positive.")
    needed = max(FEWEST_BUCKETS, math.ceil(rows * ROW_BYTES / bucket_bytes))
    return 1 << (needed - 1).bit_length()


def choose_partitions(input_bytes: int, at_least: int = 1) -> int:
    """Shuffle partitions so that each takes about one GiB of uncompressed input; a power of two.

    Adaptive execution merges what turns out small. A power of two keeps
    deduplicated rows aligned with a power of two of buckets.
    """
    needed = max(1, at_least, math.ceil(input_bytes / PARTITION_BYTES))
    return 1 << (needed - 1).bit_length()


def choose_split(stored_bytes: int, at_least: int) -> int:
    """Bytes of input that one task reads, so that there are at most ``MOST_SPLITS`` of them."""
    return max(at_least, math.ceil(stored_bytes / MOST_SPLITS))


def estimated_bytes(rows: str) -> Column:
    return F.col(rows) * F.lit(ROW_BYTES)


def over_limit(counted: DataFrame, limit_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Counted buckets (``bucket``, ``row_count``) with estimated bytes and whether those exceed the limit."""
    estimate = estimated_bytes("row_count")
    return counted.select(
        "bucket", "row_count", estimate.alias("estimated_bytes"), (estimate > F.lit(limit_bytes)).alias("over_limit")
    )


def repartition_by_bucket(df: DataFrame, bucket: str = "bucket") -> DataFrame:
    """Bring rows of a bucket together for writing.

    A rebalance rather than a plain repartition: adaptive execution joins small
    buckets into one task and splits a bucket that holds far more than its
    share (many copies of one row) over several.
    """
    return df.hint("rebalance", bucket)


def skew_report(df: DataFrame, bucket: str = "bucket", limit_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Rows, estimated bytes and whether the estimate exceeds the limit, per bucket."""
    return over_limit(df.groupBy(F.col(bucket).alias("bucket")).agg(F.count("*").alias("row_count")), limit_bytes)


def require_bounded(df: DataFrame, bucket: str = "bucket", limit_bytes: int = BUCKET_BYTES) -> None:
    """Raise, naming the largest bucket, if any exceeds the limit."""
    require_within(skew_report(df, bucket, limit_bytes))


def require_within(report: DataFrame) -> None:
    worst = report.where("over_limit").orderBy(F.desc("row_count"), "bucket").take(1)
    if worst:
        raise ValueError(
            f"Bucket {worst[0].bucket} has {worst[0].row_count} rows, about {worst[0].estimated_bytes} bytes; "
            "use more buckets."
        )


def split_groups(df: DataFrame, columns: list[str], bucket: str = "bucket") -> DataFrame:
    """One row: distinct rows, and how many of them appear in more than one bucket."""
    spread = df.groupBy(*columns).agg(F.min(bucket).alias("lo"), F.max(bucket).alias("hi"))
    return spread.agg(
        F.count("*").alias("row_groups"), F.count_if(F.col("lo") != F.col("hi")).alias("split_groups")
    )
