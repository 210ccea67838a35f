"""Exact deduplication on every contract column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factprep.contract import FactContract
from factprep.functions.cleaning import quoted
from factprep.functions.keys import bucket_id


def exact(df: DataFrame, contract: FactContract) -> DataFrame:
    """Each distinct row once.

    Spark aggregates before and after the one shuffle, so however many copies
    a row has, each map task sends it at most once.
    """
    return df.dropDuplicates(list(contract.columns))


def by_bucket(df: DataFrame, contract: FactContract, buckets: int, name: str = "bucket") -> DataFrame:
    """Distinct rows with their bucket number, laid out by bucket.

    Equal rows share a bucket, so deduplicating inside each bucket and globally
    are the same. Shuffling on the bucket first would move every copy of a hot
    row to one task; deduplicating on the columns combines copies before the
    shuffle, and the bucket number follows from the same hash (see ``bucket_id``).
    """
    columns = list(contract.columns)
    # A grouping shuffles on its columns in the order given, the order bucket_id hashes them in;
    # dropDuplicates chooses an order of its own. The unused count is pruned from the plan.
    return with_copies(df, contract).selectExpr(
        *map(quoted, columns), f"{bucket_id(columns, buckets)} AS {quoted(name)}"
    )


def in_place(staged: DataFrame, contract: FactContract, buckets: int, name: str = "bucket") -> DataFrame:
    """Distinct rows of hash buckets, each bucket by the task that reads it, with no shuffle.

    ``staged`` comes from ``read_hash_buckets``. A bucket is read by one task, so this is for
    buckets of bounded size; ``by_bucket`` takes any rows and shares a hot row's copies out over all tasks.
    """
    return by_bucket(staged.select(*contract.columns), contract, buckets, name)


def with_copies(df: DataFrame, contract: FactContract) -> DataFrame:
    """Each distinct row once with the number of its copies."""
    return df.groupBy(*contract.columns).agg(F.count("*").alias("copies"))
