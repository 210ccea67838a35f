"""Bucketed Parquet writers and the checks that come before them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from factprep.operators.buckets import repartition_by_bucket
from factprep.session import hadoop_path, literal_path, qualified
from factprep.sources.inventory import list_inputs


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system Spark uses."""
    files, place = hadoop_path(spark, path)
    return files.exists(place)


def overlap(spark: SparkSession, one: str, other: str) -> bool:
    """Whether two paths are the same or one lies inside the other, as Hadoop resolves them."""
    one, other = (qualified(spark, path).rstrip("/") + "/" for path in (one, other))
    return one.startswith(other) or other.startswith(one)


def guard_paths(spark: SparkSession, inputs: list[str], targets: list[str]) -> None:
    """Raise before anything is written if a target exists or overlaps an input or another target."""
    for i, target in enumerate(targets):
        for source in inputs:
            if overlap(spark, target, source):
                raise ValueError(f"{target} overlaps the input {source}.")
        for other in targets[i + 1 :]:
            if overlap(spark, target, other):
                raise ValueError(f"{target} and {other} must be separate folders.")
    for target in targets:
        if exists(spark, target):
            raise FileExistsError(f"{target} already exists; choose another path.")


@contextmanager
def committed(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write to that becomes ``path`` only when the block ends without an error.

    Until then it lies beside it under a name that starts with an underscore, which Spark's readers
    leave out; an error deletes it. A run that is killed leaves it behind, and nothing at ``path``. The last
    step is a rename, so a file system that renames folders at once shows either all of the dataset or none.
    """
    files, target = hadoop_path(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}-{uuid.uuid4().hex}")
    files.mkdirs(target.getParent())
    try:
        yield hidden.toString()
        # A rename onto a folder would move into it.
        if files.exists(target):
            raise FileExistsError(f"{path} was written by someone else meanwhile.")
        if not files.rename(hidden, target):
            raise OSError(f"{hidden.toString()} could not be renamed to {path}.")
    except BaseException:
        files.delete(hidden, True)
        raise


def write_bucketed(df: DataFrame, path: str, bucket: str = "bucket", rebalance: bool = True) -> None:
    """Write Snappy Parquet under ``bucket=N`` folders; the target must not exist.

    ``rebalance=False`` skips the shuffle for rows that already lie together by
    bucket (see ``lies_by_bucket``). An empty result still leaves one file with
    the schema.
    """
    spark = df.sparkSession
    laid_out = repartition_by_bucket(df, bucket) if rebalance else df
    laid_out.write.mode("errorifexists").option("compression", "snappy").partitionBy(bucket).parquet(path)
    if not list_inputs(spark, path).take(1):
        empty = spark.createDataFrame([], df.drop(bucket).schema)
        empty.coalesce(1).write.mode("append").option("compression", "snappy").parquet(path)


def write_hash_buckets(df: DataFrame, path: str, columns: list[str], buckets: int) -> None:
    """Write Snappy Parquet files that each hold rows of one hash bucket of ``columns``; the target must not exist.

    The bucket is Spark's own for bucketed tables, the same number as ``bucket_id`` gives, and stands in the
    files' names. Rows are shuffled once. ``read_hash_buckets`` reads them so that Spark knows how they lie.
    Spark takes a table's place for a pattern, so the path must hold no marks of one.
    """
    if literal_path(path) != path:
        raise ValueError(f"Bucketed files cannot lie at a path with brackets or stars: {path}")
    spark, table = df.sparkSession, f"factprep_{uuid.uuid4().hex}"
    laid_out = df.repartition(buckets, *columns)
    writer = laid_out.write.format("parquet").option("compression", "snappy").option("path", path)
    writer.bucketBy(buckets, columns).mode("errorifexists").saveAsTable(table)
    # The files stay; only the session's name for them goes.
    spark.sql(f"DROP TABLE {table}")


def lies_by_bucket(spark: SparkSession, buckets: int) -> bool:
    """Whether rows just deduplicated by ``dedup.by_bucket`` can be written without a shuffle.

    True when one of the bucket and shuffle-partition counts divides the other:
    then there are at most as many files as the larger of the two.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return parts % buckets == 0 or buckets % parts == 0
