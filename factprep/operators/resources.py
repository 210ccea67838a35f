"""Peaks of sampled CPU and memory use during runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GIB = 1024**3


def in_interval(samples: DataFrame, runs: DataFrame, nodes: Sequence[str]) -> DataFrame:
    """Samples of the given nodes taken while their run was timed, with their one-second bin.

    ``runs`` holds one row per run: ``framework``, ``run_id``,
    ``timed_start_epoch`` and ``timed_end_epoch``.
    """
    spans = runs.select("framework", "run_id", "timed_start_epoch", "timed_end_epoch")
    return (
        samples.where(F.col("node").isin(*nodes))
        .join(spans, ["framework", "run_id"])
        .where(F.col("epoch_seconds").between(F.col("timed_start_epoch"), F.col("timed_end_epoch")))
        .withColumn("bin", F.floor("epoch_seconds"))
    )


def repeated_samples(timed: DataFrame) -> DataFrame:
    """Nodes with more than one sample in a bin."""
    return (
        timed.groupBy("framework", "run_id", "bin", "node")
        .agg(F.count("*").alias("samples"))
        .where(F.col("samples") > 1)
    )


def complete_bins(timed: DataFrame, nodes: Sequence[str]) -> DataFrame:
    """CPU percent weighted by cores and memory in GiB, for bins in which every node was sampled.

    A second sample of one node in one bin stops the job.
    """
    once = timed.groupBy("framework", "run_id", "bin", "node").agg(
        F.count("*").alias("samples"),
        F.max(F.col("cpu_percent") * F.col("cpu_count")).alias("work"),
        F.max("cpu_count").alias("cpu_count"),
        F.max("memory_used_bytes").alias("memory"),
    )
    guarded = F.when(
        F.col("samples") > 1,
        F.raise_error(F.concat(F.lit("More than one sample per second from node "), F.col("node"))).cast("double"),
    ).otherwise(F.col("work"))
    per_bin = once.groupBy("framework", "run_id", "bin").agg(
        F.count("*").alias("present"),
        F.sum(guarded).alias("work"),
        F.sum("cpu_count").alias("cores"),
        F.sum("memory").alias("memory"),
    )
    return per_bin.where(F.col("present") == len(set(nodes))).select(
        "framework",
        "run_id",
        "bin",
        (F.col("work") / F.col("cores")).alias("cpu_percent"),
        (F.col("memory") / F.lit(float(GIB))).alias("memory_gib"),
    )


def peaks(samples: DataFrame, runs: DataFrame, nodes: Sequence[str]) -> DataFrame:
    """One row per run: highest weighted CPU, highest total memory, number of complete bins.

    A run without a complete bin gets nulls and zero.
    """
    bins = complete_bins(in_interval(samples, runs, nodes), nodes)
    found = bins.groupBy("framework", "run_id").agg(
        F.max("cpu_percent").alias("peak_cpu_percent"),
        F.max("memory_gib").alias("peak_memory_gib"),
        F.count("*").alias("resource_samples"),
    )
    return (
        runs.select("framework", "run_id")
        .join(found, ["framework", "run_id"], "left")
        .withColumn("resource_samples", F.coalesce("resource_samples", F.lit(0)))
    )
