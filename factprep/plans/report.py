"""Reports over recorded runs: a table of trials and a summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factprep.operators import resources, runlog
from factprep.sources.sinks import guard_paths

TRIAL = ["framework", "run_id", "input_bytes", "output_rows", "total_seconds", "block_mib"]


def trials(runs: DataFrame, samples: DataFrame | None = None, nodes: Sequence[str] = ()) -> DataFrame:
    """One row per run, with its resource peaks; nulls and zero without samples."""
    rows = runs.select(*TRIAL)
    if samples is None:
        return rows.selectExpr(
            "*",
            "CAST(NULL AS DOUBLE) AS peak_cpu_percent",
            "CAST(NULL AS DOUBLE) AS peak_memory_gib",
            "0L AS resource_samples",
        )
    if not nodes or len(set(nodes)) != len(nodes):
        raise ValueError("Name each sampled node once.")
    return rows.join(resources.peaks(samples, runs, nodes), ["framework", "run_id"])


def summarize(
    spark: SparkSession,
    runs: DataFrame,
    output: str,
    samples: DataFrame | None = None,
    nodes: Sequence[str] = (),
    fields: list[str] | None = None,
) -> None:
    """Write ``benchmark_runs`` (CSV) and ``summary`` (JSON) of comparable runs to a new folder."""
    guard_paths(spark, [], [output])
    runlog.require_comparable(runs, fields)
    trials(runs, samples, nodes).write.option("header", True).csv(f"{output}/benchmark_runs")
    runlog.summarize(runs).write.json(f"{output}/summary")
