"""Resource sample reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factprep.session import literal_path

# Layout of a resource sample file.
SAMPLE = (
    "utc string, epoch_seconds double, framework string, run_id string, node string, cpu_percent double, "
    "cpu_count int, memory_used_bytes bigint, memory_available_bytes bigint, memory_total_bytes bigint, "
    "swap_used_bytes bigint"
)


def read_samples(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    named = [literal_path(path) for path in ([paths] if isinstance(paths, str) else paths)]
    return spark.read.schema(SAMPLE).option("header", True).csv(named)
