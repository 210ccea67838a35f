"""Records of runs: writing, comparing and summarising them."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factprep.operators.ranking import spread
from factprep.session import literal_path

# ``configuration`` holds further settings as JSON text.
RUN = (
    "contract string, framework string, run_id string, status string, error string, "
    "buckets int, batch_rows int, shuffle_partitions int, concurrency int, executors int, block_mib int, "
    "bucket_bytes bigint, broadcast_bytes bigint, output string, configuration string, timing_boundary string, "
    "input_files bigint, input_bytes bigint, input_uncompressed_bytes bigint, raw_rows bigint, "
    "manifest_digest string, lookup_sha256 string, cleaned_rows bigint, output_rows bigint, staged_files bigint, "
    "largest_bucket_rows bigint, buckets_over_limit bigint, "
    "staging_seconds double, total_seconds double, timed_start_epoch double, timed_end_epoch double, "
    "started_utc string, finished_utc string, recorded_utc string, benchmark_eligible boolean, versions string, "
    "cluster string"
)
SIGNATURE = [
    "contract",
    "manifest_digest",
    "lookup_sha256",
    "output_rows",
    "buckets",
    "batch_rows",
    "shuffle_partitions",
    "concurrency",
]


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def record(spark: SparkSession, path: str, **values: object) -> DataFrame:
    """Append one row to the table of runs; ``running``, ``complete`` and ``failed`` are rows of their own."""
    names = [part.split()[0] for part in RUN.split(", ")]
    unknown = set(values) - set(names)
    if unknown:
        raise ValueError(f"Unknown run fields: {sorted(unknown)}")
    values.setdefault("recorded_utc", utc_now())
    row = [json.dumps(v, sort_keys=True) if isinstance(v, dict) else v for v in (values.get(n) for n in names)]
    frame = spark.createDataFrame([tuple(row)], RUN)
    frame.coalesce(1).write.mode("append").json(path)
    return frame


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN).json(literal_path(path))


def manifest_path(path: str) -> str:
    """Where the input files of the runs recorded at ``path`` are listed, a folder for each run."""
    return path.rstrip("/") + "-manifests"


def record_manifest(files: DataFrame, path: str, run_id: str) -> None:
    """List a run's input files with their sizes and rows."""
    listed = files.select("path", "bytes", "uncompressed_bytes", "row_count", F.lit(run_id).alias("run_id"))
    listed.write.mode("append").partitionBy("run_id").parquet(manifest_path(path))


def latest(runs: DataFrame) -> DataFrame:
    """The newest row of each run."""
    columns = [c for c in runs.columns if c not in ("framework", "run_id")]
    newest = F.max_by(F.struct(*columns), "recorded_utc").alias("r")
    return runs.groupBy("framework", "run_id").agg(newest).select("framework", "run_id", "r.*").select(*runs.columns)


def comparable(runs: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Reasons why the given runs must not be compared: ``reason``, ``row_count``; empty if they may.

    Checks that each is complete, eligible and listed once, and that all agree
    in what they read and in the settings that matter.
    """
    fields = SIGNATURE if fields is None else fields
    def texts(field: str):
        return F.coalesce(F.col(field).cast("string"), F.lit(""))

    per_run = runs.groupBy("framework", "run_id").agg(F.count("*").alias("n"))
    repeated = per_run.agg(F.lit("listed_twice").alias("reason"), F.count_if(F.col("n") > 1).alias("n"))
    states = runs.agg(
        F.count_if(~F.col("status").eqNullSafe("complete")).alias("not_complete"),
        F.count_if(~F.coalesce("benchmark_eligible", F.lit(False))).alias("not_eligible"),
        *[(F.min(texts(f)) != F.max(texts(f))).cast("bigint").alias(f"different_{f}") for f in fields],
    )
    reasons = states.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("reason"), F.col(c).cast("bigint").alias("n")) for c in states.columns])
        ).alias("x")
    ).select("x.reason", "x.n")
    return reasons.unionByName(repeated).where("n > 0").withColumnRenamed("n", "row_count")


def require_comparable(runs: DataFrame, fields: list[str] | None = None, eligible: bool = True) -> None:
    found = comparable(runs, fields)
    if not eligible:
        found = found.where("reason <> 'not_eligible'")
    reasons = found.orderBy("reason").collect()
    if reasons:
        raise ValueError("Runs cannot be compared: " + ", ".join(r.reason for r in reasons))


def summarize(runs: DataFrame, group: str = "framework", seconds: str = "total_seconds") -> DataFrame:
    """Trials, median, minimum, maximum and the distances of both ends from the median."""
    return (
        spread(runs, group, seconds)
        .withColumn("below_median", F.col("median") - F.col("minimum"))
        .withColumn("above_median", F.col("maximum") - F.col("median"))
    )


def require_profileable(run: DataFrame) -> None:
    """Raise unless the run is complete and has output rows."""
    if not run.where("status = 'complete' AND output_rows > 0").take(1):
        raise ValueError("Profiling needs a complete run with at least one output row.")
