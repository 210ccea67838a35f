"""From raw files to the finished dataset, and the comparison of two finished datasets."""

from __future__ import annotations

import platform
import re
import time
import uuid
from dataclasses import dataclass

import pyspark
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from factprep.contract import TRIPS, FactContract
from factprep.functions.cleaning import quoted
from factprep.functions.features import add_features, finalize
from factprep.operators import buckets as B
from factprep.operators import cleaning, dedup, enrich, parity, runlog
from factprep.operators.quality import require_dimension
from factprep.session import literal_path, qualified, settings
from factprep.sources import inventory
from factprep.sources.dimension import read_dimension
from factprep.sources.fact import read_bucketed, read_heterogeneous
from factprep.sources.sinks import committed, exists, guard_paths, lies_by_bucket, write_bucketed
from factprep.streaming.staging import stage_available

TIMING = "from the first read of the input to the row count of the written output, staging included"


@dataclass(frozen=True)
class Finished:
    """Where a run wrote its output and how many rows it saw."""

    run_id: str
    output: str
    buckets: int
    raw_rows: int
    cleaned_rows: int | None
    output_rows: int


def finish(
    cleaned: DataFrame,
    dim: DataFrame,
    contract: FactContract,
    buckets: int,
    dim_bytes: int | None = None,
    broadcast_bytes: int = enrich.BROADCAST_BYTES,
) -> DataFrame:
    """Clean rows to output rows: distinct, enriched, with features and bucket number."""
    distinct = dedup.by_bucket(cleaned, contract, buckets)
    enriched = enrich.lookup_all(distinct, dim, contract, dim_bytes, broadcast_bytes)
    return finalize(add_features(enriched, contract), contract, "bucket")


def transform(
    raw: DataFrame, dim: DataFrame, contract: FactContract, buckets: int, dim_bytes: int | None = None
) -> DataFrame:
    """Raw rows to output rows in one plan: one shuffle, for the deduplication."""
    return finish(cleaning.clean(raw, contract), dim, contract, buckets, dim_bytes)


def session_facts(spark: SparkSession) -> dict[str, object]:
    """Settings of the session that a run's speed depends on."""
    return {
        "batch_rows": int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")),
        "concurrency": spark.sparkContext.defaultParallelism,
        # The driver is listed among the executors; a local master has no other.
        "executors": max(1, len(spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos()) - 1),
        "block_mib": _split_bytes(spark) >> 20,
    }


def _split_bytes(spark: SparkSession) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )


def _staged_about(staging: str) -> str:
    """Where the contract and input of staged rows are noted, out of sight of readers of the folder."""
    return f"{staging.rstrip('/')}/_about"


def note_staging(spark: SparkSession, staging: str, contract: FactContract, manifest_digest: str) -> None:
    row = spark.createDataFrame([(contract.name, manifest_digest)], "contract string, manifest_digest string")
    row.coalesce(1).write.mode("overwrite").json(_staged_about(staging))


def require_staging(spark: SparkSession, staging: str, contract: FactContract, manifest_digest: str) -> None:
    """Raise unless the staged rows are those of this contract and input."""
    if not exists(spark, _staged_about(staging)):
        raise ValueError(f"Nothing says which input the rows staged at {staging} are of.")
    about = spark.read.schema("contract string, manifest_digest string").json(literal_path(_staged_about(staging))).first()
    if (about.contract, about.manifest_digest) != (contract.name, manifest_digest):
        raise ValueError(f"The rows staged at {staging} are of another input or contract.")


def stage_stream(
    spark: SparkSession,
    source: str,
    staging: str,
    checkpoint: str,
    *,
    contract: FactContract = TRIPS,
    buckets: int = B.FEWEST_BUCKETS,
    files_per_batch: int = 1000,
) -> None:
    """Stage new files a bounded number at a time; ``prepare`` takes the rows up with ``reuse_staging``."""
    files = inventory.file_inventory(spark, source).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        inventory.check_files(files, contract)
        if not files.take(1):
            raise ValueError(f"No Parquet inputs in {source}")
        stage_available(spark, source, staging, checkpoint, contract, buckets, files_per_batch)
        note_staging(spark, staging, contract, inventory.manifest_digest(files))
    finally:
        files.unpersist()


def prepare(
    spark: SparkSession,
    source: str,
    zones: str,
    output: str,
    *,
    contract: FactContract = TRIPS,
    staging: str | None = None,
    reuse_staging: str | None = None,
    buckets: int = 0,
    bucket_bytes: int = B.BUCKET_BYTES,
    max_files: int | None = None,
    max_uncompressed_gb: float | None = None,
    runs: str | None = None,
    run_id: str | None = None,
    framework: str = "factprep",
    eligible: bool = True,
    oversized: str = "record",
    broadcast_bytes: int = enrich.BROADCAST_BYTES,
) -> Finished:
    """Clean, deduplicate, enrich and write a fact dataset.

    With ``staging`` the clean rows are written there first, by bucket; a later
    run can take them up with ``reuse_staging`` instead of cleaning again.
    Without either, everything is one Spark job. Shuffle partitions are sized
    by the input, and never fewer than the session's own. ``runs`` names a table that
    receives a row when the run starts and when it completes or fails; the
    input files are listed beside it. ``bucket_bytes`` sets the number of buckets and is
    checked against the rows that each got: ``oversized`` says whether one beyond it is only
    recorded or raises, and then no output appears. Staging and output appear whole or not
    at all, see ``committed``.
    """
    if max_files is not None and max_uncompressed_gb is not None:
        raise ValueError("Choose a number of files or a byte budget, not both.")
    if buckets < 0:
        raise ValueError("buckets must not be negative.")
    if staging and reuse_staging:
        raise ValueError("Choose new staging or staging to reuse, not both.")
    if oversized not in ("record", "raise"):
        raise ValueError("oversized must be record or raise.")
    run_id = run_id or uuid.uuid4().hex
    if not re.fullmatch("[A-Za-z0-9_-]+", run_id):
        raise ValueError("A run id may hold letters, digits, underscores and hyphens only.")
    guard_paths(spark, [p for p in (source, zones, reuse_staging, runs) if p], [p for p in (output, staging) if p])
    if reuse_staging and not exists(spark, reuse_staging):
        raise FileNotFoundError(f"No staged rows at {reuse_staging}")

    files = inventory.file_inventory(spark, source)
    if max_files is not None:
        files = inventory.prefix_by_count(files, max_files)
    elif max_uncompressed_gb is not None:
        files = inventory.prefix_by_budget(files, int(max_uncompressed_gb * inventory.GIGABYTE))
    chosen = max_files is not None or max_uncompressed_gb is not None
    # Several small aggregates follow; each footer is read once.
    files = files.persist(StorageLevel.MEMORY_AND_DISK)
    inventory.check_files(files, contract)
    sizes = inventory.summary(files, contract.columns)
    if not sizes.files:
        raise ValueError(f"No Parquet inputs in {source}")
    # Checked, measured and looked up in every role; parsed once.
    dim = read_dimension(spark, zones).persist(StorageLevel.MEMORY_AND_DISK)
    dim_bytes = require_dimension(dim)
    buckets = buckets or B.choose_count(sizes.row_count, bucket_bytes)
    digest = sizes.digest
    if reuse_staging:
        require_staging(spark, reuse_staging, contract, digest)

    partitions = B.choose_partitions(sizes.projected_bytes, int(spark.conf.get("spark.sql.shuffle.partitions")))
    split = B.choose_split(sizes.bytes, _split_bytes(spark))

    facts = dict(
        contract=contract.name,
        framework=framework,
        run_id=run_id,
        buckets=buckets,
        shuffle_partitions=partitions,
        bucket_bytes=bucket_bytes,
        broadcast_bytes=broadcast_bytes,
        output=qualified(spark, output),
        timing_boundary=TIMING,
        **session_facts(spark) | {"block_mib": split >> 20},
        configuration={
            "source": source,
            "zones": zones,
            "output": output,
            "oversized": oversized,
            "staging": staging or reuse_staging,
            "max_files": max_files,
            "max_uncompressed_gb": max_uncompressed_gb,
        },
        input_files=sizes.files,
        input_bytes=sizes.bytes,
        input_uncompressed_bytes=sizes.uncompressed_bytes,
        raw_rows=sizes.row_count,
        manifest_digest=digest,
        lookup_sha256=inventory.fingerprint(spark, zones),
        benchmark_eligible=eligible and reuse_staging is None,
        started_utc=runlog.utc_now(),
        versions={"python": platform.python_version(), "pyspark": pyspark.__version__},
        cluster={"master": spark.sparkContext.master},
    )
    if runs:
        runlog.record(spark, runs, status="running", **facts)
        runlog.record_manifest(files, runs, run_id)
    began, began_epoch = time.perf_counter(), time.time()
    staging_seconds, cleaned_rows, staged_files = 0.0, None, None
    try:
        with settings(spark, spark__sql__shuffle__partitions=partitions, spark__sql__files__maxPartitionBytes=split):
            if reuse_staging is None:
                cleaned = read_heterogeneous(spark, source, contract, cleaning.clean, files, chosen)
                if staging:
                    with committed(spark, staging) as place:
                        write_bucketed(cleaning.with_staging_columns(cleaned, contract, buckets), place, "_bucket")
                        note_staging(spark, place, contract, digest)
                    staging_seconds = time.perf_counter() - began
            # Rows and buckets come from the footers of what was written, so lost executors cannot distort them.
            if staging or reuse_staging:
                cleaned = read_bucketed(spark, staging or reuse_staging).select(*contract.columns)
                staged = bucket_report(spark, staging or reuse_staging, "_bucket", bucket_bytes)
                cleaned_rows, staged_files = staged.row_count, staged.files
                skew = staged
                _check_buckets(staged, oversized)
            finished = finish(cleaned, dim, contract, buckets, dim_bytes, broadcast_bytes)
            # A broadcast lookup leaves the rows where the deduplication put them.
            in_place = enrich.may_broadcast(dim_bytes, broadcast_bytes) and lies_by_bucket(spark, buckets)
            with committed(spark, output) as place:
                write_bucketed(finished, place, rebalance=not in_place)
                written = bucket_report(spark, place, "bucket", bucket_bytes)
                if not (staging or reuse_staging):
                    skew = written
                    _check_buckets(written, oversized)
            output_rows = written.row_count
    except Exception as error:
        if runs:
            runlog.record(spark, runs, status="failed", error=str(error), **facts)
        raise
    finally:
        files.unpersist()
        dim.unpersist()
    if runs:
        runlog.record(
            spark,
            runs,
            status="complete",
            cleaned_rows=cleaned_rows,
            output_rows=output_rows,
            staged_files=staged_files,
            largest_bucket_rows=skew.largest,
            buckets_over_limit=skew.over_limit,
            staging_seconds=staging_seconds,
            total_seconds=time.perf_counter() - began,
            timed_start_epoch=began_epoch,
            timed_end_epoch=time.time(),
            finished_utc=runlog.utc_now(),
            **facts,
        )
    return Finished(run_id, output, buckets, sizes.row_count, cleaned_rows, output_rows)


def bucket_report(spark: SparkSession, path: str, bucket: str, limit_bytes: int) -> Row:
    """Files, rows, rows of the largest bucket and buckets over the limit, from the footers of a bucketed dataset."""
    placed = inventory.bucket_files(inventory.file_inventory(spark, path), bucket)
    counted = placed.groupBy("bucket").agg(F.count("*").alias("files"), F.sum("row_count").alias("row_count"))
    total = lambda e: F.coalesce(e, F.lit(0))
    return counted.agg(
        total(F.sum("files")).alias("files"),
        total(F.sum("row_count")).alias("row_count"),
        total(F.max("row_count")).alias("largest"),
        F.count_if(B.estimated_bytes("row_count") > limit_bytes).alias("over_limit"),
    ).first()


def _check_buckets(report: Row, oversized: str) -> None:
    if report.over_limit and oversized == "raise":
        raise ValueError(
            f"{report.over_limit} buckets are over the limit; the largest has {report.largest} rows. Use more buckets."
        )


def account(raw: DataFrame, dim: DataFrame, contract: FactContract) -> DataFrame:
    """Rows at each stage, ``stage`` and ``row_count``, from one pass and one shuffle.

    Rejected rows are reduced to a single all-null group before the shuffle.
    """
    typed = cleaning.coerce(raw, contract)
    stored = cleaning.normal_form(typed, contract)
    marked = typed.selectExpr(f"({cleaning.is_valid(typed, contract)}) IS TRUE AS __valid", "*").selectExpr(
        "__valid", *[f"CASE WHEN __valid THEN {v} END AS {quoted(n)}" for n, v in stored.items()]
    )
    counted = marked.groupBy("__valid", *contract.columns).agg(F.count("*").alias("__copies"))
    for i, role in enumerate(contract.roles):
        known = dim.selectExpr(f"location_id AS {quoted(role.key)}", f"true AS __known{i}")
        counted = counted.join(known, role.key, "left")
    matched = " AND ".join(f"__known{i} IS TRUE" for i in range(len(contract.roles)))
    stages = {
        "raw": "coalesce(sum(__copies), 0)",
        "clean": "coalesce(sum(__copies) FILTER (WHERE __valid), 0)",
        "distinct": "count_if(__valid)",
        "output": f"count_if(__valid AND {matched})",
    }
    counts = ", ".join(f"struct('{stage}' AS stage, {n} AS row_count)" for stage, n in stages.items())
    return counted.agg(F.expr(f"array({counts})").alias("counts")).selectExpr("inline(counts)")


def compare(
    spark: SparkSession,
    left: str,
    right: str,
    *,
    contract: FactContract = TRIPS,
    buckets: int | None = None,
    runs: DataFrame | None = None,
) -> dict[str, object]:
    """Raise on the first reason why two outputs are not the same; otherwise report their size.

    ``runs`` holds the run records of the two outputs. With them inputs, settings and
    recorded row counts must agree too; each side's bucket count is the one
    recorded for that very path. Without them ``buckets`` is needed.
    """
    paths, recorded = {path: qualified(spark, path) for path in (left, right)}, {}
    if len(set(paths.values())) < 2:
        raise ValueError("Compare two outputs, not one with itself.")
    if runs is not None:
        runlog.require_comparable(
            runs, ["contract", "manifest_digest", "lookup_sha256", "buckets"], eligible=False
        )
        rows = runs.where(F.col("output").isin(*paths.values())).select("output", "buckets", "output_rows").collect()
        recorded = {r.output: r for r in rows}
        lacking = sorted(set(paths.values()) - set(recorded))
        if lacking or len(rows) != 2 or runs.count() != 2:
            raise ValueError(f"The records are not those of the two outputs; none fits {lacking}.")
        found_buckets = rows[0].buckets
        if buckets not in (None, found_buckets):
            raise ValueError(f"The outputs were recorded with {found_buckets} buckets, not {buckets}.")
        buckets = found_buckets
    if buckets is None:
        raise ValueError("Give the run records or the number of buckets.")
    sides = []
    for path in (left, right):
        files = inventory.file_inventory(spark, path).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            inventory.check_layout(files)
            inventory.require_output_types(files, contract)
        finally:
            files.unpersist()
        df = read_bucketed(spark, path, "bucket")
        parity.check_schema(df, contract, "bucket")
        parity.require_clean_audit(df, contract, buckets if "bucket" in df.columns else None)
        sides.append(df)
    laid_out = all("bucket" in side.columns for side in sides)
    found = (parity.require_parity_by_bucket if laid_out else parity.require_parity)(*sides, contract)
    for row in recorded.values():
        if row.output_rows != found["left_rows"]:
            raise ValueError("Outputs no longer have the recorded number of rows.")
    return {"exact_match": True, "bucket_count": buckets, **found}
