"""Command line: prepare, stage, compare, summarize and inventory."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from factprep.operators import runlog
from factprep.plans import prepare as P
from factprep.plans import report
from factprep.session import build_session
from factprep.sources import inventory
from factprep.sources.samples import read_samples


def _parser() -> argparse.ArgumentParser:
    cli = argparse.ArgumentParser(prog="factprep", description="Prepare and verify large fact tables with Spark.")
    cli.add_argument("--master", help="Spark master; from spark-submit if omitted")
    jobs = cli.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("prepare", help="clean, deduplicate, enrich and write a fact dataset")
    job.add_argument("--input", required=True)
    job.add_argument("--lookup", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--staging")
    job.add_argument("--reuse-staging")
    job.add_argument("--buckets", type=int, default=0)
    job.add_argument("--max-bucket-mib", type=int, default=128)
    job.add_argument("--max-files", type=int)
    job.add_argument("--max-uncompressed-gb", type=float)
    job.add_argument("--runs")
    job.add_argument("--run-id")
    job.add_argument("--framework", default="factprep")
    job.add_argument("--ineligible", action="store_true", help="a trial, not a benchmark")
    job.add_argument("--oversized", choices=["record", "raise"], default="record", help="buckets over --max-bucket-mib")
    job.add_argument("--broadcast-mib", type=int, default=64, help="largest lookup that is broadcast")

    job = jobs.add_parser("stage", help="clean new files into staging, a bounded number at a time")
    job.add_argument("--input", required=True)
    job.add_argument("--staging", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--buckets", type=int, default=128)
    job.add_argument("--files-per-batch", type=int, default=1000)

    job = jobs.add_parser("compare", help="check that two finished datasets are the same")
    job.add_argument("--left", required=True)
    job.add_argument("--right", required=True)
    job.add_argument("--buckets", type=int)
    job.add_argument("--runs")
    job.add_argument("--run-ids", nargs=2)

    job = jobs.add_parser("summarize", help="report comparable runs")
    job.add_argument("--runs", required=True)
    job.add_argument("--run-ids", nargs="+", required=True)
    job.add_argument("--resources", nargs="*")
    job.add_argument("--worker-nodes", nargs="+", default=[])
    job.add_argument("--output", required=True)

    job = jobs.add_parser("inventory", help="write file names, sizes, rows and checksums as JSON")
    job.add_argument("--input", required=True)
    job.add_argument("--output", required=True)
    return cli


def _runs(spark: SparkSession, path: str, ids: list[str]) -> DataFrame:
    if len(ids) != len(set(ids)):
        raise ValueError("A run id is listed twice.")
    known = runlog.latest(runlog.read(spark, path))
    chosen = known.where(known.run_id.isin(ids))
    if chosen.select("run_id").distinct().count() != len(set(ids)):
        raise ValueError("Not every run id is recorded.")
    return chosen


def main(arguments: list[str] | None = None) -> dict[str, object]:
    args = _parser().parse_args(arguments)
    spark = build_session("factprep", args.master)
    if args.job == "prepare":
        done = P.prepare(
            spark,
            args.input,
            args.lookup,
            args.output,
            staging=args.staging,
            reuse_staging=args.reuse_staging,
            buckets=args.buckets,
            bucket_bytes=args.max_bucket_mib << 20,
            max_files=args.max_files,
            max_uncompressed_gb=args.max_uncompressed_gb,
            runs=args.runs,
            run_id=args.run_id,
            framework=args.framework,
            eligible=not args.ineligible,
            oversized=args.oversized,
            broadcast_bytes=args.broadcast_mib << 20,
        )
        result = vars(done)
    elif args.job == "stage":
        P.stage_stream(
            spark,
            args.input,
            args.staging,
            args.checkpoint,
            buckets=args.buckets,
            files_per_batch=args.files_per_batch,
        )
        result = {"staging": args.staging}
    elif args.job == "compare":
        if bool(args.runs) != bool(args.run_ids):
            raise ValueError("Give the run table and the two run ids together.")
        runs = _runs(spark, args.runs, args.run_ids) if args.runs else None
        result = P.compare(spark, args.left, args.right, buckets=args.buckets, runs=runs)
    elif args.job == "summarize":
        samples = read_samples(spark, args.resources) if args.resources else None
        report.summarize(spark, _runs(spark, args.runs, args.run_ids), args.output, samples, args.worker_nodes)
        result = {"output": args.output}
    else:
        files = inventory.with_checksums(inventory.file_inventory(spark, args.input), args.input)
        files.drop("column_types", "column_bytes").write.json(args.output)
        result = inventory.totals(spark.read.json(args.output)).first().asDict()
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
