"""Stage raw files a bounded number at a time."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from factprep.contract import FactContract
from factprep.operators import cleaning
from factprep.operators.buckets import repartition_by_bucket
from factprep.session import literal_path
from factprep.sources import inventory
from factprep.sources.fact import read_files

BATCH = "_batch"
LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def stage_available(
    spark: SparkSession,
    source: str,
    staging: str,
    checkpoint: str,
    contract: FactContract,
    buckets: int,
    files_per_batch: int = 1000,
) -> None:
    """Clean every file not staged yet, ``files_per_batch`` at a time, and stop.

    The stream is one of file listings, whose contents it does not read. Each batch
    reads the footers of its files and cleans them by their own physical types, so files may
    differ as they do for ``read_heterogeneous``; a file that lacks a column or holds zoned times stops
    the stream before its batch is written.

    The checkpoint remembers which files are done, so an interrupted run goes
    on where it stopped and a later one picks up new files. Each batch replaces
    its own folder, named by the checkpoint's stream id and its number, so repeating
    one cannot duplicate rows, and streams of several sources may share a staging
    folder. Equal rows of
    different batches remain; deduplication happens when the staged rows are
    finished.
    """

    def write(batch: DataFrame, number: int) -> None:
        # At most files_per_batch rows; the footers are read once.
        files = inventory.with_footers(batch)
        files = files.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            inventory.check_files(files, contract)
            cleaned = read_files(spark, files, contract, cleaning.clean)
            staged = cleaning.with_staging_columns(cleaned, contract, buckets)
            # Spark writes the id before the first batch, and it stays with the checkpoint.
            stream = spark.read.schema("id string").json(f"{literal_path(checkpoint)}/metadata").first().id
            repartition_by_bucket(staged, "_bucket").write.mode("overwrite").option("compression", "snappy").partitionBy(
                "_bucket"
            ).parquet(f"{staging}/{BATCH}={stream}-{number}")
        finally:
            files.unpersist()

    listing = (
        spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(literal_path(source))
    )
    query = (
        inventory.footer_listing(spark, listing, source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
