"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

# Spark's own adaptive execution sizes, coalesces and splits shuffle partitions;
# skewed joins and rebalanced writes rely on it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM does not compile methods beyond this size; operators one by one are faster then.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "factprep", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that does not exist yet.

    Scratch files lie in one folder for each application, which goes when the
    application ends.
    """
    folder = f"{shared_root(spark)}/factprep-{spark.sparkContext.applicationId}"
    files, path = hadoop_path(spark, folder)
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The Hadoop file system of a path, and the path in full: with scheme and host, without ``..``."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    whole = files.makeQualified(found)
    return files, spark._jvm.org.apache.hadoop.fs.Path(whole.toUri().normalize())


def qualified(spark: SparkSession, path: str) -> str:
    """The path in full, as Spark lists it."""
    return hadoop_path(spark, path)[1].toString()


def hadoop_settings(spark: SparkSession, pattern: str) -> dict[str, str]:
    """The session's Hadoop settings whose names match a regular expression."""
    return dict(spark._jsparkSession.sessionState().newHadoopConf().getValByRegex(pattern))


def literal_path(path: str) -> str:
    """A path for Spark's readers that stands for itself, whatever marks its names hold."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


@contextmanager
def settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """Session settings for the length of a block; double underscores stand for dots."""
    named = {key.replace("__", "."): str(value) for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in named}
    for key, value in named.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
