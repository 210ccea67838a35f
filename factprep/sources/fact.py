"""Fact readers."""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factprep.contract import FactContract
from factprep.functions.cleaning import quoted
from factprep.operators import cleaning
from factprep.operators.quality import check_fact_schema
from factprep.session import literal_path, qualified
from factprep.sources.inventory import file_inventory, list_inputs


def _files(spark: SparkSession) -> DataFrameReader:
    """A reader that takes the files that the inventory lists, and no others."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")


def read_fact(spark: SparkSession, paths: str | list[str], contract: FactContract) -> DataFrame:
    """Contract columns of files that share their physical types."""
    df = _files(spark).parquet(*map(literal_path, [paths] if isinstance(paths, str) else paths))
    check_fact_schema(df.schema, contract)
    return cleaning.project(df, contract)


# Spark types of stored ones, for files whose nanosecond times Spark reads only as plain numbers.
STORED = {
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "float": "float",
    "double": "double",
    "string": "string",
    "timestamp[ms]": "timestamp_ntz",
    "timestamp[us]": "timestamp_ntz",
    "timestamp[ns]": "bigint",
}


def read_nanoseconds(spark: SparkSession, paths: list[str], contract: FactContract, types: list[str]) -> DataFrame:
    """Files with nanosecond times, which are cut to microseconds.

    ``types`` gives the stored type of each contract column.
    """
    unknown = [t for t in types if t not in STORED]
    if unknown:
        raise ValueError(f"Cannot read columns of type {unknown} next to nanosecond times.")
    schema = ", ".join(f"{quoted(c)} {STORED[t]}" for c, t in zip(contract.columns, types))
    df = _files(spark).schema(schema).parquet(*map(literal_path, paths))
    columns = []
    for name, stored in zip(contract.columns, types):
        column = quoted(name)
        if stored == "timestamp[ns]":
            micros = f"({column} - pmod({column}, 1000L)) div 1000"
            seconds = f"CAST(CAST({micros} AS DECIMAL(18,0)) / 1000000 AS DECIMAL(18,6))"
            column = f"TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds}) AS {column}"
        columns.append(column)
    return df.selectExpr(*columns)


def file_kind(contract: FactContract) -> Column:
    """The stored types of an inventoried file's contract columns, as a JSON list."""
    types = F.from_json("column_types", "map<string,string>")
    return F.to_json(F.array(*[F.coalesce(F.element_at(types, c), F.lit("")) for c in contract.columns])).alias("kind")


def schema_groups(
    files: DataFrame, contract: FactContract, root: str, listed: DataFrame | None = None
) -> dict[str, list[str]]:
    """Paths to read, by physical types of the contract columns.

    ``files`` is the inventory of ``root`` or, if ``listed`` names all files
    there, a part of it. A folder is named whole where every file at or below it is
    wanted and has the same types; other files are named singly. Either way exactly the wanted
    files are read. Only paths and kinds reach the driver; a folder that mixes types
    in one place costs a path for each of its files.
    """
    top = qualified(files.sparkSession, root).rstrip("/")
    kinds = files.select("path", file_kind(contract))
    if listed is not None:
        # A file that is not wanted has a kind of its own, so no folder above it is alike.
        kinds = listed.select("path").join(kinds, "path", "left")
    below = F.split(F.substr("path", F.lit(len(top) + 2)), "/")
    depth = F.size(below) - 1
    parents = F.when(F.col("path") == top, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(0), depth), lambda n: F.concat_ws("/", F.lit(top), F.slice(below, F.lit(1), n)))
    )
    placed = kinds.select("path", "kind", F.explode_outer(parents).alias("folder"))
    unlike = F.coalesce("kind", F.lit(""))
    alike = (
        placed.groupBy("folder")
        .agg(F.min(unlike).alias("lo"), F.max(unlike).alias("hi"))
        .where("folder IS NOT NULL AND lo = hi AND lo <> ''")
        .select("folder", F.lit(True).alias("alike"))
    )
    chosen = (
        placed.where("kind IS NOT NULL")
        .join(alike, "folder", "left")
        .groupBy("path", "kind")
        .agg(F.min(F.when(F.col("alike"), F.struct(F.length("folder"), "folder"))).alias("whole"))
        .select("kind", F.coalesce("whole.folder", "path").alias("path"))
        .distinct()
    )
    groups: dict[str, list[str]] = defaultdict(list)
    for found, path in chosen.collect():
        groups[found].append(path)
    if not groups:
        raise ValueError("No Parquet inputs.")
    return dict(groups)


def read_heterogeneous(
    spark: SparkSession,
    path: str,
    contract: FactContract,
    prepare: Callable[[DataFrame, FactContract], DataFrame] | None = None,
    files: DataFrame | None = None,
    only_files: bool = False,
) -> DataFrame:
    """One table from files whose physical types differ.

    Files are read once per physical schema, brought to common types by
    ``prepare`` and united by name. The default makes every number a double
    and every time a zone-free timestamp. Passing ``cleaning.clean`` instead
    filters each group in its own types, which lets the rules reach the Parquet
    reader.

    ``files`` is the inventory of ``path`` where it is known already; with
    ``only_files`` it is a part of the folder, such as a prefix, and only that
    part is read.
    """
    files = file_inventory(spark, path) if files is None else files
    groups = schema_groups(files, contract, path, list_inputs(spark, path) if only_files else None)
    return read_groups(spark, groups, contract, prepare or as_doubles)


def read_files(
    spark: SparkSession,
    files: DataFrame,
    contract: FactContract,
    prepare: Callable[[DataFrame, FactContract], DataFrame] | None = None,
) -> DataFrame:
    """One table from a bounded number of inventoried files, each read by its own path and types."""
    groups: dict[str, list[str]] = defaultdict(list)
    for kind, path in files.select(file_kind(contract), "path").collect():
        groups[kind].append(path)
    return read_groups(spark, groups, contract, prepare or as_doubles)


def read_groups(
    spark: SparkSession,
    groups: dict[str, list[str]],
    contract: FactContract,
    prepare: Callable[[DataFrame, FactContract], DataFrame],
) -> DataFrame:
    """Each group of like files brought to common types by ``prepare``, united by name."""
    parts = []
    for kind in sorted(groups):
        types = json.loads(kind)
        if "timestamp[ns]" in types:
            part = read_nanoseconds(spark, groups[kind], contract, types)
        else:
            part = read_fact(spark, groups[kind], contract)
        parts.append(prepare(part, contract))
    return reduce(DataFrame.unionByName, parts)


def as_doubles(df: DataFrame, contract: FactContract) -> DataFrame:
    """Common raw form: numbers as double, times as zone-free timestamp."""
    typed = cleaning.coerce(df, contract)
    return typed.selectExpr(
        *[c if c in map(quoted, contract.times) else f"CAST({c} AS DOUBLE) AS {c}" for c in map(quoted, contract.columns)]
    )


def read_hash_buckets(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str], buckets: int
) -> DataFrame:
    """Files of ``write_hash_buckets``, of which Spark knows that rows equal in ``columns`` lie together.

    Grouping or joining on ``columns`` then needs no shuffle. ``schema``, ``columns`` and ``buckets`` must be
    those they were written with.
    """
    table = f"factprep_{uuid.uuid4().hex}"
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(map(quoted, columns))
    place = qualified(spark, path).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({fields}) USING parquet CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{place}'")
    try:
        # The plan keeps what it needs of the table.
        return spark.table(table).select("*")
    finally:
        spark.sql(f"DROP TABLE {table}")


def read_bucketed(spark: SparkSession, path: str, bucket: str = "_bucket") -> DataFrame:
    """A bucketed dataset; the bucket number comes from the folder names."""
    df = spark.read.parquet(literal_path(path))
    return df.withColumn(bucket, F.col(bucket).cast("int")) if bucket in df.columns else df
