"""Columns that executors read from files through Hadoop, where Arrow does not know the file system."""

from __future__ import annotations

import pkgutil
import zipfile
from functools import lru_cache
from pathlib import Path

from py4j.java_gateway import JavaObject
from pyspark import SparkContext
from pyspark.sql import Column, SparkSession
from pyspark.sql.classic.column import _to_java_column, _to_seq

SOURCE = "HadoopFile.java"


@lru_cache(maxsize=1)
def _classes(context: SparkContext) -> JavaObject:
    """A class loader with the compiled source; executors get the classes as a jar, which goes with the application."""
    jvm = context._jvm
    # Spark compiles the code that it generates with Janino, so it is always there.
    compiler = jvm.org.codehaus.janino.SimpleCompiler()
    compiler.setParentClassLoader(jvm.java.lang.Thread.currentThread().getContextClassLoader())
    compiler.cook(pkgutil.get_data(__package__, SOURCE).decode())
    jar = Path(context._temp_dir) / "factprep-hadoop.jar"
    with zipfile.ZipFile(jar, "w") as file:
        for name, code in compiler.getBytecodes().items():
            file.writestr(f"{name.replace('.', '/')}.class", bytes(code))
    context._jsc.addJar(str(jar))
    return compiler.getClassLoader()


def _read(spark: SparkSession, kind: str, path: Column) -> Column:
    """What a nested class of the source returns for a path, as Spark lists it.

    Tasks use the session's Hadoop settings of now. They are sent once and are not part of the plan.
    """
    context, jvm = spark.sparkContext, spark._jvm
    found = jvm.org.apache.spark.util.SerializableConfiguration(spark._jsparkSession.sessionState().newHadoopConf())
    made = _classes(context).loadClass(f"factprep.HadoopFile${kind}").getConstructors()[0]
    arguments = context._gateway.new_array(jvm.java.lang.Object, 1)
    arguments[0] = context._jsc.broadcast(found)
    function = made.newInstance(arguments).function()
    return Column(function.apply(_to_seq(context, [path], _to_java_column)))


def tail(spark: SparkSession, path: Column) -> Column:
    """The end of a Parquet file from its footer on, read by range."""
    return _read(spark, "Tail", path)


def sha256(spark: SparkSession, path: Column) -> Column:
    """The SHA-256 of a file of any size, in hexadecimal; it is read in small pieces."""
    return _read(spark, "Hash", path)
