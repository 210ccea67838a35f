"""Dimension reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factprep.session import literal_path

# Header of the zone lookup.
ZONE_COLUMNS = ("LocationID", "Borough", "Zone")


def read_dimension(spark: SparkSession, path: str, columns: tuple[str, str, str] = ZONE_COLUMNS) -> DataFrame:
    """``location_id``, ``borough`` and ``zone`` from a CSV with a header, in any column order.

    A byte-order mark before the header is ignored. An id that is not a whole
    number becomes null, which the dimension check reports.
    """
    # Doubled quotes and line breaks inside quotes, as CSV writers produce them.
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(literal_path(path))
    raw = raw.toDF(*[c.lstrip("\ufeff") for c in raw.columns])
    missing = set(columns) - set(raw.columns)
    if missing:
        raise ValueError(f"The dimension lacks columns: {sorted(missing)}")
    key, borough, zone = columns
    return raw.select(
        F.trim(F.col(key)).try_cast("bigint").alias("location_id"),
        F.col(borough).alias("borough"),
        F.col(zone).alias("zone"),
    )
