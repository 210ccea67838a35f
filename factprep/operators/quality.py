"""Checks on inputs: fact schema and dimension constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factprep.contract import FactContract

ROW_OVERHEAD = 64  # bytes per dimension row besides its texts


def check_fact_schema(schema: T.StructType, contract: FactContract) -> None:
    """Raise unless every contract column is there and no timestamp carries a zone."""
    types = {f.name: f.dataType for f in schema.fields}
    missing = [c for c in contract.columns if c not in types]
    if missing:
        raise ValueError(f"Input lacks columns: {sorted(missing)}")
    zoned = [c for c in contract.times if isinstance(types[c], T.TimestampType)]
    if zoned:
        raise ValueError(f"Zoned timestamps are not accepted: {zoned}")


def dimension_violations(dim: DataFrame) -> DataFrame:
    """One row per broken rule and id: ``rule``, ``location_id``, ``rows``.

    Expects ``location_id``, ``borough`` and ``zone``.
    """
    blank = F.coalesce(F.col("borough"), F.lit("")) == ""
    blank |= F.coalesce(F.col("zone"), F.lit("")) == ""
    per_id = dim.groupBy("location_id").agg(
        F.count("*").alias("rows"), F.count_if(blank).alias("blanks")
    )
    found = F.filter(
        F.array(
            F.when(F.col("location_id").isNull(), F.struct(F.lit("id_missing").alias("rule"), F.col("rows"))),
            F.when(
                F.col("location_id").isNotNull() & (F.col("rows") > 1),
                F.struct(F.lit("id_repeated").alias("rule"), F.col("rows")),
            ),
            F.when(F.col("blanks") > 0, F.struct(F.lit("name_missing").alias("rule"), F.col("blanks").alias("rows"))),
        ),
        lambda item: item.isNotNull(),
    )
    return per_id.select("location_id", F.explode(found).alias("v")).select("v.rule", "location_id", "v.rows")


def require_dimension(dim: DataFrame) -> int:
    """Raise if the dimension is empty or breaks a rule; otherwise return its size in bytes.

    The size counts the texts and a fixed share per row, and decides whether
    the dimension may be broadcast.
    """
    broken = dimension_violations(dim).orderBy("rule", "location_id").take(1)
    if broken:
        rule, location, rows = broken[0]
        raise ValueError(f"Dimension rule {rule} broken by id {location} ({rows} rows)")
    text = F.octet_length("borough") + F.octet_length("zone")
    size = dim.agg(F.sum(text.cast("bigint") + F.lit(ROW_OVERHEAD))).first()[0]
    if size is None:
        raise ValueError("The dimension is empty.")
    return size
