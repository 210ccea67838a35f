"""Inner lookups of a dimension in several roles."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factprep.contract import FactContract, Role
from factprep.functions.cleaning import quoted
from factprep.operators.quality import require_dimension

BROADCAST_BYTES = 64 * 1024 * 1024
# Largest dimension that becomes part of a plan.
MAP_BYTES = 1024 * 1024


def may_broadcast(dim_bytes: int | None, limit: int = BROADCAST_BYTES) -> bool:
    return dim_bytes is not None and dim_bytes <= limit


def lookup(
    fact: DataFrame, dim: DataFrame, role: Role, dim_bytes: int | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Inner join that adds borough and zone for one role; rows without a match go.

    The dimension is broadcast by hint when its measured size ``dim_bytes`` is
    within ``limit``. Otherwise Spark chooses from its own size
    estimates and, at run time, measured sizes; a hot key is then split by the
    adaptive skew join.
    """
    named = dim.selectExpr(
        f"location_id AS {quoted(role.key)}", f"borough AS {quoted(role.borough)}", f"zone AS {quoted(role.zone)}"
    )
    if may_broadcast(dim_bytes, limit):
        named = F.broadcast(named)
    return fact.join(named, role.key, "inner")


def lookup_all(
    fact: DataFrame,
    dim: DataFrame,
    contract: FactContract,
    dim_bytes: int | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    for role in contract.roles:
        fact = lookup(fact, dim, role, dim_bytes, limit)
    return fact


def lookup_map(fact: DataFrame, dim: DataFrame, contract: FactContract, limit: int = MAP_BYTES) -> DataFrame:
    """The same result through literal maps, without a join.

    For dimensions of a few thousand rows, as the whole of it becomes part of the
    plan; the caller chooses. Raises if the dimension breaks a rule or is measured beyond ``limit`` bytes.
    """
    size = require_dimension(dim)
    if size > limit:
        raise ValueError(f"The dimension has {size} bytes, too many for a map in the plan; join it.")
    rows = dim.select("location_id", "borough", "zone").collect()
    place = F.create_map(
        *chain.from_iterable(
            (F.lit(i).cast("bigint"), F.struct(F.lit(b).alias("borough"), F.lit(z).alias("zone"))) for i, b, z in rows
        )
    )
    for role in contract.roles:
        fact = fact.withColumn(f"__{role.key}", F.element_at(place, F.col(role.key)))
    fact = fact.where(" AND ".join(f"`__{role.key}` IS NOT NULL" for role in contract.roles))
    for role in contract.roles:
        fact = fact.withColumns(
            {role.borough: F.col(f"__{role.key}.borough"), role.zone: F.col(f"__{role.key}.zone")}
        )
    return fact.drop(*[f"__{role.key}" for role in contract.roles])


def unmatched(fact: DataFrame, dim: DataFrame, role: Role) -> DataFrame:
    """Fact keys the dimension does not know, with their row counts; counted before the join."""
    keys = fact.groupBy(F.col(role.key).alias("location_id")).agg(F.count("*").alias("row_count"))
    return keys.join(dim.select("location_id"), "location_id", "left_anti")
