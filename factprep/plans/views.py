"""Fact and dimension views over star-schema tables (region, nation, customer, supplier, orders, lineitem, events)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factprep.contract import MOVES

# Types of the columns the views use; naming them spares a job per table that would look them up.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_tax double, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}.parquet")


def zones(spark: SparkSession, root: str) -> DataFrame:
    """Nations as zones, regions as boroughs."""
    nation, region = table(spark, root, "nation"), table(spark, root, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "CAST(n_nationkey AS BIGINT) AS location_id", "r_name AS borough", "n_name AS zone"
    )


def shipments(spark: SparkSession, root: str) -> DataFrame:
    """One move per order line: from the customer's nation to the supplier's, from order to shipping date.

    Keeps ``l_orderkey``. Physical types are the tables' own. Spark broadcasts
    a table only if it is small; beyond that it shuffles both sides, and splits
    a hot order, customer or supplier by its adaptive skew join.
    """
    line, orders = table(spark, root, "lineitem"), table(spark, root, "orders")
    customer, supplier = table(spark, root, "customer"), table(spark, root, "supplier")
    return (
        line.join(orders, line.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .selectExpr(
            "l_orderkey",
            "l_suppkey AS vendor_id",
            "o_orderdate AS start_ts",
            "l_shipdate AS end_ts",
            "l_linenumber AS party_size",
            "l_quantity AS distance",
            "c_nationkey AS from_id",
            "s_nationkey AS to_id",
            "l_extendedprice AS fare",
            "l_extendedprice * l_tax AS total",
        )
    )


def dirty_shipments(spark: SparkSession, root: str) -> DataFrame:
    """Shipments with deterministic faults and copies, to exercise every cleaning rule.

    Faults depend on the order key. Lines of some orders appear a second time
    with their zero totals positive, so that copies differ in the sign of zero only.
    """
    faulty = shipments(spark, root).selectExpr(
        "l_orderkey",
        "CASE WHEN l_orderkey % 17 <> 0 THEN CAST(vendor_id AS DOUBLE) END AS vendor_id",
        """CASE WHEN l_orderkey % 43 = 0 THEN TIMESTAMP_NTZ '1677-12-31 23:59:59' WHEN l_orderkey % 19 <> 0 THEN start_ts
                END AS start_ts""",
        "CASE WHEN l_orderkey % 47 = 0 THEN TIMESTAMP_NTZ '2262-01-01 00:00:00' ELSE end_ts END AS end_ts",
        "CAST(party_size AS DOUBLE) + IF(l_orderkey % 23 = 0, 0.5D, 0D) AS party_size",
        """CASE WHEN l_orderkey % 29 = 0 THEN double('NaN') WHEN l_orderkey % 31 = 0 THEN double('Infinity')
                WHEN l_orderkey % 37 = 0 THEN 0D ELSE distance END AS distance""",
        "CAST(from_id AS DOUBLE) + IF(l_orderkey % 11 = 0, 100D, 0D) AS from_id",
        """CAST(to_id AS DOUBLE) + CASE WHEN l_orderkey % 41 = 0 THEN 4294967296D WHEN l_orderkey % 53 = 0 THEN -4294967296D
                ELSE 0D END AS to_id""",
        "fare",
        "CASE WHEN l_orderkey % 13 = 0 THEN double('-0.0') ELSE total END AS total",
    )
    columns = [c for c in faulty.columns if c not in ("l_orderkey", "total")]
    return faulty.selectExpr(
        "*", "explode(IF(l_orderkey % 7 = 0, array(false, true), array(false))) AS copy"
    ).selectExpr(*columns, "IF(copy AND total = 0D, 0D, total) AS total")


def text_shipments(spark: SparkSession, root: str) -> DataFrame:
    """The faulty shipments with every column as text; some of it cannot be read.

    A vendor of some orders gets letters, a number becomes a word or is left blank, and a time is
    spelled in words.
    """
    rows = dirty_shipments(spark, root)
    return rows.selectExpr(
        "concat(CAST(vendor_id AS STRING), IF(party_size = 2, 'x', '')) AS vendor_id",
        "IF(party_size = 3, 'early', CAST(start_ts AS STRING)) AS start_ts",
        "CAST(end_ts AS STRING) AS end_ts",
        "CAST(party_size AS STRING) AS party_size",
        "IF(party_size = 4, 'far', CAST(distance AS STRING)) AS distance",
        "IF(party_size = 5, '', CAST(from_id AS STRING)) AS from_id",
        "concat(' ', CAST(to_id AS STRING), ' ') AS to_id",
        "CAST(fare AS STRING) AS fare",
        "CAST(total AS STRING) AS total",
    )


def hops(spark: SparkSession, root: str) -> DataFrame:
    """One move per event, from its microsecond to the end of its day; keeps ``event_id`` and ``event_type``.

    A row-by-row view: durations, hours and speeds come without any shuffle.
    Some start zones are unknown to the dimension.
    """
    return table(spark, root, "events").selectExpr(
        "event_id",
        "event_type",
        "user_id AS vendor_id",
        "ts AS start_ts",
        "CAST(date_add(CAST(ts AS DATE), 1) AS TIMESTAMP_NTZ) AS end_ts",
        "event_id % 6 + 1 AS party_size",
        "value AS distance",
        "user_id % 30 AS from_id",
        "(event_id * 7) % 25 AS to_id",
        "value AS fare",
        "value AS total",
    )


def spelled_hops(spark: SparkSession, root: str) -> DataFrame:
    """The hops with their start as text, spelled in six ways by event; every seventh cannot be read."""
    months = ", ".join(f"'{m}'" for m in "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split())
    parts = hops(spark, root).selectExpr("*", "CAST(start_ts AS STRING) AS iso").selectExpr(
        "*",
        "left(iso, 4) AS y",
        "substr(iso, 6, 2) AS m",
        "substr(iso, 9, 2) AS d",
        "substr(iso, 12) AS clock",
        f"element_at(array({months}), CAST(substr(iso, 6, 2) AS INT)) AS name",
        "concat((hour(start_ts) + 11) % 12 + 1, substr(iso, 14), IF(hour(start_ts) < 12, ' AM', ' pm')) AS half",
    )
    spelled = """
        CASE event_id % 7
        WHEN 0 THEN iso
        WHEN 1 THEN concat(m, '/', d, '/', y, ' ', half)
        WHEN 2 THEN concat(y, '/', m, '/', d, ' ', clock)
        WHEN 3 THEN concat(d, '-', name, '-', y, ' ', clock)
        WHEN 4 THEN concat(name, ' ', d, ', ', y, ' ', half)
        WHEN 5 THEN concat(y, m, d, ' ', clock)
        ELSE concat('soon after ', clock) END AS start_ts"""
    return parts.selectExpr("event_id", spelled, *[c for c in MOVES.columns if c != "start_ts"]).select(
        "event_id", *MOVES.columns
    )
