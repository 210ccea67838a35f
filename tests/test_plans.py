"""Shapes of the plans: shuffles, broadcasts, pushed filters, Python."""

from __future__ import annotations

import re

import pytest

from factprep.contract import MOVES, TRIPS
from factprep.functions.keys import bucket_id
from factprep.operators import cleaning, dedup, enrich, parity, profile
from factprep.plans import prepare as P
from factprep.plans import queries as Q
from factprep.plans import views as V
from factprep.session import settings
from factprep.sources import inventory
from factprep.sources.fact import read_fact, read_hash_buckets
from factprep.sources.sinks import write_hash_buckets

SMALL = "/root/testdata/sf0.001"
ZONES = "location_id bigint, borough string, zone string"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"\bExchange \w*partitioning", plan(df)))


@pytest.fixture
def moves(spark, tmp_path):
    path = str(tmp_path / "moves")
    V.shipments(spark, SMALL).selectExpr(*MOVES.columns, "fare * 2 AS unused").write.parquet(path)
    return read_fact(spark, path, MOVES)


def test_whole_job_has_one_shuffle_and_no_python(spark, moves):
    dim = spark.createDataFrame([(1, "a", "b")], ZONES)
    job = P.transform(moves, dim, MOVES, 8, dim_bytes=100)
    text = plan(job)
    assert shuffles(job) == 1
    assert text.count("BroadcastHashJoin") == 2
    assert "Python" not in text and "ArrowEval" not in text and "SortMergeJoin" not in text


def test_rules_and_columns_reach_the_scan(moves):
    assert "unused" not in plan(cleaning.clean(moves, MOVES))
    pushed = _pushed(cleaning.clean(moves, MOVES))
    for part in (
        "IsNotNull(vendor_id)",
        "GreaterThan(distance,0.0)",
        "LessThan(fare,Infinity)",
        "GreaterThanOrEqual(start_ts,1678-01-01T00:00)",
        "GreaterThanOrEqual(vendor_id,-2147483648)",
    ):
        assert part in pushed, part


def _pushed(df) -> str:
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metadata().apply("PushedFilters")


def test_dimension_beyond_the_limit_is_not_forced_into_memory(spark, moves):
    dim = spark.range(100).selectExpr("id AS location_id", "'a' AS borough", "'b' AS zone")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cleaned = cleaning.clean(moves, MOVES)
        large = enrich.lookup_all(cleaned, dim, MOVES, enrich.BROADCAST_BYTES + 1)
        assert "BroadcastHashJoin" not in plan(large)
        small = enrich.lookup_all(cleaned, dim, MOVES, 1000)
        assert plan(small).count("BroadcastHashJoin") == 2
        assert sorted(large.collect()) == sorted(small.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_zone_is_split_when_the_dimension_is_not_broadcast(spark):
    """Two fifths of the rows share one start zone."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(0, 200000, 1, 16).selectExpr(
            "id", "IF(id % 5 < 2, 7L, pmod(xxhash64(id), 5000)) AS from_id", "sha2(CAST(id AS STRING), 256) AS rest"
        )
        dim = spark.range(4000).selectExpr("id AS location_id", "'b' AS borough", "CAST(id AS STRING) AS zone")
        joined = enrich.lookup(fact, dim, MOVES.roles[0])
        counted = joined.selectExpr("count(*)", "sum(id)", "count_if(from_zone <> CAST(from_id AS STRING))").first()
        known = fact.where("from_id < 4000").selectExpr("count(*)", "sum(id)", "0L").first()
        assert tuple(counted) == tuple(known)
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_copies_are_combined_before_the_shuffle(spark, moves):
    """Half of the rows are copies of one row; at most one per map task may be sent."""
    cleaned = cleaning.clean(moves, MOVES)
    one = cleaned.limit(1).collect()
    hot = spark.range(20000).selectExpr("id").crossJoin(spark.createDataFrame(one, cleaned.schema)).drop("id")
    both = cleaned.unionByName(hot)
    for found in (dedup.exact(both, MOVES), dedup.by_bucket(both, MOVES, 8).drop("bucket")):
        assert shuffles(found) == 1
        assert len(re.findall(r"HashAggregate\(", plan(found))) == 2
        assert sorted(found.select(*MOVES.columns).collect()) == sorted(cleaned.distinct().collect())


@pytest.mark.parametrize("name", ["clean_contract", "clean_text_fact", "clean_spelled_times", "flagship_clean_enrich"])
def test_generated_methods_are_small_enough_to_be_compiled(spark, name):
    """The JVM interprets methods beyond 8,000 bytes."""
    with settings(spark, spark__sql__adaptive__enabled=False, spark__sql__codegen__hugeMethodLimit=65535):
        execution = Q.QUERIES[name](spark, SMALL)._jdf.queryExecution()
        code = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(execution, "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000, sizes


def test_computed_columns_are_computed_once(spark):
    rows = spark.range(9).selectExpr("id * 3 AS vendor_id", "id AS party_size")
    assert cleaning.stored_columns(rows) == {"party_size"}
    assert cleaning.stored_columns(rows.selectExpr("party_size AS p").where("p > 1")) == {"p"}
    once = cleaning.computed_once(rows).where("vendor_id > 3 AND vendor_id < 20").select("vendor_id")
    assert plan(once).count("* 3") == 1
    assert [r[0] for r in once.collect()] == [6, 9, 12, 15, 18]


def test_native_speed_stays_in_generated_code(spark):
    hops = V.hops(spark, SMALL)
    native = plan(Q.speed_native(spark, SMALL))
    assert "Exchange" not in native and "Python" not in native
    assert re.search(r"^\*\(1\) Project", native, re.M)
    timed = hops.selectExpr("distance", "60D AS duration_seconds")
    assert "BatchEvalPython" in plan(profile.speed(timed, "distance", "duration_seconds", "scalar"))
    assert "ArrowEvalPython" in plan(profile.speed(timed, "distance", "duration_seconds", "arrow"))


def test_parity_is_one_aggregation(moves):
    cleaned = cleaning.clean(moves, MOVES)
    diff = parity.multiset_diff(cleaned, cleaned, list(MOVES.columns))
    assert shuffles(diff) == 1 and "Join" not in plan(diff)


def test_accounting_is_one_pass(spark, moves):
    dim = spark.createDataFrame([(1, "a", "b")], ZONES)
    counted = P.account(moves, dim, MOVES)
    assert plan(counted).count("FileScan parquet") == 1


def test_contract_columns_must_be_classed_once():
    from dataclasses import replace

    with pytest.raises(ValueError):
        replace(TRIPS, floats=("trip_distance",))


def test_staged_hash_buckets_are_deduplicated_without_a_shuffle(spark, moves, tmp_path):
    cleaned = cleaning.clean(moves, MOVES)
    copies = cleaned.unionByName(cleaned).unionByName(cleaned.limit(1))
    path = str(tmp_path / "it's hashed")
    with pytest.raises(ValueError, match="brackets"):
        write_hash_buckets(copies, f"{path}[1]", list(MOVES.columns), 8)
    write_hash_buckets(copies, path, list(MOVES.columns), 8)
    staged = read_hash_buckets(spark, path, MOVES.clean_schema(), MOVES.columns, 8)
    assert staged.count() == copies.count()
    found = dedup.in_place(staged, MOVES, 8)
    assert "Exchange" not in plan(found)
    assert sorted(found.drop("bucket").collect()) == sorted(cleaned.distinct().collect())
    # The number in a file's name is the bucket that the rows' own hash gives.
    files = inventory.hash_bucket_files(inventory.file_inventory(spark, path))
    assert dict(files.groupBy("bucket").sum("row_count").collect()) == dict(
        staged.selectExpr(f"{bucket_id(MOVES.columns, 8)} AS bucket").groupBy("bucket").count().collect()
    )
    assert spark.catalog.listTables() == []


def test_equal_outputs_compare_without_a_shuffle_of_rows(spark, moves):
    cleaned = cleaning.clean(moves, MOVES).selectExpr("*", "to_id % 4 AS bucket")
    text = plan(parity.bucket_parity(cleaned, cleaned, list(MOVES.columns)))
    for exchanged in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text):
        assert re.fullmatch(r"(coalesce\()?bucket#\d+L?.*", exchanged), exchanged


def test_parity_by_bucket_finds_small_changes(spark):
    schema = "a bigint, x double, t string, bucket int"
    rows = [(i, float(i % 5), None if i % 3 else "t", i % 4) for i in range(40)] + [(0, 0.0, "t", 0)]
    columns = ["a", "x", "t"]

    def unequal(changed):
        pair = (spark.createDataFrame(r, schema).repartition(3) for r in (rows, changed))
        return [r.bucket for r in parity.bucket_parity(*pair, columns).orderBy("bucket").collect() if not r.equal]

    assert unequal(rows[::-1]) == []
    assert unequal([*rows[:-1], (0, -0.0, "t", 0)]) == [0]
    # A copy more of one row and one fewer of another, at the same number of rows.
    assert unequal([*rows[:4], rows[4], rows[4], *rows[6:8], rows[5], *rows[9:]]) == [0]
    # A null that moves to another column, and a bucket that one side lacks.
    assert unequal([(None, 1.0, "1", 1) if r == rows[1] else r for r in rows]) == [1]
    assert unequal([r for r in rows if r[3] != 2]) == [2]


def test_repeated_rows_are_found_by_hash(spark):
    rows = spark.createDataFrame([(1, 0.0), (1, -0.0), (2, None), (2, None), (3, 1.0)], "a int, x double")
    assert [(r.a, r.x, r.lhs) for r in parity.repeated_rows(rows, ["a", "x"]).collect()] == [(2, None, 2)]
