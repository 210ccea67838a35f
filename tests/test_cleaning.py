from __future__ import annotations

import math
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from trips import ZONES, trip

from factprep.contract import MOVES, TRIPS
from factprep.functions import cleaning as C
from factprep.functions.udfs import clean_in_arrow
from factprep.operators import cleaning, dedup, enrich
from factprep.operators.quality import require_dimension
from factprep.plans import prepare as P
from factprep.sources.dimension import read_dimension
from factprep.sources.fact import read_fact, read_heterogeneous

PLAIN = trip(0)
RAW = (
    "VendorID string, tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count string, "
    "trip_distance string, PULocationID double, DOLocationID int, fare_amount decimal(9,2), total_amount float"
)
TEXT = ("2", "2023-01-01 00:00:00.1234569", "2023-01-01T00:10:00", "1.0", "3", 1.0, 2, None, 12.0)


def _cleaned(spark, trips):
    return read_heterogeneous(spark, trips.folder, TRIPS, cleaning.clean)


def test_fixture_counts(spark, trips):
    assert read_heterogeneous(spark, trips.folder, TRIPS).count() == trips.raw
    cleaned = _cleaned(spark, trips)
    assert cleaned.schema == TRIPS.clean_schema()
    assert cleaned.count() == trips.clean
    assert cleaned.where(f"CAST({TRIPS.floats[-1]} AS STRING) = '0.0'").count() == 2
    assert dedup.exact(cleaned, TRIPS).count() == trips.distinct
    assert dedup.by_bucket(cleaned, TRIPS, 8).count() == trips.distinct


def test_reading_order_of_union_and_clean_does_not_matter(spark, trips):
    early = _cleaned(spark, trips)
    late = cleaning.clean(read_heterogeneous(spark, trips.folder, TRIPS), TRIPS)
    assert sorted(early.collect()) == sorted(late.collect())


def test_output_rows(spark, trips):
    dim = read_dimension(spark, trips.zones)
    output = P.finish(_cleaned(spark, trips), dim, TRIPS, 8, require_dimension(dim)).drop("bucket")
    assert output.schema == TRIPS.output_schema()
    rows = {r.trip_distance: r for r in output.collect()}
    assert len(rows) == trips.output
    for number in (0, 1, 2, 5):
        row = trip(number)
        found = rows[row["trip_distance"]]
        seconds = (row[TRIPS.end] - row[TRIPS.start]).total_seconds()
        assert found.duration_seconds == seconds
        assert found.average_speed_mph == round(row["trip_distance"] * 3600.0 / seconds, 6)
        assert found.pickup_hour == row[TRIPS.start].hour
        places = [ZONES[row[role.key]] for role in TRIPS.roles]
        assert (found.pickup_borough, found.pickup_zone, found.dropoff_borough, found.dropoff_zone) == sum(places, ())


def test_reject_counts(spark, trips):
    """Against the rules in plain Python; a missing value breaks every rule that looks at it, NaN exceeds all numbers."""
    number = lambda r, c: -math.inf if r[c] is None else math.inf if math.isnan(r[c]) else r[c]
    numbers = TRIPS.integers + TRIPS.floats
    first, end = datetime(1678, 1, 1), datetime(2262, 1, 1)
    fails = {
        "number_missing": lambda r: any(r[c] is None for c in numbers),
        "number_not_finite": lambda r: any(math.isinf(number(r, c)) for c in numbers),
        "integer_not_whole": lambda r: any(r[c] is None or r[c] != int(r[c]) for c in TRIPS.integers),
        "integer_out_of_range": lambda r: any(not -(2**31) <= number(r, c) < 2**31 for c in TRIPS.integers),
        "time_missing": lambda r: any(r[c] is None for c in TRIPS.times),
        "time_out_of_range": lambda r: any(r[c] is None or not first <= r[c] < end for c in TRIPS.times),
        "distance_not_positive": lambda r: number(r, TRIPS.distance) <= 0,
        "duration_not_positive": lambda r: None in (r[TRIPS.start], r[TRIPS.end]) or r[TRIPS.end] <= r[TRIPS.start],
    }
    rows = trips.first_rows + trips.second_rows
    expected = {rule: sum(map(test, rows)) for rule, test in fails.items()}
    expected["any_rule"] = sum(any(test(r) for test in fails.values()) for r in rows)
    expected |= {"time_unreadable": 0, "all_rows": len(rows)}
    counts = dict(cleaning.reject_counts(read_heterogeneous(spark, trips.folder, TRIPS), TRIPS).collect())
    assert counts == expected
    assert expected["any_rule"] == trips.raw - trips.clean
    assert expected["integer_out_of_range"] > expected["number_missing"] - len(TRIPS.floats)
    assert expected["time_out_of_range"] > expected["time_missing"]


def test_unreadable_time_texts_are_counted(spark):
    rows = [("2", t, "2031-05-18", "1", "3", 1.0, 2, None, 12.0) for t in ("2031-05-17", "soon", " ", None, "17.5.2031")]
    counts = dict(cleaning.reject_counts(spark.createDataFrame(rows, RAW), TRIPS).collect())
    assert (counts["time_unreadable"], counts["time_missing"]) == (2, 4)


@pytest.mark.parametrize(
    ("column", "value", "kept"),
    [
        ("VendorID", 2147483647.0, True),
        ("VendorID", 2147483648.0, False),
        ("VendorID", -2147483648.0, True),
        ("VendorID", -2147483649.0, False),
        ("VendorID", float("nan"), False),
        ("VendorID", -0.0, True),
        ("fare_amount", -7.5, True),
        ("fare_amount", float("-inf"), False),
        ("total_amount", None, False),
        ("trip_distance", -1.0, False),
        ("trip_distance", 1e300, True),
        ("tpep_pickup_datetime", datetime(1678, 1, 1), True),
        ("tpep_pickup_datetime", datetime(1677, 12, 31, 23, 59, 59, 999999), False),
        ("tpep_dropoff_datetime", datetime(2261, 12, 31, 23, 59, 59, 999999), True),
        ("tpep_dropoff_datetime", datetime(2262, 1, 1), False),
        ("tpep_dropoff_datetime", PLAIN["tpep_pickup_datetime"], False),
    ],
)
def test_bounds(spark, column, value, kept):
    row = PLAIN | {c: float(PLAIN[c]) for c in TRIPS.integers} | {column: value}
    schema = ", ".join(f"{c} {'timestamp_ntz' if c in TRIPS.times else 'double'}" for c in TRIPS.columns)
    raw = spark.createDataFrame([tuple(row[c] for c in TRIPS.columns)], schema)
    assert cleaning.clean(raw, TRIPS).count() == int(kept)
    assert clean_in_arrow(raw, TRIPS).collect() == cleaning.clean(raw, TRIPS).collect()


def test_coerces_text_and_other_types(spark):
    rows = [(*TEXT[:7], 10, 12.0), (*TEXT[:3], "one", *TEXT[4:7], 10, 12.0), ("2", "soon", *TEXT[2:7], 10, 12.0)]
    from decimal import Decimal

    rows = [(*r[:7], Decimal("10.50"), r[8]) for r in rows]
    found = cleaning.clean(spark.createDataFrame(rows, RAW), TRIPS).collect()
    assert len(found) == 1
    assert found[0].tpep_pickup_datetime == datetime(2023, 1, 1, 0, 0, 0, 123456)
    assert (found[0].VendorID, found[0].passenger_count, found[0].fare_amount) == (2, 1, 10.5)


@pytest.mark.parametrize("zone", ["Z", "+05:30", " -08:00", " Europe/Paris", " UTC"])
def test_zoned_text_stops_the_job(spark, zone):
    from decimal import Decimal

    row = ("2", f"2023-01-01 00:00:00{zone}", *TEXT[2:7], Decimal("1.00"), 12.0)
    with pytest.raises(PySparkException, match="time zone"):
        cleaning.clean(spark.createDataFrame([row], RAW), TRIPS).collect()


def test_plain_dates_are_not_taken_for_zoned(spark):
    from decimal import Decimal

    row = ("2", "2023-01-01", "2023-01-02", *TEXT[3:7], Decimal("1.00"), 12.0)
    assert cleaning.clean(spark.createDataFrame([row], RAW), TRIPS).count() == 1


def test_zoned_column_is_refused(spark):
    row = tuple(PLAIN.values())
    schema = ", ".join(
        f"{c} {'timestamp' if c in TRIPS.times else 'double' if c in TRIPS.floats else 'bigint'}" for c in TRIPS.columns
    )
    with pytest.raises(ValueError, match="Zoned"):
        cleaning.clean(spark.createDataFrame([row], schema), TRIPS)


def test_missing_column_is_refused(spark, trips):
    with pytest.raises(ValueError, match="lacks columns"):
        cleaning.clean(spark.read.parquet(trips.first).drop("VendorID"), TRIPS)


def test_extra_columns_are_ignored(spark, trips):
    wide = spark.read.parquet(trips.second).selectExpr("*", "1 AS airport_fee")
    assert cleaning.clean(wide, TRIPS).columns == list(TRIPS.columns)


def test_empty_input_keeps_the_schema(spark, trips):
    none = read_fact(spark, trips.second, TRIPS).where("false")
    staged = cleaning.with_staging_columns(cleaning.clean(none, TRIPS), TRIPS, 8)
    assert staged.count() == 0
    assert [(f.name, f.dataType) for f in staged.schema] == [(f.name, f.dataType) for f in TRIPS.staging_schema()]


def test_equal_rows_share_key_and_bucket(spark, trips):
    staged = cleaning.with_staging_columns(_cleaned(spark, trips), TRIPS, 8)
    seen = staged.groupBy(*TRIPS.columns).agg({"_key": "min", "_bucket": "min"}).count()
    assert staged.select(*TRIPS.columns, "_key", "_bucket").distinct().count() == seen == trips.distinct
    assert staged.where("_bucket NOT BETWEEN 0 AND 7").count() == 0


def test_dedup_keeps_rows_that_differ_in_one_column(spark):
    rows = [PLAIN, PLAIN, PLAIN | {"fare_amount": 11.0}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], TRIPS.clean_schema())
    assert dedup.exact(df, TRIPS).count() == 2
    assert sorted(r.copies for r in dedup.with_copies(df, TRIPS).collect()) == [1, 2]


def test_durations_ignore_clock_changes(spark):
    # New York skips 02:00 to 03:00 on 2023-03-12 and repeats an hour on 2023-11-05.
    starts = [datetime(2023, 3, 12, 1, 30), datetime(2023, 3, 12, 2, 30), datetime(2023, 11, 5, 0, 30), datetime(1883, 11, 18)]
    spans = [timedelta(hours=2, microseconds=1), timedelta(minutes=45), timedelta(hours=3), timedelta(days=130000, microseconds=7)]
    from factprep.functions.features import add_features

    rows = [(1, s, s + d, 1, 1.0, 1, 2, 0.0, 0.0) for s, d in zip(starts, spans)]
    df = spark.createDataFrame(rows, MOVES.clean_schema())
    found = {(r.start_ts, r.duration_seconds, r.start_hour) for r in add_features(df, MOVES).collect()}
    exact = {(s, (d // timedelta(microseconds=1)) / 1e6, s.hour) for s, d in zip(starts, spans)}
    assert found == exact


def test_map_lookup_equals_join(spark, trips):
    dim = read_dimension(spark, trips.zones)
    cleaned = _cleaned(spark, trips)
    joined = enrich.lookup_all(cleaned, dim, TRIPS)
    mapped = enrich.lookup_map(cleaned, dim, TRIPS).select(*joined.columns)
    assert sorted(joined.collect()) == sorted(mapped.collect())
    assert enrich.unmatched(cleaned, dim, TRIPS.roles[0]).collect() == [(77, 1)]


def test_lookup_of_any_size_is_checked_first(spark, trips):
    dim = read_dimension(spark, trips.zones)
    cleaned = _cleaned(spark, trips)
    expected = sorted(enrich.lookup_all(cleaned, dim, TRIPS).collect())
    more = spark.range(1000, 4000).selectExpr("id AS location_id", "'b' AS borough", "'z' AS zone")
    found = enrich.lookup_map(cleaned, dim.unionByName(more), TRIPS)
    assert sorted(found.select(*enrich.lookup_all(cleaned, dim, TRIPS).columns).collect()) == expected
    with pytest.raises(ValueError, match="id_repeated"):
        enrich.lookup_map(cleaned, dim.unionByName(dim), TRIPS)
    assert not enrich.may_broadcast(enrich.BROADCAST_BYTES + 1) and not enrich.may_broadcast(None)
    assert enrich.may_broadcast(10, 10) and not enrich.may_broadcast(11, 10)


def test_zoned_times_stop_the_arrow_form_too(spark):
    row = tuple(PLAIN.values())
    types = {c: "timestamp" if c in TRIPS.times else "double" if c in TRIPS.floats else "bigint" for c in TRIPS.columns}
    zoned = spark.createDataFrame([row], ", ".join(f"{c} {t}" for c, t in types.items()))
    with pytest.raises(ValueError, match="Zoned"):
        clean_in_arrow(zoned, TRIPS)
    texts = spark.createDataFrame([row], ", ".join(f"{c} {t.replace('timestamp', 'timestamp_ntz')}" for c, t in types.items()))
    texts = texts.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in TRIPS.columns])
    bad = texts.selectExpr("* EXCEPT (VendorID)", "'two' AS VendorID").select(*TRIPS.columns)
    assert clean_in_arrow(texts.union(bad), TRIPS).collect() == cleaning.clean(texts, TRIPS).collect() != []
    stop = texts.selectExpr("* EXCEPT (tpep_pickup_datetime)", "concat(tpep_pickup_datetime, 'Z') AS tpep_pickup_datetime")
    with pytest.raises(PySparkException, match="time zone"):
        clean_in_arrow(stop, TRIPS).collect()


def test_zoned_parquet_file_is_refused(spark, trips):
    from factprep.sources import inventory

    table = pq.read_table(trips.second)
    i = table.schema.get_field_index("tpep_pickup_datetime")
    zoned = table.set_column(i, "tpep_pickup_datetime", table.column(i).cast(pa.timestamp("us", "UTC")))
    pq.write_table(zoned, f"{trips.folder}/third.parquet")
    with pytest.raises(ValueError, match="third.parquet has zoned timestamps"):
        inventory.check_files(inventory.file_inventory(spark, trips.folder), TRIPS)


def test_nanosecond_times_are_cut(spark, trips):
    table = pq.read_table(trips.second)
    times = [1672531200123456789, -1, -1_000_000_001, 10**18]
    for name, values in (("tpep_pickup_datetime", times), ("tpep_dropoff_datetime", [t + 60 * 10**9 for t in times])):
        table = table.set_column(table.schema.get_field_index(name), name, pa.array(values, pa.timestamp("ns")))
    pq.write_table(table, f"{trips.folder}/third.parquet")
    cleaned = read_heterogeneous(spark, trips.folder, TRIPS, cleaning.clean)
    assert cleaned.count() == trips.clean + 4
    found = {r.tpep_pickup_datetime for r in cleaned.where("tpep_pickup_datetime < '1971-01-01' OR "
                                                           "tpep_pickup_datetime = '2023-01-01 00:00:00.123456'").collect()}
    assert found == {
        datetime(2023, 1, 1, 0, 0, 0, 123456),
        datetime(1969, 12, 31, 23, 59, 59, 999999),
        datetime(1969, 12, 31, 23, 59, 58, 999999),
    }


def test_spellings_of_times(spark):
    """Each spelling beside ISO, with clocks of 12 and 24 hours; dates and hours that do not exist are null."""
    expected = {
        "2024-01-15 10:30:00.5": datetime(2024, 1, 15, 10, 30, 0, 500000),
        " 2024-01-15 ": datetime(2024, 1, 15),
        "01/15/2024 10:30:00 AM": datetime(2024, 1, 15, 10, 30),
        "1/5/2024 12:05 am": datetime(2024, 1, 5, 0, 5),
        "1/5/2024 12:05:01.25 PM": datetime(2024, 1, 5, 12, 5, 1, 250000),
        "2024/01/15 10:30": datetime(2024, 1, 15, 10, 30),
        "2024.1.15": datetime(2024, 1, 15),
        "15-Jan-2024 23:59:59.123456": datetime(2024, 1, 15, 23, 59, 59, 123456),
        "15 January 2024": datetime(2024, 1, 15),
        "Jan 15, 2024 1:02 pm": datetime(2024, 1, 15, 13, 2),
        "September 5 2024": datetime(2024, 9, 5),
        "20240115": datetime(2024, 1, 15),
        "20240115T103001": datetime(2024, 1, 15, 10, 30, 1),
        "20240115103001": datetime(2024, 1, 15, 10, 30, 1),
        "20240115 10:30": datetime(2024, 1, 15, 10, 30),
        **dict.fromkeys(["13/13/2024", "15 Foo 2024", "2024-13-01", "01/15/2024 13:00 PM", "01/15/2024 0:30 AM"]),
        **dict.fromkeys(["01/15/2024 10:61", "20241301", "10:30", "202401151030", "x", "", None]),
    }
    rows = spark.createDataFrame([(t,) for t in expected], "t string")
    read = rows.selectExpr("t", f"{C.coerce_timestamp('t', rows.schema['t'].dataType)} AS value").collect()
    assert {r.t: r.value for r in read} == expected


def test_rejected_spellings_are_reported(spark):
    texts = ["2023-01-01", "1/2/2023", "13/13/2023", "soon", " ", None, "soon"]
    rows = [("2", t, "2023-01-01", "1", "3", 1.0, 2, None, 12.0) for t in texts]
    told = cleaning.time_spellings(spark.createDataFrame(rows, RAW), TRIPS).where(f"column = '{TRIPS.start}'")
    assert sorted((r.spelling, r.row_count, r.unread) for r in told.collect()) == [
        ("iso", 1, 0), ("month/day/year", 2, 1), ("other", 2, 2)
    ]
    # Columns that are no text have no spelling.
    typed = spark.createDataFrame([], TRIPS.clean_schema())
    assert cleaning.time_spellings(typed, TRIPS).collect() == []
