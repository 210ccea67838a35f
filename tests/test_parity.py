from __future__ import annotations

import pytest

from factprep.contract import TRIPS
from factprep.operators import parity
from factprep.operators.quality import require_dimension
from factprep.plans import prepare as P
from factprep.sources.dimension import read_dimension
from factprep.sources.fact import read_heterogeneous
from factprep.sources.sinks import write_bucketed


@pytest.fixture
def output(spark, trips):
    dim = read_dimension(spark, trips.zones)
    raw = read_heterogeneous(spark, trips.folder, TRIPS)
    frame = P.transform(raw, dim, TRIPS, 8, require_dimension(dim)).coalesce(1).cache()
    yield frame
    frame.unpersist()


def test_equal_sides(output):
    assert parity.require_parity(output, output, TRIPS) == {"left_rows": 4, "right_rows": 4}
    assert parity.multiset_diff(output, output, TRIPS.output_columns).count() == 0


def test_missing_row(output):
    less = output.where("trip_distance <> 3.5")
    with pytest.raises(ValueError, match=r"mismatch: counts=\(1, 0\)"):
        parity.require_parity(output, less, TRIPS)
    found = parity.multiset_diff(output, less, TRIPS.output_columns).collect()
    assert [(r.trip_distance, r.lhs, r.rhs) for r in found] == [(3.5, 1, 0)]


def test_equal_duplicates_still_fail(output):
    doubled = output.unionByName(output.where("trip_distance = 3.5"))
    with pytest.raises(ValueError, match=r"duplicate: counts=\(2, 2\)"):
        parity.require_parity(doubled, doubled, TRIPS)
    assert parity.multiset_diff(doubled, doubled, TRIPS.output_columns).count() == 0
    assert parity.duplicates(doubled, doubled, TRIPS.output_columns).count() == 1


def test_sign_of_zero_and_last_bit_count(spark):
    def frame(*values):
        return spark.createDataFrame([(v,) for v in values], "v double")

    diff = parity.multiset_diff(frame(0.0, 0.1, 2.0, None), frame(-0.0, 0.1 + 2**-56, 2.0, None), ["v"])
    assert diff.count() == 4
    nan = float("nan")
    assert parity.multiset_diff(frame(nan, nan, 1.0), frame(nan, 1.0, nan), ["v"]).count() == 0


def test_audit(output):
    parity.require_clean_audit(output, TRIPS, 8)
    broken = {
        "value_missing": output.selectExpr("* EXCEPT (pickup_zone)", "CAST(NULL AS STRING) AS pickup_zone"),
        "float_not_finite": output.selectExpr("* EXCEPT (fare_amount)", "double('NaN') AS fare_amount"),
        "duration_differs": output.selectExpr("* EXCEPT (duration_seconds)", "duration_seconds + 1e-6D AS duration_seconds"),
        "hour_differs": output.selectExpr("* EXCEPT (pickup_hour)", "pickup_hour + 1 AS pickup_hour"),
        "speed_differs": output.selectExpr("* EXCEPT (average_speed_mph)", "average_speed_mph + 1e-6D AS average_speed_mph"),
        "wrong_bucket": output.selectExpr("* EXCEPT (bucket)", "(bucket + 1) % 8 AS bucket"),
        "not_positive": output.selectExpr(
            "* EXCEPT (tpep_dropoff_datetime)", "tpep_pickup_datetime AS tpep_dropoff_datetime"
        ),
    }
    for rule, df in broken.items():
        # A fare takes part in the bucket, a drop-off in the duration, and so on.
        counts = dict(parity.audit_rows(df, TRIPS, 8).collect())
        assert counts[rule] == 4, rule
    with pytest.raises(ValueError, match="hour_differs=4"):
        parity.require_clean_audit(broken["hour_differs"], TRIPS, 8)


def test_schema_must_be_exact(output):
    parity.check_schema(output, TRIPS, "bucket")
    for wrong in (output, output.drop("bucket", "pickup_hour"), output.selectExpr("* EXCEPT (bucket)").select(*TRIPS.output_columns[::-1])):
        with pytest.raises(ValueError, match="schema"):
            parity.check_schema(wrong, TRIPS)


def test_compare_files(spark, output, tmp_path):
    left, right, less = (str(tmp_path / n) for n in ("left", "right", "less"))
    write_bucketed(output, left)
    write_bucketed(output.coalesce(1), right, rebalance=False)
    write_bucketed(output.where("trip_distance <> 3.5"), less)
    found = P.compare(spark, left, right, buckets=8)
    assert found == {"exact_match": True, "bucket_count": 8, "left_rows": 4, "right_rows": 4}
    with pytest.raises(ValueError, match="mismatch"):
        P.compare(spark, left, less, buckets=8)
    with pytest.raises(ValueError, match="wrong_bucket"):
        P.compare(spark, left, right, buckets=16)
    moved = str(tmp_path / "moved")
    write_bucketed(output.selectExpr("* EXCEPT (bucket)", "(bucket + 1) % 8 AS bucket"), moved)
    with pytest.raises(ValueError, match="wrong_bucket"):
        P.compare(spark, left, moved, buckets=8)
    with pytest.raises(ValueError, match="number of buckets"):
        P.compare(spark, left, moved)
    with pytest.raises(ValueError, match="with itself"):
        P.compare(spark, left, f"{tmp_path}/less/../left", buckets=8)


def test_compare_refuses_other_layouts(spark, output, tmp_path):
    flat, left = str(tmp_path / "flat"), str(tmp_path / "left")
    output.drop("bucket").write.parquet(flat)
    write_bucketed(output, left)
    with pytest.raises(ValueError, match="outside the bucket folders"):
        P.compare(spark, left, flat, buckets=8)


def test_compare_refuses_a_file_of_other_types(spark, output, tmp_path):
    """Spark would widen the integers of one file silently."""
    left, right = str(tmp_path / "left"), str(tmp_path / "right")
    write_bucketed(output, left)
    narrow = output.selectExpr(*[f"CAST({c} AS INT) AS {c}" if c == "pickup_hour" else c for c in output.columns])
    write_bucketed(narrow, right)
    with pytest.raises(ValueError, match="Unexpected output schema in .*right"):
        P.compare(spark, left, right, buckets=8)
