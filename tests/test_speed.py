"""The native speed against Python's own rounding."""

import math
import random

import pytest

from factprep.functions.features import with_rounded
from factprep.functions.udfs import python_speed
from factprep.operators import profile


def _values():
    rng = random.Random(7)
    values = [rng.uniform(0, 200) for _ in range(20000)]
    values += [10 ** rng.uniform(-12, 12) for _ in range(20000)]
    # Near and exact ties in the sixth decimal, and their neighbours.
    ties = [(rng.randrange(10 ** rng.randrange(1, 12)) + 0.5) / 1e6 for _ in range(20000)]
    ties += [n / 2**k for k in range(1, 30) for n in (1, 3, 5, 12345, 2**k + 1)]
    values += ties + [math.nextafter(t, math.inf) for t in ties] + [math.nextafter(t, 0) for t in ties]
    # Around the points where the sixth decimal is lost.
    for edge in (2.0**32, 4503599627.370496, 2.0**33, 9007199254.740992, 1e300, 1.7e308):
        values += [edge, math.nextafter(edge, math.inf), math.nextafter(edge, 0)]
    values += [rng.uniform(4.5e9, 1.0e10) for _ in range(5000)]
    return values + [0.0, 5e-324, 4.9e-7, 5e-7, 5.000001e-7, float("inf")]


def test_rounds_as_python(spark):
    values = _values()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = with_rounded(df, "r", "v").collect()
    assert len(found) == len(values)
    assert [(v, r) for v, r in found if r != round(v, 6)] == []


def test_three_forms_agree(spark):
    rng = random.Random(11)
    rows = [(round(rng.uniform(0.01, 90), 2), rng.randrange(1, 10**11) / 1e6) for _ in range(5000)]
    df = spark.createDataFrame(rows, "d double, s double")
    for mode in ("native", "scalar", "arrow"):
        found = profile.speed(df, "d", "s", mode).collect()
        assert all(r.speed == round(r.d * 3600.0 / r.s, 6) for r in found), mode
    sums = {profile.checksum(profile.speed(df, "d", "s", m)).first() for m in ("native", "scalar", "arrow")}
    assert len(sums) == 1


def test_python_form():
    assert python_speed(3, 600) == 18
    for distance, duration in ((1.0, 0.0), (1.0, -1.0), (float("inf"), 1.0), (float("nan"), 1.0)):
        with pytest.raises(ValueError):
            python_speed(distance, duration)


def test_trial_totals_and_medians(spark):
    rows = [(b, t, float(t), 10.0 * t + b) for b in (0, 1) for t in (1, 2, 4)]
    measured = spark.createDataFrame(rows, "bucket int, trial int, baseline_seconds double, udf_seconds double")
    assert profile.trial_totals(measured).count() == 3
    row = profile.summary(measured).first()
    assert (row.trials, row.median_baseline_seconds, row.median_udf_seconds) == (3, 4.0, 41.0)
