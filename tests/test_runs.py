"""Run records, spreads, running totals and resource peaks against plain Python."""

from __future__ import annotations

import random
import statistics
from itertools import accumulate

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from factprep.operators import ranking, resources, runlog
from factprep.sources.samples import SAMPLE, read_samples


def test_running_total(spark):
    rng = random.Random(3)
    keys = rng.sample(range(10**6), 5000)
    rows = [(k // 1000, k, rng.randrange(100)) for k in keys]
    df = spark.createDataFrame(rows, "a int, b int, n bigint")
    found = {r.b: r.running for r in ranking.running_total(df, ["a", "b"], "n").collect()}
    ordered = sorted(rows)
    assert found == dict(zip((r[1] for r in ordered), accumulate(r[2] for r in ordered)))


def test_ranges_cut_again_stay_near_their_size(spark, monkeypatch):
    """More ranges than bounds fit in a plan: exact totals still, ranges in order, none many times too large."""
    monkeypatch.setattr(ranking, "RANGE_ROWS", 40)
    monkeypatch.setattr(ranking, "MOST_RANGES", 8)
    monkeypatch.setattr(ranking, "SAMPLED", 4)
    rng = random.Random(11)
    # Half of all keys lie in a hundredth of the space.
    keys = rng.sample(range(10**8), 5000) + rng.sample(range(10**8, 10**8 + 10**6), 5000)
    rows = [(f"k{k // 10**6:04}", k, rng.randrange(-50, 100)) for k in keys]
    df = spark.createDataFrame(rows, "a string, b bigint, n bigint").repartition(5)
    found = {r.b: r.running for r in ranking.running_total(df, ["a", "b"], "n").collect()}
    ordered = sorted(rows)
    assert found == dict(zip((r[1] for r in ordered), accumulate(r[2] for r in ordered)))
    placed = ranking._ranged(df, ["a", "b"]).orderBy("a", "b").collect()
    parts = [(r["__wide"], r["__part"]) for r in placed]
    assert parts == sorted(parts)
    sizes = [parts.count(p) for p in set(parts)]
    assert len(sizes) > 100 and max(sizes) < 8 * 40
    assert {r["__wide"] for r in placed} == set(range(8))


def test_range_bounds_are_searched_not_scanned(spark):
    df = spark.createDataFrame([(k,) for k in range(100)], "k bigint")
    bounds = [10, 10, 30, 70]
    literal = F.array(*[F.struct(F.lit(b).cast("bigint").alias("k")) for b in bounds])
    found = df.select("k", ranking._passed(literal, F.struct("k"), len(bounds) + 1).alias("n")).collect()
    assert [(r.k, r.n) for r in found] == [(k, sum(b <= k for b in bounds)) for k in range(100)]


def test_running_total_of_nothing(spark):
    assert ranking.running_total(spark.createDataFrame([], "k int, n bigint"), ["k"], "n").collect() == []


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_spread_is_exact(spark, hot):
    """With ``hot``, two fifths of all rows are one value of one group."""
    rng = random.Random(5)
    rows = [("hot", 1.25)] * int(4000 * hot)
    rows += [(rng.choice("abc"), rng.choice([rng.uniform(0, 9), float(rng.randrange(5))])) for _ in range(3001)]
    rows += [("hot", rng.uniform(0, 3)) for _ in range(200)] + [("one", 7.0), ("two", 1.0), ("two", 2.0)]
    found = {r.g: r for r in ranking.spread(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()}
    groups = {g: [v for h, v in rows if h == g] for g, _ in rows}
    assert set(found) == set(groups)
    for g, values in groups.items():
        assert found[g].trials == len(values)
        assert found[g].median == statistics.median(values)
        assert (found[g].minimum, found[g].maximum) == (min(values), max(values))


def _runs(spark, *rows):
    fields = "framework string, run_id string, status string, benchmark_eligible boolean, contract string, output_rows int"
    return spark.createDataFrame(list(rows), fields)


def test_comparable(spark):
    fields = ["contract", "output_rows"]
    good = ("a", "1", "complete", True, "c", 3)
    runlog.require_comparable(_runs(spark, good, ("b", "1", "complete", True, "c", 3)), fields)
    for other, reason in (
        (good, "listed_twice"),
        (("b", "1", "running", True, "c", 3), "not_complete"),
        (("b", "1", "complete", False, "c", 3), "not_eligible"),
        (("b", "1", "complete", None, "c", 3), "not_eligible"),
        (("b", "1", "complete", True, "d", 3), "different_contract"),
        (("b", "1", "complete", True, "c", None), "different_output_rows"),
    ):
        found = runlog.comparable(_runs(spark, good, other), fields).collect()
        assert [(r.reason, r.row_count) for r in found] == [(reason, 1)]
        with pytest.raises(ValueError, match=reason):
            runlog.require_comparable(_runs(spark, good, other), fields)


def _sample(second, node, cpu=50.0, cores=2, memory=1 << 30, run="r", framework="f"):
    return ("", second, framework, run, node, cpu, cores, memory, 0, 0, 0)


def _span(spark, *rows):
    fields = "framework string, run_id string, timed_start_epoch double, timed_end_epoch double"
    return spark.createDataFrame(list(rows), fields)


def test_peaks(spark, tmp_path):
    rows = [
        _sample(9.9, "n1", cpu=100.0),  # before the run
        _sample(10.0, "n1", cpu=10.0, cores=2),
        _sample(10.7, "n2", cpu=40.0, cores=6),
        _sample(11.2, "n1", cpu=99.0),  # n2 is missing in this second
        _sample(12.1, "n1", cpu=30.0, cores=2, memory=3 << 30),
        _sample(12.4, "n2", cpu=30.0, cores=6, memory=1 << 30),
        _sample(12.5, "n3", cpu=100.0),  # not a listed node
        _sample(12.5, "n1", cpu=100.0, run="other"),
        _sample(13.0, "n1", cpu=100.0),
        _sample(13.1, "n2", cpu=100.0),  # after the run
    ]
    path = str(tmp_path / "samples")
    spark.createDataFrame(rows, SAMPLE).write.option("header", True).csv(path)
    runs = _span(spark, ("f", "r", 10.0, 13.0), ("f", "none", 10.0, 13.0))
    found = {r.run_id: r for r in resources.peaks(read_samples(spark, path), runs, ["n1", "n2"]).collect()}
    assert (found["r"].peak_cpu_percent, found["r"].peak_memory_gib) == ((10.0 * 2 + 40.0 * 6) / 8, 4.0)
    assert found["r"].resource_samples == 2
    assert (found["none"].peak_cpu_percent, found["none"].peak_memory_gib) == (None, None)
    assert found["none"].resource_samples == 0


def test_two_samples_of_a_node_in_a_second(spark):
    df = spark.createDataFrame([_sample(10.1, "n1"), _sample(10.8, "n1"), _sample(10.5, "n2")], SAMPLE)
    runs = _span(spark, ("f", "r", 10.0, 13.0))
    timed = resources.in_interval(df, runs, ["n1", "n2"])
    assert [(r.node, r.samples) for r in resources.repeated_samples(timed).collect()] == [("n1", 2)]
    with pytest.raises(PySparkException, match="More than one sample per second from node n1"):
        resources.peaks(df, runs, ["n1", "n2"]).collect()
