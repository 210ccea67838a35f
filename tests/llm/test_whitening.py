from __future__ import annotations

import math

import numpy as np
import pytest

from factprep.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(vectors, most=8):
    x = np.floor(np.array(vectors, np.float32).astype(float) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    deviations = ((n * x - sums) ** 2).sum(axis=1)
    return centred @ axes / np.sqrt(values), values / np.trace(covariance), deviations


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    return (rng.normal(size=(3000, 12)) @ rng.normal(size=(12, 12)) + 5).astype(np.float32)


def test_equals_a_local_computation(spark, vectors):
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], SCHEMA).repartition(7)
    done = whitening.whitened(frame).toPandas()
    expected, shares, deviations = slow(vectors)
    assert len(done) == 8 * len(vectors) and set(done.n) == {len(vectors)}
    found = done.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    signs = np.sign((found * expected).sum(axis=0))
    assert np.abs(found * signs - expected).max() < 1e-9
    first = done[done.component == 1].sort_values("vec_id")
    assert first.deviation.tolist() == deviations.tolist()
    explained = done.drop_duplicates("component").sort_values("component").explained.to_numpy()
    assert np.abs(explained - shares).max() < 1e-12
    assert done.identity_error.nunique() == 1 and done.identity_error[0] < 1e-9


def test_several_blocks(spark, vectors, monkeypatch):
    monkeypatch.setattr(whitening, "FEWEST_ROWS", 64)
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], SCHEMA)
    table = whitening.indexed(frame, "vec_id", "embedding")
    assert sorted(r[0] for r in table.select("index").collect()) == list(range(len(vectors)))
    matrix = whitening.block_matrix(table, whitening.sums_of(table).means, len(vectors))
    assert matrix.numRowBlocks > 40
    x = np.floor(vectors.astype(float) * 1024) + 100_000
    centred = x - x.mean(axis=0)
    assert np.allclose(whitening.scatter(matrix), centred.T @ centred, rtol=1e-10)


def test_bounds_of_blocks():
    assert whitening.block_rows(100, 64) == whitening.FEWEST_ROWS
    assert whitening.block_rows(10**7, 64) * 64 * 8 <= whitening.BLOCK_BYTES
    assert 10**12 / whitening.block_rows(10**12, 64) <= whitening.MOST_BLOCKS


def test_unusable_rows_are_dropped(spark):
    rng = np.random.default_rng(3)
    good = [(i % 3 or None, [float(v) for v in rng.normal(size=3)], 1) for i in range(9)]
    bad = [[math.nan, 1.0, 2.0], [math.inf, 1.0, 2.0], [-math.inf, 0.0, 0.0], [None, 1.0, 2.0], [], None]
    frame = spark.createDataFrame(good + [(50 + i, v, 1) for i, v in enumerate(bad)], SCHEMA)
    done = whitening.whitened(frame).collect()
    expected, _, deviations = slow([v for _, v, _ in good])
    assert len(done) == 3 * 9 and {r.n for r in done} == {9}
    key = lambda v: (v is None, v or 0)
    assert sorted((key(r.vec_id), r.deviation) for r in done if r.component == 1) == sorted(
        (key(g[0]), int(d)) for g, d in zip(good, deviations)
    )
    assert np.allclose(sorted(abs(r.whitened) for r in done), np.sort(np.abs(expected).ravel()))


def test_rows_without_spread_and_without_rows(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0], 1)] * 4, SCHEMA)).collect() == []
    # Two unlike vectors, often repeated, span one component; columns of the same names do not matter.
    two = [(1, [1.0, 2.0], 1), (2, [3.0, 5.0], 1)] * 5
    named = spark.createDataFrame(two, SCHEMA).selectExpr("*", "1 AS index", "2 AS x", "3 AS component", "4 AS n")
    done = whitening.whitened(named).collect()
    assert len(done) == 10 and all(abs(abs(r.whitened) - 1) < 1e-9 and r.explained == pytest.approx(1) for r in done)


def test_unlike_lengths_are_refused(spark):
    with pytest.raises(ValueError, match="one length"):
        whitening.whitened(spark.createDataFrame([(1, [1.0], 1), (2, [1.0, 2.0], 1)], SCHEMA))
