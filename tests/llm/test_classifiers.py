import random

import numpy as np
import pytest
from llm.corpus import documents, empty_documents, odd_documents, prose

from factprep.llm import queries, quality, toxicity
from factprep.llm.common import labelled

LABELS = "doc_id long, quality int, toxic int"


def auc(rows, label):
    score = np.array([r.score for r in rows])
    y = np.array([r[label] for r in rows])
    _, at, n = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[at]
    ones = y.sum()
    return (rank[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


@pytest.mark.parametrize(("query", "label", "least"), [("op9_quality", "quality", 0.99), ("op2_toxicity", "toxic", 0.93)])
def test_held_out_rows_are_told_apart(spark, query, label, least):
    root = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{root}/labels.parquet")
    frame = queries.QUERIES[query](spark, root).cache()
    rows = frame.filter("held_out").join(labels, "doc_id").collect()
    assert auc(rows, label) >= least
    assert np.mean([r.predicted == r[label] for r in rows]) >= 0.97
    ends = frame.selectExpr("min(score) AS low", "max(score) AS high", "count(*) AS n").first()
    assert 0 <= ends.low and ends.high <= 1 and ends.n == spark.read.parquet(f"{root}/documents.parquet").count()
    frame.unpersist()


def test_only_rows_that_are_not_held_out_teach(spark):
    docs = documents(spark, [f"text {i}" for i in range(50)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(50)] + [(None, 1, 0), (7, 1, 0), (8, None, 0)], LABELS)
    import zlib

    taught = {int(r.text.split()[1]): r["__label"] for r in labelled(docs, labels, "quality").collect()}
    assert taught == {i: i % 2 for i in range(50) if zlib.crc32(str(i).encode()) % 5}
    some = labelled(docs, labels, "quality", most=9).collect()
    assert len(some) == 9


@pytest.mark.parametrize("module", [quality, toxicity])
@pytest.mark.parametrize("classes", [(), (0,), (1,), (0, 1)])
def test_odd_and_empty_tables(spark, module, classes):
    odd = odd_documents(spark)
    rows = [(f"text {c} number {i}" * (1 + i), c) for c in classes for i in range(4)] + [(None, c) for c in classes]
    model = module.fit(spark.createDataFrame(rows, "text string, __label int"))
    done = module.with_scores(odd, model)
    assert sorted(done.columns) == sorted(odd.columns) and done.count() == odd.count()
    scores = [r.score for r in done.collect()]
    assert all(0 <= s <= 1 for s in scores)
    if len(classes) < 2:
        assert np.allclose(scores, classes[0] if classes else 0.5)
    by_text = {}
    for r in done.collect():
        by_text.setdefault(r.text, set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert module.with_scores(empty_documents(spark), model).collect() == []


def test_discriminant_is_the_gaussian_posterior(spark):
    rng = random.Random(2)
    texts = [" ".join(prose(rng, rng.randint(5, 90))) for _ in range(60)]
    texts += [" ".join(prose(rng, rng.randint(5, 90))).upper() + "!" * rng.randint(0, 30) for _ in range(40)]
    rows = [(t, int(i < 60)) for i, t in enumerate(texts)]
    model = quality.fit(spark.createDataFrame(rows, "text string, __label int"))
    raw = np.array([quality.document_statistics(t.encode()) for t in texts])
    words = np.array([[len(t.split())] for t in texts])
    x = raw.mean(axis=0) + words / (words + 20) * (raw - raw.mean(axis=0))
    y = np.array([c for _, c in rows])
    own = [np.cov(x[y == c].T) for c in (0, 1)]
    pooled = sum(own[c] * ((y == c).sum() - 1) for c in (0, 1)) / (len(y) - 2) + 1e-9 * np.eye(x.shape[1])
    odds = np.zeros(len(x))
    for c, sign in ((0, -1), (1, 1)):
        s = 0.9 * own[c] + 0.1 * pooled
        s = 0.95 * s + 0.05 * np.diag(np.diag(s)) + 1e-6 * np.eye(len(s))
        d = x - x[y == c].mean(axis=0)
        odds += sign * (np.log((y == c).mean()) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d))
    assert np.allclose(model.score(raw), 1 / (1 + np.exp(-np.clip(odds, -500, 500))), atol=1e-6)


def slow_segments(scores):
    """Maximal-scoring segments by their recursive definition: the best one, then left and right of it."""
    def best(a, b):
        top = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-9 and (top is None or total > top[0] + 1e-9):
                    top = (total, i, j + 1)
        return top

    out, todo = [], [(0, len(scores))]
    while todo:
        a, b = todo.pop()
        if (found := best(a, b)) is not None:
            out.append(found)
            todo += [(a, found[1]), (found[2], b)]
    return sorted((i, j, round(t, 6)) for t, i, j in out)


@pytest.mark.parametrize("seed", range(30))
def test_scan_finds_all_maximal_segments(seed):
    rng = random.Random(seed)
    scores = [rng.choice([1.37, 2.11, 0.6]) if rng.random() < 0.3 else -0.45 for _ in range(rng.randint(0, 60))]
    hits = [(i, s) for i, s in enumerate(scores) if s > 0]
    found = sorted((a, b, round(t, 6)) for t, a, b in toxicity.scan(hits, -0.45))
    assert found == slow_segments(scores)


def test_scale_solves_its_equation():
    scores, shares = np.array([5.0, 3.0, -0.4]), np.array([0.001, 0.002, 0.997])
    scale = toxicity.karlin_scale(scores, shares)
    assert abs((shares * np.exp(scale * scores)).sum() - 1) < 1e-6


def test_passages_lie_where_toxic_words_are(spark):
    rng = random.Random(4)
    bad = ["scum", "moron", "trash"]
    rows = []
    for i in range(300):
        words = prose(rng, 120)
        if i % 5 == 0:
            words[50:58] = [rng.choice(bad) for _ in range(8)]
        rows.append((" ".join(words), int(i % 5 == 0)))
    model = toxicity.fit(spark.createDataFrame(rows, "text string, __label int"))
    assert set(bad) <= model.lexicon.keys()
    docs = documents(spark, [rows[0][0], rows[1][0]])
    first, second = (r.passages for r in toxicity.with_passages(docs, model).orderBy("doc_id").collect())
    assert [(p.start, p.tokens) for p in first] == [(50, 8)] and second == []
