from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm.corpus import documents, empty_documents, odd_documents, prose

from factprep.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ITEMS = "item_id long, text string"


def slow(docs, items, most=10):
    """Every document against every item."""
    texts = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n = sum(1 for _, c in texts if c)
    total = sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    rows = []
    for number, (item, text) in enumerate(items):
        scored = []
        for doc, counts in texts:
            m = 10 + 90 * sum(counts.values()) * n // max(1, total)
            score = 0
            for term in set(TERM.findall((text or "").translate(LOWER))):
                tf = counts[term]
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                score += w * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        best = sorted(scored, key=lambda r: r[:3])[:most]
        rows += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(best, 1)]
    return rows


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v or 0) for v in r))


def check(spark, docs, items, most=10):
    frame = spark.createDataFrame(items, ITEMS)
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    assert order(lexical.ranked(docs, frame, most).collect()) == order(slow(pairs, items, most))


@pytest.fixture
def corpus():
    rng = random.Random(5)
    texts = [" ".join(prose(rng, rng.randrange(0, 120))) for _ in range(700)]
    # Copies, so that many scores are equal, and passages of documents as items.
    texts += texts[:40] * 3
    items = [(i, " ".join(texts[rng.randrange(700)].split()[:20])) for i in range(45)]
    return texts, items


def test_ranks_are_those_of_all_pairs(spark, corpus):
    texts, items = corpus
    check(spark, documents(spark, texts).repartition(5), items)
    check(spark, documents(spark, texts).repartition(3), items, most=1)


def test_blocks_and_small_trees_change_nothing(spark, corpus, monkeypatch):
    texts, items = corpus
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 60)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 9)
    monkeypatch.setattr(lexical, "TREE_ENTRIES", 500)
    assert len(list(lexical.blocks(spark.createDataFrame(items, ITEMS)))) > 4
    check(spark, documents(spark, texts), items)


def test_batches_are_pruned(corpus):
    """With a passage of its own in a few documents, an item need not meet every other document."""
    rng = np.random.default_rng(1)
    rows = 20_000
    terms = np.sort(rng.integers(0, 200, (rows, 4)), axis=1)
    terms[:12] = [200, 201, 202, 203]
    sparse = lexical.Sparse(np.arange(rows + 1) * 4, terms.ravel(), np.full(rows * 4, 1000))
    search = lexical.Search([np.array([0, 200, 201, 202, 203])], np.full(204, 100, np.int64), 10)
    search.add(sparse, np.arange(rows), np.zeros(rows, np.int64))
    ((_, best),) = search.results()
    assert best[:, 2].tolist() == list(range(10))
    assert search.compared < rows / 10


def test_terms():
    text = "Ünder_score ÄB'c9 x y\x7fZ\x00É"
    assert [t.decode() for t in lexical.terms_of(text.encode())] == TERM.findall(text.translate(LOWER))


def test_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    items = [(7, "the same word"), (7, "the same word"), (None, "null id text"), (8, None), (9, "!"), (10, "absent")]
    check(spark, odd, items)
    extra = spark.createDataFrame([(1, "word", 2)], "item_id long, text string, rank int")
    assert lexical.ranked(odd, extra).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical.ranked(empty_documents(spark), extra).collect() == []
    assert lexical.ranked(odd, spark.createDataFrame([], ITEMS)).collect() == []
