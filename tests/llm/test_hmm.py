import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.corpus import documents, empty_documents, odd_documents, prose

from factprep.llm import hmm


def tiny(seed, states=3, symbols=5):
    rng = np.random.default_rng(seed)
    normal = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hmm.Model(normal(rng.random(states), 0), normal(rng.random((states, states)), 1), normal(rng.random((symbols, states)), 0))


def paths(sequence, model):
    """(probability, states) of every path."""
    for states in itertools.product(range(len(model.start)), repeat=len(sequence)):
        p = model.start[states[0]] * model.emissions[sequence[0], states[0]]
        for t in range(1, len(sequence)):
            p *= model.moves[states[t - 1], states[t]] * model.emissions[sequence[t], states[t]]
        yield p, states


SEQUENCES = [np.array(s) for s in ([0], [1, 2, 3], [4, 4, 0, 1, 2], [3, 1], [2, 2, 2], [0, 1, 2, 3, 4, 0])]


@pytest.mark.parametrize("seed", range(3))
def test_likelihood_and_counts_are_sums_over_all_paths(seed):
    model = tiny(seed)
    assert np.allclose(hmm.log_likelihoods(*flat(SEQUENCES), model), [math.log10(sum(p for p, _ in paths(s, model))) for s in SEQUENCES])
    starts, moves, emissions = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for s in SEQUENCES:
        total = sum(p for p, _ in paths(s, model))
        for p, states in paths(s, model):
            starts[states[0]] += p / total
            for t, k in enumerate(states):
                emissions[s[t], k] += p / total
                if t:
                    moves[states[t - 1], k] += p / total
    for found, expected in zip(hmm.expected_counts(*flat(SEQUENCES), model), (starts, moves, emissions), strict=True):
        assert np.allclose(found, expected, atol=1e-4)


def flat(sequences):
    return np.concatenate(sequences), np.array([len(s) for s in sequences])


def corpus(count=120):
    rng = random.Random(9)
    texts = [" ".join(w if rng.random() < 0.9 else f"R{rng.randint(0, 10**6)}." for w in prose(rng, rng.randint(0, 60))) for _ in range(count)]
    return texts + [None, "", "Only-Unseen ÄÖ words"]


def test_counts_and_base_scores(spark):
    texts = corpus()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    split = lambda t: [*(t or "").encode().lower().split(), "end"]
    counts = Counter(w for i, t in enumerate(texts) if not held[i] for w in split(t))
    n, v = sum(counts.values()), len(counts)
    rows = hmm.scored(documents(spark, texts), head=50, states=3, rounds=2).collect()
    assert len(rows) == len(texts) and any(held.values())
    for r in rows:
        words = split(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(words), n)
        assert r.n_known == sum(counts[w] > 0 for w in words)
        assert abs(r.base_score - sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)) < 1e-9 * len(words) + 1e-9


def test_scores_are_those_of_the_model(spark):
    docs = documents(spark, corpus())
    training = docs.filter(~hmm.held_out())
    counts = hmm.word_counts(training).cache()
    words = hmm.vocabulary(counts, training.count(), 50)
    encoded = hmm.encode_texts(docs, words).cache()
    model = hmm.train(encoded.filter("NOT held_out"), words, 3, 2)
    every = {bytes(r.word): r.n for r in counts.collect()}
    numbers = {w: i for i, w in enumerate(words.words)}
    rest = [w for w in every if w not in numbers]
    for r in hmm.score(encoded, words, counts, model).collect():
        text = corpus()[r.doc_id]
        tokens = hmm.tokens(None if text is None else text.encode())
        expected = hmm.log_likelihoods(*flat([np.array(hmm.encode(tokens, numbers)[0])]), model)[0]
        for w in tokens:
            if w not in numbers:
                same = [x for x in rest if hmm.word_class(x) == hmm.word_class(w)]
                once = sum(n == 1 and hmm.word_class(x) == hmm.word_class(w) for x, n in every.items())
                expected += math.log10((every.get(w, 0) + 1) / (sum(every[x] for x in same) + len(same) + once + 1))
        assert abs(r.score - expected) < 1e-6 * len(tokens) + 1e-6


def test_training_raises_the_likelihood(spark, monkeypatch):
    monkeypatch.setattr(hmm, "PRIOR", 1e-3)
    monkeypatch.setattr(hmm, "TRANSITION_PRIOR", 1e-3)
    docs = documents(spark, corpus(60))
    counts = hmm.word_counts(docs)
    words = hmm.vocabulary(counts, docs.count(), 10_000)
    numbers = {w: i for i, w in enumerate(words.words)}
    sequences = [np.array(hmm.encode(hmm.tokens((t or "").encode()), numbers)[0]) for t in corpus(60)]
    encoded = hmm.encode_texts(docs, words).cache()
    likely = [hmm.log_likelihoods(*flat(sequences), hmm.train(encoded, words, 4, n)).sum() for n in (1, 2, 4)]
    assert likely[0] < likely[1] < likely[2]


def test_beats_word_counts_on_held_out_text(spark):
    rows = hmm.scored(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    rows = hmm.scored(odd, head=2, states=2, rounds=1).collect()
    assert len(rows) == odd.count() and all(r.score <= 0 and r.base_score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert len({(r.base_score, r.score) for r in rows if r.doc_id == 5}) == 1
    assert hmm.scored(empty_documents(spark)).collect() == []
    held = documents(spark, ["a b", "c"], ids=[i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2][:2])
    alone = hmm.scored(held, states=2, rounds=1).orderBy("doc_id").collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in alone] == [(0, 0, 0.0)] * 2


@pytest.mark.parametrize("most", [1, 7, 40, 333, 334, 2000])
def test_most_frequent_words_are_cut_by_histograms(spark, most):
    rng = random.Random(3)
    counts = [(f"w{i}".encode(), int(rng.paretovariate(0.7))) for i in range(1000)]
    found = hmm.most_frequent(spark.createDataFrame(counts, "word binary, n long"), most).collect()
    assert len({bytes(r.word) for r in found}) == len(found) == min(most, 1000)
    assert sorted((r.n for r in found), reverse=True) == sorted((n for _, n in counts), reverse=True)[:most]
