import random

import numpy as np
import pytest
from llm.corpus import documents, empty_documents, odd_documents, prose

from factprep.llm import decontaminate


def slow_distance(item, words):
    """Least edit distance between the item and any run of the words."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        kind, at = rng.randint(0, 2), rng.randrange(len(words))
        if kind == 0:
            words[at] = f"e{rng.randint(0, 999)}"
        elif kind == 1 and len(words) > 1:
            del words[at]
        else:
            words.insert(at, f"e{rng.randint(0, 999)}")
    return words


@pytest.mark.parametrize("seed", range(5))
def test_nearest_run(seed):
    rng = np.random.default_rng(seed)
    for _ in range(40):
        item, words = rng.integers(1, 6, rng.integers(1, 12)), rng.integers(0, 6, rng.integers(1, 25))
        distance, start, end = decontaminate.best_run(item, words)
        assert distance == slow_distance(item.tolist(), words.tolist())
        row = list(range(end - start + 1))  # edit distance to the run itself
        for i, a in enumerate(item.tolist(), 1):
            new = [i]
            for j, b in enumerate(words[start:end].tolist(), 1):
                new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
            row = new
        assert row[-1] == distance


def planted(seed, count=260):
    rng = random.Random(seed)
    items = [prose(rng, rng.randint(5, 60)) for _ in range(25)]
    texts = []
    for _ in range(count):
        text = prose(rng, rng.randint(0, 200))
        if rng.random() < 0.5:
            item = rng.choice(items)
            at = rng.randint(0, len(text))
            text[at:at] = edited(rng, item, rng.randint(0, int(0.25 * len(item))))
        texts.append(text)
    return items, texts


def test_recall_and_exactness_against_all_pairs():
    items, texts = planted(3)
    block = decontaminate.build_block([" ".join(i) for i in items])
    found = decontaminate.search([" ".join(t) for t in texts], block)
    found = {(d, number): distance for d, rows in enumerate(found) for number, _, _, distance in rows}
    expected, whole = {}, 0
    for d, text in enumerate(texts):
        for number, item in enumerate(items):
            distance = slow_distance(item, text)
            if distance <= decontaminate.edits_allowed(len(item), 0.8):
                expected[d, number] = distance
    assert len(expected) > 60
    assert found.keys() <= expected.keys()  # verified exactly
    assert len(found) >= 0.95 * len(expected)
    exact = {k for k, distance in expected.items() if distance == 0}
    assert exact <= found.keys()


def test_windows_of_shared_runs_lose_no_match():
    items, texts = planted(5)
    block = decontaminate.build_block([" ".join(i) for i in items])
    for text in texts:
        ids = np.array([block.vocabulary.get(w, 0) for w in text], np.int64)
        sizes = {size for _, size in decontaminate.windows_of(ids, block)} if len(ids) else set()
        for item in items:
            if text and slow_distance(item, text) <= decontaminate.edits_allowed(len(item), 0.8):
                assert len(item) in sizes


def test_walk_keeps_near_sequences_near():
    rng = np.random.default_rng(1)
    rows = rng.integers(1, 500, (200, 40))
    near, far = rows.copy(), rng.integers(1, 500, (200, 40))
    near[:, 20] = 0
    walk = lambda x: decontaminate.embed(x, 0, 999)
    assert (walk(rows) != walk(near)).mean() < 0.15 < 0.6 < (walk(rows) != walk(far)).mean()


def test_case_punctuation_and_blocks_dont_matter(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    items = ["One two three four five six seven.", "", None, "alpha beta gamma\ndelta epsilon zeta", "tiny"]
    docs = documents(spark, ["x ONE!! two, three\nFour | five six; SEVEN y", "alpha beta gamma delta", "tiny", "no", None])
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.first_word, r.words, r.distance) for r in decontaminate.contaminations(docs, benchmark).collect()}
    assert found == {(0, 0, 1, 7, 0), (2, 4, 0, 1, 0)}
    assert {r.doc_id for r in decontaminate.decontaminate(docs, benchmark).collect()} == {1, 3, 4}


def test_odd_and_empty_tables(spark):
    benchmark = spark.createDataFrame([(1, "word"), (1, "word"), (None, "x y z v w")], "item_id long, text string")
    odd = odd_documents(spark)
    rows = decontaminate.contaminations(odd, benchmark).collect()
    assert {r.doc_id for r in rows} == {3} and len(rows) == 6
    kept = decontaminate.decontaminate(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(odd, nothing).count() == odd.count()
    assert decontaminate.contaminations(empty_documents(spark), benchmark).collect() == []


def test_planted_items_of_the_tables(spark):
    root = "/root/testdata/sf0.001"
    docs, benchmark = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r.item_id: r.text for r in benchmark.collect()}
    expected = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if t in r.text}
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminations(docs, benchmark).collect()}
    assert expected and expected <= found


def limit_edits(rng, words, kind):
    """The words after the allowed number of edits of a kind, each elsewhere."""
    words, edits = list(words), decontaminate.edits_allowed(len(words), 0.8)
    for at in sorted(rng.sample(range(len(words)), edits), reverse=True):
        words[at : at + 1] = {"swap": ["e"], "delete": [], "insert": ["e", words[at]]}[kind]
    return words


@pytest.mark.parametrize("size", [15, 30, 59])
def test_recall_holds_for_each_kind_of_edit_within_texts_and_at_their_end(size):
    rng = random.Random(size)
    items = [[f"w{rng.randrange(3000)}" for _ in range(size)] for _ in range(150)]
    block = decontaminate.build_block([" ".join(i) for i in items])
    for kind in ("swap", "delete", "insert"):
        for place in ("within", "end"):
            texts = []
            for item in items:
                before, after = ([f"w{rng.randrange(3000)}" for _ in range(40)] for _ in range(2))
                texts.append(" ".join(before + limit_edits(rng, item, kind) + (after if place == "within" else [])))
            met = sum(n in {m[0] for m in rows} for n, rows in enumerate(decontaminate.search(texts, block)))
            assert met >= 0.92 * len(items), (kind, place)


def test_long_items_are_met_as_well():
    rng, size = random.Random(5), 300
    items = [[f"w{rng.randrange(3000)}" for _ in range(size)] for _ in range(25)]
    block = decontaminate.build_block([" ".join(i) for i in items])
    assert block.sampled[size] < decontaminate.SAMPLED
    texts = [" ".join(limit_edits(rng, item, rng.choice(["swap", "delete", "insert"]))) for item in items]
    found = decontaminate.search(texts, block)
    assert sum(n in {m[0] for m in rows} for n, rows in enumerate(found)) >= 0.92 * len(items)


def test_where_no_keys_reach_the_target_every_window_is_verified(monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_REPEATS", 1)
    items, texts = planted(7, 60)
    items, texts = [i for i in items if len(i) > 20][:4], [" ".join(t) for t in texts]
    block = decontaminate.build_block([" ".join(i) for i in items])
    assert set(block.sampled.values()) == {0}
    found = {(d, m[0]) for d, rows in enumerate(decontaminate.search(texts, block)) for m in rows}
    near = lambda item, t: slow_distance(item, t.split()) <= decontaminate.edits_allowed(len(item), 0.8)
    assert found == {(d, n) for d, t in enumerate(texts) for n, item in enumerate(items) if near(item, t)}


def test_items_of_many_words():
    """Codes of runs fit 64 bits whatever the vocabulary, and only admit more windows."""
    for base in (3, 65_536, 65_537, 70_003, 2**21 + 1, 2**22, 2**33):
        run = decontaminate.run_limit(base)
        assert base**run <= 2**64 or run == 1
    item = np.arange(1, 70_001)
    runs = decontaminate.shared_runs([item, item[:30]], 70_002, 0.8)
    vocabulary = {str(i): i for i in range(1, 70_001)}
    block = decontaminate.Block(vocabulary, [], 0.8, runs, {}, {}, {})
    text = np.concatenate([np.zeros(50, np.int64), item[:30], np.zeros(9, np.int64)])
    assert (50, 30) in decontaminate.windows_of(text, block)
