import hashlib
import random
import re

import pytest
import xxhash
from llm.corpus import documents, empty_documents, odd_documents
from pyspark.sql import functions as F

from factprep.llm import fingerprints

PAIRS = {"near_edited": ("own", "edited"), "near_next": ("own", "next")}


def digests(text):
    return {xxhash.xxh64_intdigest(p.encode(), 42) for p in re.findall(r"[^\n]{1,240}[^\n.!?]*[.!?]*", text)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def texts_of(seed, count, most=40):
    rng = random.Random(seed)
    lines = ["".join(rng.choices("abcdé .,!", k=rng.randint(0, 400))) for _ in range(120)]
    return ["\n".join(rng.choices(lines, k=rng.randint(0, most))) for _ in range(count)]


def check(rows, texts):
    ids = sorted(texts, reverse=True)
    for r in rows:
        own, following = texts[r.doc_id], texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        assert r.n_chars == len(own)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(digests(own), digests(edited))) < 1e-12
        assert abs(r.near_next - jaccard(digests(own), digests(following))) < 1e-12


@pytest.mark.parametrize(("seed", "settings"), [(1, {}), (2, {"IN_PLACE": 4}), (3, {"IN_PLACE": 0, "DEALT": 64}), (4, {"IN_PLACE": 0, "DEALT": 512})])
def test_likeness_is_the_jaccard_index_of_paragraphs(spark, monkeypatch, seed, settings):
    for name, value in settings.items():
        monkeypatch.setattr(fingerprints, name, value)
    texts = dict(zip([7 * i * i - 900 for i in range(60)], texts_of(seed, 60), strict=True))
    docs = documents(spark, list(texts.values()), ids=list(texts))
    check(fingerprints.with_likeness(fingerprints.compared_with_edits(docs), PAIRS).collect(), texts)


def test_long_texts_take_retries(spark):
    texts = dict(enumerate(["\n".join(f"line {i} {j}" for j in range(3000)) for i in range(3)]))
    docs = documents(spark, list(texts.values()))
    check(fingerprints.with_likeness(fingerprints.compared_with_edits(docs), PAIRS).collect(), texts)


def test_next_ids_cross_ranges(spark):
    rng = random.Random(6)
    ids = {rng.randint(-(10**6), 10**6) for _ in range(500)} | set(range(700)) | {2**40, -(2**50)}
    frame = spark.createDataFrame([(i,) for i in ids], "__id long")
    order = sorted(ids, reverse=True)
    expected = dict(zip(order, order[1:] + order[:1], strict=True))
    assert {r["__id"]: r["__next"] for r in fingerprints.next_ids(frame).collect()} == expected


def test_peeling_recovers_the_differing_digests(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(80):
        both = [rng.getrandbits(63) for _ in range(rng.randint(0, 300))]
        rows.append((both + [rng.getrandbits(63) for _ in range(rng.randint(0, 12))], both + [rng.getrandbits(63) for _ in range(rng.randint(0, 9))]))
    frame = spark.createDataFrame(rows, "a array<long>, b array<long>")
    found = frame.withColumn("p", F.expr(fingerprints.peeled_sql("a", "b"))).collect()
    good = [r for r in found if r.p is not None]
    assert len(good) >= 78
    assert all(set(r.p.left) == set(r.a) - set(r.b) and set(r.p.right) == set(r.b) - set(r.a) for r in good)


def test_a_sketch_that_is_too_small_says_so(spark):
    frame = spark.createDataFrame([(list(range(200)), [])], "a array<long>, b array<long>")
    assert frame.select(F.expr(fingerprints.peeled_sql("a", "b")).alias("p")).first().p is None


def test_equal_texts_have_equal_fingerprints(spark):
    texts = texts_of(5, 6)
    docs = documents(spark, texts + texts)
    rows = fingerprints.compared_with_edits(docs).select("doc_id", fingerprints.fingerprint("own").alias("f")).collect()
    by_text = {}
    for r in rows:
        by_text.setdefault((texts + texts)[r.doc_id], set()).add(r.f)
    assert all(len(f) == 1 for f in by_text.values()) and len(set.union(*by_text.values())) == len(set(texts))


def test_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    rows = fingerprints.with_likeness(fingerprints.compared_with_edits(odd), PAIRS).collect()
    assert len(rows) == odd.count()
    # After the null ids comes the largest id; the next of id 4 is id 3, of whose texts the least counts.
    after = {r.doc_id: r for r in rows}
    assert after[4].near_next == 0 and after[1].near_next == 1
    assert fingerprints.compared_with_edits(empty_documents(spark)).collect() == []
    alone = fingerprints.with_likeness(fingerprints.compared_with_edits(documents(spark, ["one\ntwo"])), PAIRS).first()
    assert alone.near_next == 1.0


def test_neighbours_of_sparse_ids(spark):
    rng = random.Random(9)
    ids = sorted({rng.getrandbits(64) - 2**63 for _ in range(500)}, reverse=True)
    frame = spark.createDataFrame([(i,) for i in ids * 2], "__id long")
    found = {r["__id"]: (r["__next"], r["__rows"]) for r in fingerprints.next_ids(frame).collect()}
    assert found == {i: (n, 2) for i, n in zip(ids, [*ids[1:], ids[0]], strict=True)}
