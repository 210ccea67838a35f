import random

import numpy as np
import pytest
import xxhash
from llm.corpus import documents, empty_documents, odd_documents, prose

from factprep.llm import simhash

ASCII_SPACE = " \t\n\r\x0b\x0c"


def slow_fingerprint(text, shingle=4):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in ASCII_SPACE:
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    n = min(shingle, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, distance=4):
    """rows: (id, fingerprint); the least id reachable."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, f"{print_:016x}", least.get(find(i))) for i, (doc, print_) in enumerate(rows)]


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("text", [None, "", "  ", "One", "ÄÖ ä b c d", "a B\x0bc\x0cd\te\nf " * 9, "a b c", "x" * 9])
def test_fingerprint(text):
    found = simhash.simhash(None if text is None else text.encode())
    assert found % 2**64 == slow_fingerprint(text)


def test_fingerprint_of_a_text_longer_than_a_chunk():
    text = " ".join(prose(random.Random(1), simhash.CHUNK + 500, 900))
    assert simhash.simhash(text.encode()) % 2**64 == slow_fingerprint(text)


def near_texts(seed, count=220):
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        if texts and rng.random() < 0.6:
            words = rng.choice(texts[-40:]).split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"n{rng.randint(0, 99)}"
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(prose(rng, rng.randint(1, 300))))
    return texts


@pytest.mark.parametrize("block", [1024, 3])
def test_components_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "LEAST_BLOCK", block)
    monkeypatch.setattr(simhash, "MOST_BLOCK", block)
    texts = near_texts(block)
    found = simhash.near_duplicates(documents(spark, texts)).collect()
    expected = slow_components([(i, slow_fingerprint(t)) for i, t in enumerate(texts)])
    assert order(map(tuple, found)) == order(expected)


@pytest.mark.parametrize("rows", [10, 10**6, 10**9, 10**11])
def test_parts_keep_every_link_at_any_size(rows):
    rng = np.random.default_rng(3)
    sample = rng.integers(0, 2**63, 300, dtype=np.uint64) * np.uint64(2)  # one bit never set
    parts = simhash.plan_parts(sample, rows)
    assert sum(t + 1 for _, t in parts) == simhash.DISTANCE + 1
    masks = [m for m, _ in parts]
    assert all(a & b == 0 for i, a in enumerate(masks) for b in masks[:i])
    for _ in range(2000):
        apart = sum(1 << int(b) for b in rng.choice(64, simhash.DISTANCE, replace=False))
        assert any((apart & m).bit_count() <= t for m, t in parts)
        assert any((apart & m) in set(simhash.flips(m, t)) for m, t in parts[:2] + parts[2:] if (apart & m).bit_count() <= t)


def test_parts_get_wider_as_rows_grow():
    sample = np.random.default_rng(3).integers(0, 2**63, 300, dtype=np.uint64)
    few, many = (simhash.plan_parts(sample, n) for n in (10**4, 10**10))
    assert max(m.bit_count() for m, _ in many) > max(m.bit_count() for m, _ in few)


def test_thresholds_are_the_cheapest():
    costs = [[0, 5, 9, 30, 99, 99], [0, 1, 50, 60, 99, 99], [0, 2, 3, 80, 99, 99]]
    cheapest = min(
        (costs[0][a] + costs[1][b] + costs[2][c], [a - 1, b - 1, c - 1])
        for a in range(6) for b in range(6) for c in range(6) if a + b + c == 5
    )
    assert simhash.allocate(costs, 5) == cheapest


def test_chains_become_one_component(spark):
    prints = [0]
    for i in range(60):
        prints.append(prints[-1] ^ (0b111 << (3 * i % 61)))
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in set(prints)], "print long")
    roots = simhash.components(simhash.link_edges(frame)).collect()
    assert len({r.root for r in roots}) == 1
    assert {r.node for r in roots} | {roots[0].root} == {r.print for r in frame.collect()}


def test_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in odd.collect()]
    assert order(map(tuple, simhash.near_duplicates(odd).collect())) == order(slow_components(rows))
    kept = simhash.first_of_each(odd)
    assert kept.columns == odd.columns
    # One row of each group, whether or not another group has the same name or none.
    values = sorted({p for _, p in rows})
    groups = {v: {v} for v in values}
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 4 and groups[a] is not groups[b]:
                groups[a] |= groups[b]
                for member in groups[a]:
                    groups[member] = groups[a]
    assert kept.count() == len({id(g) for g in groups.values()})
    assert simhash.near_duplicates(empty_documents(spark)).collect() == []
    assert simhash.first_of_each(empty_documents(spark)).collect() == []


def test_one_document_of_each_group_stays(spark):
    texts = near_texts(8)
    docs = documents(spark, texts)
    expected = {c for _, _, c in slow_components([(i, slow_fingerprint(t)) for i, t in enumerate(texts)])}
    assert {r.doc_id for r in simhash.first_of_each(docs).collect()} == expected


def test_groups_without_ids_and_groups_that_share_an_id_all_stay(spark):
    texts = ["one sort of text", "quite another thing here", "one sort of text", "a third kind altogether", "fourth and last of them all"]
    docs = documents(spark, [*texts, texts[4], texts[4]], ids=[None, None, None, 7, 7, 8, 7])
    found = sorted(((r.doc_id, r.text) for r in simhash.first_of_each(docs).collect()), key=str)
    assert found == sorted([(None, texts[0]), (None, texts[1]), (7, texts[3]), (7, texts[4])], key=str)


def test_texts_of_one_id_and_fingerprint_stay_once(spark):
    docs = documents(spark, ["Some words of a text", "some  words of a text", "SOME words of a text"], ids=[5, 5, None])
    found = simhash.first_of_each(docs).collect()
    assert len(found) == 1 and found[0].doc_id == 5


def test_large_groups_are_linked_within_bounded_memory(spark, monkeypatch):
    """Thousands of unlike fingerprints in one bucket, nearly all linked: pairs are folded, not gathered."""
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(2)
    prints = sorted({sum(1 << b for b in rng.sample(range(64), rng.randint(0, 2))) for _ in range(40_000)})
    assert len(prints) > 1500
    monkeypatch.setattr(simhash, "SLICE", 1 << 16)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(signed, pa.int64()), pa.array([0] * len(signed), pa.int64()), pa.array([5] * len(signed), pa.int64())],
        names=["print", "flip", "g"],
    )
    tracemalloc.start()
    edges = pa.Table.from_batches(simhash._compare(4)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Fingerprints of at most two bits differ in at most four: one component, told by a tree.
    assert len(edges) == len(prints) - 1 and len(set(edges["v"].to_pylist())) == 1
    assert peak < 40e6, peak
