import random
from collections import Counter

import pytest
from llm.corpus import documents, empty_documents, odd_documents

from factprep.llm import line_dedup


def slow_deleted(texts, least):
    """Lines inside a run of enough words that occurs earlier, past that run's first place; all runs are compared."""
    docs = [t.split("\n") for t in texts]
    often = Counter(x for lines in docs for x in lines)
    first, deleted = {}, set()
    for d, lines in enumerate(docs):
        for i in range(len(lines)):
            weight = 0
            for j in range(i + 1, len(lines) + 1):
                if often[lines[j - 1]] == 1:
                    break  # no longer run occurs again
                weight += max(1, len(lines[j - 1].split()))
                if weight < least:
                    continue
                e, at = first.setdefault(tuple(lines[i:j]), (d, i))
                if (e, at) != (d, i):
                    past = max(i, at + j - i) if e == d else i
                    deleted |= {(d, n) for n in range(past, j)}
    return deleted


def random_texts(seed):
    rng = random.Random(seed)
    lines = [" ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(0, 9))) for _ in range(30)]
    texts = []
    for _ in range(25):
        text = [rng.choice(lines) if rng.random() < 0.6 else f"own {rng.random()}" for _ in range(rng.randint(1, 14))]
        if texts and rng.random() < 0.6:
            other = rng.choice(texts).split("\n")
            at = rng.randrange(len(other))
            text[rng.randint(0, len(text)) :] = other[at : at + rng.randint(1, 12)]
        texts.append("\n".join(text))
    return texts


@pytest.mark.parametrize(("seed", "least"), [(1, 8), (2, 20), (3, 3), (4, 1)])
def test_deletes_what_comparing_all_suffixes_deletes(spark, seed, least):
    texts = list(dict.fromkeys(random_texts(seed)))
    rows = line_dedup.without_copies(documents(spark, texts), min_words=least).collect()
    expected = slow_deleted(texts, least)
    assert expected
    for r in rows:
        own = {r.start + n for r in r.deleted for n in range(r.size)}
        assert own == {i for d, i in expected if d == r.doc_id}, r.doc_id
        lines = texts[r.doc_id].split("\n")
        assert r.text == "\n".join(x for i, x in enumerate(lines) if i not in own)
        assert r.lines == len(lines)


@pytest.mark.parametrize("period", [1, 2, 3, 7])
def test_the_first_of_overlapping_copies_stays_whole(spark, period):
    texts = ["\n".join(["start", *(f"line{i % period}" for i in range(60)), "end"]), "\n".join(["line0"] * 9)]
    rows = line_dedup.without_copies(documents(spark, texts), min_words=20).orderBy("doc_id").collect()
    expected = slow_deleted(texts, 20)
    for r in rows:
        own = {x.start + n for x in r.deleted for n in range(x.size)}
        assert own == {i for d, i in expected if d == r.doc_id}
    # The first 20 lines of the run stay; each later line ends a copy of a run that began a period earlier.
    assert [(x.start, x.size) for x in rows[0].deleted] == [(21, 40)]


def test_ranks_follow_the_order_of_suffixes(spark):
    lines = [(0, 0, 0, i, h, 0) for i, h in enumerate([3, 1, 2, 3, 1, 2, 3, 1, 5, 5])]
    frame = spark.createDataFrame(lines, "__doc long, __t1 long, __t2 long, pos int, h1 long, h2 long")
    levels = [{r.pos: r["rank"] for r in t.collect()} for t in line_dedup.suffix_levels(frame, 3)]
    values = [x[4] for x in lines]
    for k, ranks in enumerate(levels):
        part = lambda i, k=k: tuple(values[i : i + 2**k])
        whole = [i for i in range(len(values)) if i + 2**k <= len(values)]
        again = [i for i in whole if sum(part(j) == part(i) for j in whole) > 1]
        assert sorted(ranks) == again
        assert all((part(i) < part(j)) == (ranks[i] < ranks[j]) for i in again for j in again)


def test_copies_of_whole_documents(spark):
    passage = "\n".join(" ".join(f"p{i}{j}" for j in range(12)) for i in range(5))
    texts = ["one\n" + passage, passage, "two\n" + passage + "\nthree", "short line\nagain", "short line\nagain"]
    kept = {r.doc_id: r.text for r in line_dedup.without_copies(documents(spark, texts)).collect()}
    assert kept == {0: texts[0], 1: "", 2: "two\nthree", 3: texts[3], 4: texts[4]}


def test_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    done = line_dedup.without_copies(odd)
    assert set(odd.columns) <= set(done.columns)
    rows = done.collect()
    assert len(rows) == odd.count()
    assert all((r.text is None) == (r.deleted == [] and r.lines == 0) for r in rows)
    # The 41 lines of a text's own repeated line: its first copies stay, the others go.
    repeated = [r for r in rows if r.doc_id == 5]
    assert {(r.text, r.lines) for r in repeated} == {("the same line\n", 41)} or len({r.text for r in repeated}) == 1
    assert {r.text for r in rows if r.doc_id == 3} == {"word", "other words"}
    assert line_dedup.without_copies(empty_documents(spark)).collect() == []
