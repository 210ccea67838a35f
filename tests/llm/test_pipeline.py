import zlib

import numpy as np
import pytest
from llm.corpus import documents, empty_documents, odd_documents
from llm.test_decontaminate import slow_distance
from llm.test_line_dedup import slow_deleted
from llm.test_packing import valid
from llm.test_simhash import slow_components, slow_fingerprint

import corpus_pipeline
from factprep.llm import decontaminate, quality

ROOT = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.read.parquet(f"{ROOT}/documents.parquet").cache()
    yield frame
    frame.unpersist()


def texts_of(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages_come_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "packing"
    ]


def test_quality_keeps_what_the_discriminant_accepts(spark, docs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect()}
    texts = texts_of(docs)
    taught = [i for i in labels if i in texts and zlib.crc32(str(i).encode()) % 5]
    rows = [(texts[i], labels[i]) for i in taught]
    model = quality.fit(spark.createDataFrame(rows, "text string, __label int"))
    ids = sorted(texts)
    scores = model.score(np.array([quality.document_statistics(texts[i].encode()) for i in ids]))
    found = STAGES["quality classifier"](spark, docs, ROOT)
    assert found.columns == docs.columns
    assert set(texts_of(found)) == {i for i, s in zip(ids, scores, strict=True) if s >= 0.3}
    good = [i for i in ids if labels.get(i) == 1]
    assert len(set(good) - set(texts_of(found))) <= 0.02 * len(good)


def test_line_dedup_deletes_later_copies(spark, docs):
    texts = dict(sorted(texts_of(docs).items()))
    found = STAGES["line dedup"](spark, docs, ROOT)
    assert found.columns == docs.columns
    deleted = slow_deleted(list(texts.values()), 50)
    expected = {}
    for d, (doc, text) in enumerate(texts.items()):
        kept = "\n".join(x for i, x in enumerate(text.split("\n")) if (d, i) not in deleted)
        if kept or not any(e == d for e, _ in deleted):
            expected[doc] = kept
    assert texts_of(found) == expected
    assert all(r.n_chars == len(r.text) for r in found.collect())


def test_one_document_of_each_near_group_stays(spark, docs):
    texts = texts_of(docs)
    groups = slow_components([(i, slow_fingerprint(t)) for i, t in texts.items()])
    assert set(texts_of(STAGES["SimHash near-dedup"](spark, docs, ROOT))) == {c for _, _, c in groups}


def test_documents_with_benchmark_items_go(spark, docs):
    texts = texts_of(docs)
    items = [decontaminate.word_tokens(r.text) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()]
    kept = set(texts_of(STAGES["benchmark decontamination"](spark, docs, ROOT)))
    # Every document with an unchanged item goes; every one that goes has an item within the allowed edits.
    joined = {i: " " + " ".join(decontaminate.word_tokens(t)) + " " for i, t in texts.items()}
    assert not any(f" {' '.join(w)} " in joined[i] for i in kept for w in items)
    for i in texts.keys() - kept:
        words = joined[i].split()
        assert any(slow_distance(w, words) <= decontaminate.edits_allowed(len(w), 0.8) for w in items)


def test_run_is_the_stages_one_after_the_other(spark, docs):
    found = corpus_pipeline.run(spark, ROOT).collect()
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, ROOT).collect(), docs.schema)
    valid(found, texts_of(now))


@pytest.mark.parametrize("name", STAGES)
def test_odd_and_empty_tables(spark, name):
    odd = odd_documents(spark)
    done = STAGES[name](spark, odd, ROOT)
    if name != "packing":
        assert done.columns == odd.columns
        assert done.count() <= odd.count()
    else:
        assert done.count() >= odd.count()
    assert STAGES[name](spark, empty_documents(spark), ROOT).count() == 0


def test_near_copies_and_passages_go(spark):
    passage = "\n".join(" ".join(f"p{i}x{j}" for j in range(30)) for i in range(3))
    clean = [" ".join(f"c{n}w{(n * 7 + j * j) % 91}" for j in range(120)) for n in range(6)]
    docs = documents(spark, [*clean, clean[0], clean[1] + " more", passage + "\n" + clean[2][:400], "own\n" + passage])
    left = STAGES["line dedup"](spark, docs, ROOT)
    kept = texts_of(STAGES["SimHash near-dedup"](spark, left, ROOT))
    assert {i: kept[i] for i in range(6)} == dict(enumerate(clean))
    assert 6 not in kept and 7 not in kept and kept[9] == "own"


def test_columns_of_the_same_names_stay(spark):
    """A document's own columns pass through line dedup, whatever that calls its results."""
    from pyspark.sql import functions as F

    run = "\n".join(" ".join(f"p{i}x{j}" for j in range(30)) for i in range(3))
    docs = documents(spark, [run, "own\n" + run]).withColumn("lines", F.lit(7)).withColumn("deleted", F.array(F.lit("mine")))
    left = STAGES["line dedup"](spark, docs, ROOT)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.lines, r.deleted) for r in left.collect()) == [(0, run, 7, ["mine"]), (1, "own", 7, ["mine"])]


@pytest.mark.parametrize("name", ["line dedup", "SimHash near-dedup"])
def test_texts_go_to_one_worker_once(spark, docs, name):
    """A filter or join on what a Python function returns doesn't run it again, in a second worker for each task."""
    done = STAGES[name](spark, docs, ROOT)
    assert done._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
