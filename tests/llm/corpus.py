"""Small corpora for the tests."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Texts that every operator must take: null, empty, blank, one word, long, repeated.
ODD_TEXTS = [None, "", " \n\t ", "word", "\n\n\n", "the same line\n" * 40, "x" * 20_000, "ein Wört " * 3000]


def documents(spark, texts, first=0, ids=None):
    ids = range(first, first + len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCUMENTS)


def odd_documents(spark):
    """Odd texts, repeated rows, a repeated id, null ids, and columns whose names operators use inside."""
    from pyspark.sql import functions as F

    rows = documents(spark, ODD_TEXTS)
    more = documents(spark, ["word", "other words", None, "null id text"], ids=[3, 3, None, None])
    return (
        rows.unionAll(more).unionAll(rows)
        .withColumn("score", F.lit("kept")).withColumn("print", F.lit(1)).withColumn("lines", F.lit(2))
        .withColumn("matches", F.lit(3)).withColumn("label", F.lit(4))
    )


def empty_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> list[str]:
    return [f"w{int(rng.paretovariate(0.8)) % vocabulary}" for _ in range(words)]
