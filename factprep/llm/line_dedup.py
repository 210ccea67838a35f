"""Line dedup: a suffix array over line ids by distributed prefix doubling.

Every run of consecutive lines that weighs at least ``min_words`` (a line weighs
its words, at least 1) and occurs earlier, in order of (document id, text digest,
line), is a copy; its lines are deleted, but for those that its first occurrence
holds itself: where a run overlaps its own copy, the first stays whole. All
maximal repeated runs are found:

* Level 0 ranks the lines, level k the prefixes of 2^k lines of each suffix, by
  ordering the pairs of level k - 1 ranks of a suffix and of the one 2^(k-1)
  lines on. Ranks come from one range sort of the distinct repeated pairs; suffixes
  whose prefix is unique leave, as no repeated run goes through them.
* Suffixes that agree on l lines form a longest-common-prefix interval. Its key is
  the pair of level ranks that cover the l lines, 2^k <= l < 2^(k+1).
* For every line, the shortest run that starts there and weighs enough, and the
  shortest that ends there, are looked up; copies are the members of the
  interval but the first. A maximal run is the union of such runs inside it:
  a line whose own shortest run passes the end of the maximal run weighs, with
  all that follows, less than the limit, so the shortest run that ends with the
  maximal run holds it. Hence levels up to log2(min_words) suffice for runs of
  any length. That holds for the lines past an overlapping first occurrence, too: the
  last line of a copied shortest run is always past the first one's end.

Lines split at \\n. Null texts stay null, empty texts stay empty. Rows that repeat
both id and text are one document and keep the same lines. A null id sorts
before all others. Other columns pass through; columns named like the results
are replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factprep.llm.common import LEAST_LONG, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_WORDS = 50
KEY = ["__doc", "__t1", "__t2"]
LINES = "lines array<struct<pos: int, h1: long, h2: long, runs: array<struct<start: int, size: int>>>>"


def shortest_runs(weights: np.ndarray, least: int) -> list[list[tuple[int, int]]]:
    """For each line, the (start, lines) of the shortest heavy enough runs that start or end at it, filed under their start."""
    n = len(weights)
    until = np.concatenate(([0], np.cumsum(weights)))
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    ends = np.searchsorted(until, until[:-1] + least)  # first end that reaches the limit
    for start in np.flatnonzero(ends <= n).tolist():
        out[start].append((start, int(ends[start]) - start))
    starts = np.searchsorted(until, until[1:] - least, side="right") - 1  # last start that reaches it
    for end in np.flatnonzero(starts >= 0).tolist():
        start = int(starts[end])
        run = (start, end + 1 - start)
        if run not in out[start]:
            out[start].append(run)
    return out


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def _cut(least: int):
    digest = xxhash.xxh3_128_intdigest
    run = pa.struct([("start", pa.int32()), ("size", pa.int32())])
    line = pa.struct([("pos", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("runs", pa.list_(run))])
    schema = pa.schema(
        [(KEY[0], pa.int64()), (KEY[1], pa.int64()), (KEY[2], pa.int64()), ("lines", pa.list_(line))]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = batch.column("text").to_pylist(), []
            for text in texts:
                lines = text.split(b"\n")
                runs = shortest_runs(np.array([max(1, len(x.split())) for x in lines]), least)
                found = []
                for pos, x in enumerate(lines):
                    h = digest(x)
                    found.append(
                        {
                            "pos": pos,
                            "h1": _signed(h >> 64),
                            "h2": _signed(h & (2**64 - 1)),
                            "runs": [{"start": s, "size": n} for s, n in runs[pos]],
                        }
                    )
                rows.append(found)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in KEY), pa.array(rows, schema.field("lines").type)], schema=schema
            )

    return cut


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents with the columns of KEY: an id that isn't null and two digests of the text."""
    return docs.withColumns(
        {
            KEY[0]: F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST_LONG)),
            KEY[1]: F.xxhash64(F.col(text)),
            KEY[2]: F.xxhash64(F.lit(1), F.col(text)),
        }
    )


def _ranked(pairs: DataFrame) -> DataFrame:
    """(a, b, rank) of the pairs that occur more than once; ranks keep the pairs' order."""
    repeated = pairs.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1").select("a", "b")
    return repeated.repartitionByRange("a", "b").sortWithinPartitions("a", "b").withColumn(
        "rank", F.monotonically_increasing_id()
    )


def suffix_levels(lines: DataFrame, levels: int) -> list[DataFrame]:
    """Per level k, (KEY, pos, rank) of the suffixes whose first 2^k lines occur more than once.

    ``lines`` has KEY, pos, h1 and h2; equal ranks mean equal lines.
    """
    out = []
    pairs = lines.select(*KEY, "pos", F.col("h1").alias("a"), F.col("h2").alias("b"))
    for level in range(levels):
        ranks = pairs.join(_ranked(pairs), ["a", "b"]).select(*KEY, "pos", "rank")
        out.append(stored(ranks, f"suffixes{level}"))
        step = 1 << level
        on = Window.partitionBy(*KEY).orderBy("pos").rangeBetween(step, step)
        pairs = (
            out[-1]
            .select(*KEY, "pos", F.col("rank").alias("a"), F.max("rank").over(on).alias("b"))
            .filter("b IS NOT NULL")
        )
    return out


def copied_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(KEY, start, size) of shortest runs that have an earlier copy, past their first; together they cover all later copies."""
    if min_words < 1:
        raise ValueError("A run weighs at least one word.")
    cut = (
        _keyed(docs.filter(F.col(text).isNotNull()), doc_id, text)
        .select(*KEY, F.col(text).cast("binary").alias("text"))
        .mapInArrow(_cut(min_words), ", ".join(f"{k} long" for k in KEY) + ", " + LINES)
        .groupBy(*KEY)
        .agg(F.first("lines").alias("lines"))
    )
    lines = stored(cut.select(*KEY, F.inline("lines")), "lines")
    levels = suffix_levels(lines, min_words.bit_length())
    ranks = reduce(
        DataFrame.unionAll, [t.select(*KEY, "pos", F.lit(k).alias("level"), "rank") for k, t in enumerate(levels)]
    )
    runs = (
        lines.filter(F.size("runs") > 0)
        .select(*KEY, F.inline("runs"))
        .withColumn("level", F.floor(F.log2(F.col("size") + F.lit(0.5))).cast("int"))
    )
    head = ranks.withColumnRenamed("pos", "start").withColumnRenamed("rank", "a")
    tail = ranks.withColumnRenamed("pos", "last").withColumnRenamed("rank", "b")
    keyed = (
        runs.join(head, [*KEY, "start", "level"])
        .withColumn("last", (F.col("start") + F.col("size") - F.expr("shiftleft(1, level)")).cast("int"))
        .join(tail, [*KEY, "last", "level"])
        .select(*KEY, "start", "size", "a", "b")
    )
    keyed = stored(keyed, "runs")
    place = F.struct(*KEY, "start")
    # Stored, as only a join of two shuffles is split where one key has many rows.
    first = stored(
        keyed.groupBy("size", "a", "b")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n"),
        "intervals",
    )
    same = reduce(Column.__and__, [F.col(k) == F.col(f"first.{k}") for k in KEY])
    past = F.when(same, F.greatest("start", F.col("first.start") + F.col("size"))).otherwise(F.col("start"))
    end = F.col("start") + F.col("size")
    return (
        keyed.join(first, ["size", "a", "b"])
        .filter(place > F.col("first"))
        .select(*KEY, past.alias("start"), (end - past).alias("size"))
    )


DELETED = "text string, deleted array<struct<start: int, size: int>>, lines int"


def _delete(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
    out = []
    for text, found in zip(texts, runs, strict=True):
        if text is None:
            out.append((None, [], 0))
            continue
        if found is None or not len(found):
            out.append((text, [], text.count("\n") + 1))
            continue
        lines, merged = text.split("\n"), []
        for start, size in sorted((r["start"], r["size"]) for r in found):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], start + size)
            else:
                merged.append([start, start + size])
        kept, at = [], 0
        for start, end in merged:
            kept += lines[at:start]
            at = end
        kept += lines[at:]
        out.append(("\n".join(kept), [{"start": s, "size": e - s} for s, e in merged], len(lines)))
    return pd.DataFrame(out, columns=["text", "deleted", "lines"])


def without_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    deleted: str = "deleted",
    lines: str = "lines",
) -> DataFrame:
    """The documents with their kept ``text``, ``deleted`` (maximal runs of deleted lines) and ``lines`` (before).

    The last two go by the given names and replace columns of the same names.
    """
    runs = stored(
        copied_runs(docs, doc_id, text, min_words)
        .groupBy(*KEY)
        .agg(F.collect_set(F.struct("start", "size")).alias("__runs")),
        "copies",
    )
    # Merged at any size: rows that repeat one document many times are then split over tasks.
    joined = _keyed(docs, doc_id, text).join(runs.hint("merge"), KEY, "left")
    # Were it deterministic to Spark, a filter on the results would run it again in workers of its own.
    delete = F.pandas_udf(_delete, DELETED).asNondeterministic()
    return (
        joined.withColumn("__kept", delete(F.col(text), F.col("__runs")))
        .withColumns({text: F.col("__kept.text"), deleted: F.col("__kept.deleted"), lines: F.col("__kept.lines")})
        .drop(*KEY, "__runs", "__kept")
    )
