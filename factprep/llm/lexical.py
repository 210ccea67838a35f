"""Ranked lexical search: the best documents of each item, by dual-tree branch and bound.

A document's score for an item is the sum, over the item's distinct terms, of the term's
weight times its impact in the document. Documents and items are both put into trees whose
nodes hold the maximum of every coordinate below them: of impacts over documents, of weights
over items. The product of two nodes bounds every score between them. A pair of nodes is left
out only if the bound is below the least of the kth best scores that the items of the node
have reached so far, so the result is exact, ties included.

Items are taken in blocks of at most ``BLOCK_TERMS`` terms. For each block, Spark tokenises
all documents once into sparse rows over the block's vocabulary, written to the shared
folder, counts N, L and document frequencies from them, and searches them: each task builds trees over
batches of its documents and keeps the k best of each item, and a window picks the k best of
all tasks' lists. Nothing of the documents but counts per vocabulary term reaches the driver.

A null text has no terms, and an item without terms has no rows. Each row of either table
counts on its own, whatever its id: a repeated item gives rows of its own, copies of a document
are ranked one after another. Ids may be null; among equal scores they come last.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factprep.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Distinct terms, and items, of one block: bounds what is sent to each task.
BLOCK_TERMS = 1 << 17
BLOCK_ITEMS = 1 << 12
#: Terms of documents that one tree holds.
TREE_ENTRIES = 1 << 20
#: Children of a node.
FAN = 16

# Everything but ASCII letters and digits and what lies beyond ASCII parts terms; only A-Z are lowered.
_PARTS = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text, as UTF-8, in which every byte of a character beyond ASCII is at least 128."""
    return text.translate(_PARTS).split()


@dataclass
class Items:
    """A block of items over its own vocabulary: each item's distinct terms as rising numbers."""

    ids: list[object]
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]


def blocks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Items]:
    """The items in blocks; one block at a time is held."""
    block = Items([], [], {})
    for name, words in items.select(item_id, text).toLocalIterator():
        found = set(terms_of((words or "").encode()))
        if block.ids and (len(block.vocabulary) + len(found) > BLOCK_TERMS or len(block.ids) >= BLOCK_ITEMS):
            yield block
            block = Items([], [], {})
        numbers = [block.vocabulary.setdefault(t, len(block.vocabulary)) for t in sorted(found)]
        block.ids.append(name)
        block.terms.append(np.sort(np.array(numbers, np.int64)))
    if block.ids:
        yield block


def _bytes_of(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary())


def _sparse_rows(vocabulary: dict[bytes, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, numbers, counts = [], [], []
            for text in _bytes_of(batch.column(1)):
                words = terms_of(text.as_py() or b"")
                sizes.append(len(words))
                known = [(vocabulary[t], n) for t, n in Counter(words).items() if t in vocabulary]
                known.sort()
                numbers.append([i for i, _ in known])
                counts.append([n for _, n in known])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(numbers, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int32())),
                ],
                ["doc_id", "size", "terms", "counts"],
            )

    return rows


def sparse_documents(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, number of terms with repeats, and the terms of the vocabulary with their counts."""
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    key = kept.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, size bigint, terms array<int>, counts array<int>"
    return kept.mapInArrow(_sparse_rows(vocabulary), schema)


def weights(documents: DataFrame, vocabulary_size: int) -> tuple[int, int, np.ndarray]:
    """Number of documents with terms, all their terms, and the weight of each term of the vocabulary."""
    whole = documents.agg(F.count_if(F.col("size") > 0).alias("n"), F.sum("size").alias("l")).first()
    n, length = whole.n, whole.l or 0
    held = documents.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    frequency = np.zeros(vocabulary_size, np.int64)
    # A row for each term of the block at most.
    counted = held.toArrow()
    frequency[np.asarray(counted["term"], np.int64)] = np.asarray(counted["df"], np.int64)
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * int(df) + 1))) for df in frequency]
    return n, length, np.array(weight, np.int64)


@dataclass
class Sparse:
    """Sparse rows of non-negative whole numbers."""

    starts: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> Sparse:
        sizes = self.starts[rows + 1] - self.starts[rows]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(starts[-1]) + np.repeat(self.starts[rows] - starts[:-1], sizes)
        return Sparse(starts, self.terms[at], self.values[at])

    def times(self, vector: np.ndarray) -> np.ndarray:
        """The product of every row with a dense vector."""
        sums = np.concatenate([[0], np.cumsum(vector[self.terms] * self.values)])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def parents(self) -> Sparse:
        """Rows of coordinate maxima over groups of ``FAN`` rows."""
        group = np.repeat(np.arange(len(self)) // FAN, np.diff(self.starts))
        order = np.lexsort((self.terms, group))
        group, terms, values = group[order], self.terms[order], self.values[order]
        new = np.ones(len(group), bool)
        new[1:] = (group[1:] != group[:-1]) | (terms[1:] != terms[:-1])
        at = np.flatnonzero(new)
        maxima = np.maximum.reduceat(values, at) if len(at) else values
        starts = np.searchsorted(group[at], np.arange(-(-len(self) // FAN) + 1))
        return Sparse(starts, terms[at], maxima)


def levels(leaves: Sparse) -> list[Sparse]:
    """A tree from its leaves up: each level holds the maxima of groups of the one below."""
    tree = [leaves]
    while len(tree[-1]) > FAN:
        tree.append(tree[-1].parents())
    return tree


def _order(rows: Sparse, weight: np.ndarray) -> np.ndarray:
    """Rows with the same strongest terms side by side, so that maxima stay close to their rows."""
    strength = weight[rows.terms] * rows.values
    row = np.repeat(np.arange(len(rows)), np.diff(rows.starts))
    by = np.lexsort((-strength, row))
    first = np.full((2, len(rows)), -1, np.int64)
    sizes = np.diff(rows.starts)
    for place in (0, 1):
        has = np.flatnonzero(sizes > place)
        first[place, has] = rows.terms[by][rows.starts[has] + place]
    return np.lexsort((first[1], first[0]))


class Search:
    """The k best documents of each item of a block, over batches of documents."""

    def __init__(self, items: list[np.ndarray], weight: np.ndarray, most: int):
        self.most, self.weight = most, weight
        starts = np.concatenate([[0], np.cumsum([len(t) for t in items])]).astype(np.int64)
        terms = np.concatenate(items) if items else np.zeros(0, np.int64)
        leaves = Sparse(starts, terms, weight[terms])
        self.order = _order(leaves, np.ones_like(weight))
        self.tree = levels(leaves.take(self.order))
        self.best = [np.zeros((0, 3), np.int64) for _ in items]
        self.least = np.zeros(len(items), np.int64)
        self.compared = 0

    def kth(self, level: int, node: int) -> int:
        """The least kth best score of the items below a node, 1 where an item has fewer."""
        width = FAN**level
        return int(self.least[node * width : (node + 1) * width].min(initial=np.iinfo(np.int64).max))

    def add(self, documents: Sparse, ids: np.ndarray, missing: np.ndarray) -> None:
        order = _order(documents, self.weight)
        self.docs, self.ids, self.missing = levels(documents.take(order)), ids[order], missing[order]
        top = len(self.tree) - 1
        for node in range(len(self.tree[top])):
            self.visit(top, node, len(self.docs) - 1, np.arange(len(self.docs[-1])))

    def visit(self, level: int, node: int, depth: int, rows: np.ndarray) -> None:
        """Pairs of one item node with document nodes of one level: bound, prune, descend on either side."""
        item, dense = self.tree[level], np.zeros(len(self.weight), np.int64)
        here = slice(item.starts[node], item.starts[node + 1])
        dense[item.terms[here]] = item.values[here]
        bound = self.docs[depth].take(rows).times(dense)
        self.compared += len(rows)
        kept = bound >= max(1, self.kth(level, node))
        rows, bound = rows[kept], bound[kept]
        if not len(rows):
            return
        if level:
            below = range(node * FAN, min((node + 1) * FAN, len(self.tree[level - 1])))
            # Both sides go down together while there are levels on both.
            for child in below:
                self.visit(level - 1, child, max(0, depth - 1), self.children(depth, rows) if depth else rows)
        elif depth:
            # The most promising documents come first: they raise the score that the others must reach.
            best_first = np.argsort(-bound, kind="stable")
            step = FAN
            while len(best_first):
                at, best_first = best_first[:step], best_first[step:]
                step *= 4
                self.visit(0, node, depth - 1, self.children(depth, rows[at]))
                best_first = best_first[bound[best_first] >= max(1, self.kth(0, node))]
        else:
            self.keep(node, rows, bound)

    def children(self, depth: int, rows: np.ndarray) -> np.ndarray:
        below = (rows[:, None] * FAN + np.arange(FAN)).ravel()
        return below[below < len(self.docs[depth - 1])]

    def keep(self, node: int, rows: np.ndarray, scores: np.ndarray) -> None:
        """Exact scores of one item: its best so far and the new ones."""
        new = np.stack([scores, self.missing[rows], self.ids[rows]], axis=1)
        both = np.concatenate([self.best[node], new])
        both = both[np.lexsort((both[:, 2], both[:, 1], -both[:, 0]))][: self.most]
        self.best[node] = both
        if len(both) == self.most:
            self.least[node] = both[-1, 0]

    def results(self) -> Iterator[tuple[int, np.ndarray]]:
        for node, number in enumerate(self.order):
            yield int(number), self.best[node]


def _impacts(counts: np.ndarray, sizes: np.ndarray, n: int, length: int) -> np.ndarray:
    slope = 10 + (90 * sizes * n) // max(1, length)
    return (1_000_000_000 * counts) // (1000 * counts + 8 * slope)


def _best_of_task(items: list[np.ndarray], weight: np.ndarray, n: int, length: int, most: int):
    def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Parts of a batch whose rows have at most TREE_ENTRIES terms together, or one row."""
        ends = np.asarray(batch.column(2).offsets, np.int64)
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + TREE_ENTRIES, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, entries = Search(items, weight, most), [], 0

        def flush() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            terms, counts = (table.column(i).combine_chunks() for i in (2, 3))
            sizes = np.diff(np.asarray(terms.offsets, np.int64))
            starts = np.concatenate([[0], np.cumsum(sizes)])
            lengths = np.repeat(np.asarray(table.column(1), np.int64), sizes)
            impact = _impacts(np.asarray(counts.flatten(), np.int64), lengths, n, length)
            ids = table.column(0).combine_chunks()
            documents = Sparse(starts, np.asarray(terms.flatten(), np.int64), impact)
            found.add(documents, np.asarray(ids.fill_null(0), np.int64), np.asarray(ids.is_null()).astype(np.int64))

        for whole in batches:
            for batch in pieces(whole):
                more = len(batch.column(2).flatten())
                if held and entries + more > TREE_ENTRIES:
                    flush()
                    held, entries = [], 0
                held.append(batch)
                entries += more
        if held:
            flush()
        for number, best in found.results():
            if len(best):
                ids = pa.array(best[:, 2], pa.int64(), mask=best[:, 1].astype(bool))
                same = pa.array(np.full(len(best), number, np.int32))
                yield pa.RecordBatch.from_arrays([same, ids, pa.array(best[:, 0])], ["number", "doc_id", "score"])

    return search


def ranked(
    docs: DataFrame, items: DataFrame, most: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """``item_id``, ``rank`` from 1, ``doc_id`` (whole numbers), ``score`` of the ``most`` best documents of each item.

    Only scores above 0 count; equal scores go by rising document id. Without any item the result is empty.
    """
    spark = docs.sparkSession
    key = items.schema[item_id].dataType
    parts = []
    for block in blocks(items, item_id):
        documents = stored(
            sparse_documents(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), block.vocabulary),
            "terms",
        )
        n, length, weight = weights(documents, len(block.vocabulary))
        search = _best_of_task(block.terms, weight, n, length, most)
        best = documents.where(F.size("terms") > 0).mapInArrow(search, "number int, doc_id bigint, score bigint")
        order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"number int, item_id {key.simpleString()}")
        # At most BLOCK_ITEMS rows.
        parts.append(top.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {key.simpleString()}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, parts)
