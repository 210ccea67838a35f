"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A document is contaminated by an item if some run of its words lies within
floor((1 - similarity) * words of the item) word edits of the item's words.
Words are lower-cased runs of letters and digits, so case, punctuation and line
breaks don't hide a passage.

The search, over whole texts and without a shuffle:

1. An alignment with at most k edits leaves one unbroken run of at least
   ceil((L - k) / (k + 1)) of the item's L words (pigeonhole), so only windows that
   share such a run with some item are looked at; each shared run places one
   window of the item's size. This loses no match.
2. The CGK random walk embeds window and items of that size, turning a small edit
   distance into a small Hamming distance; samples of the embedding's
   coordinates are the LSH keys. The number of repetitions is set so that items
   edited at the limit meet themselves with the target recall. It is measured on
   the items, put into other words and found through their shared runs, for each
   kind of edit as a whole text, at its start, at its end and within; the worst of
   these counts. Where MOST_REPEATS repetitions miss the target, keys sample fewer
   coordinates; where single coordinates miss it too, every window of that size is
   verified with every item of that size. Copies without edits in the window always
   meet.
3. Items that meet a window are verified by exact edit distance, against every
   run of the window widened by the allowed edits.

Items are sent to the executors in blocks of at most BLOCK_WORDS words. Null and
empty texts and items match nothing; items of fewer than five words must occur
unchanged. Repeated rows are treated alike; repeated items each report. Other
columns pass through; a column with the result's name is replaced.
"""

from __future__ import annotations

import math
import sys
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factprep.llm.common import word_tokens

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIMILARITY = 0.8
RECALL = 0.95
#: Most coordinates sampled for one key, random walks that the repetitions share, and most repetitions.
SAMPLED, WALKS, MOST_REPEATS = 3, 8, 128
BLOCK_WORDS = 60_000
#: Windows embedded at a time, and texts searched together at least.
WINDOWS, ROWS = 16_384, 8192
#: Characters of the texts that are searched together, or one batch.
CHARACTERS = 1 << 24
#: Edited items of a kind and place whose recall is measured, and words of their windows embedded at a time.
TRIALS, CELLS = 128, 1 << 21
KINDS, PLACES = ("swap", "delete", "insert", "mixed"), ("whole", "start", "end", "within")
MATCHES = "array<struct<item: int, start: int, words: int, distance: int>>"


def edits_allowed(words: int, similarity: float) -> int:
    return math.floor((1 - similarity) * words + 1e-9)


def shared_run(words: int, edits: int) -> int:
    return -(-(words - edits) // (edits + 1))


def embed(windows: np.ndarray, seed: int, padding: int, kept: np.ndarray | None = None) -> np.ndarray:
    """CGK walk over rows of word numbers: three steps for each word, all rows by the same coin flips.

    With ``kept``, sorted, only these steps are returned.
    """
    n, size = windows.shape
    steps = 3 * size
    # Multiply-shift: a coin for each step and word.
    odd = np.random.default_rng([seed, size]).integers(1, 2**63, steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    padded = np.concatenate([windows, np.full((n, 1), padding, windows.dtype)], axis=1)
    at, rows = np.zeros(n, np.int64), np.arange(n)
    places = {int(step): i for i, step in enumerate(range(steps) if kept is None else kept)}
    out = np.empty((n, len(places)), windows.dtype)
    for step in range(max(places, default=-1) + 1):
        word = padded[rows, at]
        if step in places:
            out[:, places[step]] = word
        mixed = (word.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        coin = ((mixed ^ (mixed >> np.uint64(29))) * odd[step]) >> np.uint64(63)
        at = np.minimum(at + coin.astype(np.int64), size)
    return out


def key_sets(windows: np.ndarray, repeats: int, padding: int, sampled: int = SAMPLED) -> Iterator[np.ndarray]:
    """For each repetition one LSH key for each row: coordinates sampled from one of the walks."""
    size = windows.shape[1]
    # Beyond twice the size there is mostly padding.
    picked = [np.random.default_rng([r, size, 7]).integers(0, 2 * size, sampled) for r in range(repeats)]
    walks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for repeat in range(repeats):
        seed = repeat % WALKS
        if seed not in walks:
            kept = np.unique(np.concatenate(picked[seed::WALKS]))
            walks[seed] = kept, embed(windows, seed, padding, kept).astype(np.uint64)
        kept, walk = walks[seed]
        key = np.zeros(len(windows), np.uint64)
        for c in np.searchsorted(kept, picked[repeat]):
            key = (key ^ walk[:, c]) * np.uint64(0x100000001B3) + np.uint64(0x9E3779B97F4A7C15)
        yield key


def best_run(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the run of words nearest to the item; the leftmost shortest end."""
    n = len(words)
    ramp = np.arange(n + 1)
    row, first = np.zeros(n + 1, np.int64), ramp.copy()
    for i, symbol in enumerate(item, 1):
        new, begin = row + 1, first.copy()  # leave the item's word out
        swap = row[:-1] + (words != symbol)
        better = swap <= new[1:]
        new[1:] = np.where(better, swap, new[1:])
        begin[1:] = np.where(better, first[:-1], begin[1:])
        new[0] = i
        # Runs that take in extra words: the best of new[j] + (distance from j).
        lead = new - ramp
        least = np.minimum.accumulate(lead)
        source = np.maximum.accumulate(np.where(lead == least, ramp, 0))
        row, first = least + ramp, begin[source]
    end = int(np.argmin(row))
    return int(row[end]), int(first[end]), end


@dataclass(frozen=True)
class Block:
    """Items with what the search needs, by size."""

    vocabulary: dict[str, int]
    items: list[np.ndarray]
    similarity: float
    #: run length -> (sorted codes, offsets, (window shift, size) rows)
    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    #: size -> item numbers
    sizes: dict[int, list[int]]
    #: size -> coordinates sampled for one key; 0 if every window is verified
    sampled: dict[int, int]
    #: size -> for each repetition, key -> item numbers
    tables: dict[int, list[dict[int, list[int]]]]

    @property
    def padding(self) -> int:
        return len(self.vocabulary) + 1


def edited_item(item: np.ndarray, edits: int, kind: str, rng: np.random.Generator) -> list[int]:
    """The item after so many edits of a kind; words that come in are unknown."""
    words = item.tolist()
    if kind == "swap":
        for at in rng.choice(len(words), edits, replace=False).tolist():
            words[at] = 0
    elif kind == "delete":
        for at in sorted(rng.choice(len(words), edits, replace=False).tolist(), reverse=True):
            del words[at]
    else:
        for _ in range(edits):
            way, at = 2 if kind == "insert" else int(rng.integers(0, 3)), int(rng.integers(0, max(1, len(words))))
            if way == 0 and words:
                words[at] = 0
            elif way == 1 and words:
                del words[at]
            else:
                words.insert(at, 0)
    return words


def met_first(
    items: np.ndarray,
    edits: int,
    block: Block,
    sampled: int = SAMPLED,
    kinds: tuple[str, ...] = KINDS,
    places: tuple[str, ...] = PLACES,
) -> np.ndarray:
    """The repetition, from 1, that first meets each edited item: a row for each kind of edit and place in a text.

    Edited items stand in texts of unknown words and words of the items; their
    windows are those of their shared runs. MOST_REPEATS + 1 stands for never.
    """
    size, rng = items.shape[1], np.random.default_rng(11)
    places_of = [(k, p) for k in kinds for p in places]
    whose = np.tile(rng.permutation(np.resize(np.arange(len(items)), TRIALS)), len(places_of))
    first = np.full(len(whose), MOST_REPEATS + 1)
    other = lambda: np.where(rng.random(size) < 0.5, 0, rng.choice(items.ravel(), size)).tolist()
    own = list(key_sets(items, MOST_REPEATS, block.padding, sampled))
    most, waiting, trials = max(1, CELLS // size), [], []

    def meet() -> None:
        if not waiting:
            return
        of = np.array(trials)
        keys_of = key_sets(np.array(waiting, np.int64), MOST_REPEATS, block.padding, sampled)
        for repeat, keys in enumerate(keys_of, 1):
            hit = of[keys == own[repeat - 1][whose[of]]]
            first[hit] = np.minimum(first[hit], repeat)
        waiting.clear()
        trials.clear()

    for trial, number in enumerate(whose.tolist()):
        kind, place = places_of[trial // TRIALS]
        before, after = (other() if place in beside else [] for beside in (("end", "within"), ("start", "within")))
        text = before + edited_item(items[number], edits, kind, rng) + after
        for start, words in windows_of(np.array(text, np.int64), block):
            if words == size:
                waiting.append((text[start : start + size] + [block.padding] * size)[:size])
                trials.append(trial)
        if len(waiting) >= most:
            meet()
    meet()
    return first.reshape(len(places_of), TRIALS)


def repeats_needed(items: np.ndarray, edits: int, block: Block, recall: float) -> tuple[int, int]:
    """Coordinates for one key, and repetitions with which items edited at the limit are met with the target recall.

    The target holds whatever the kind and place of the edits. (0, 0) if no number of coordinates reaches it.
    """
    if not edits:
        return SAMPLED, 1
    for sampled in range(SAMPLED, 0, -1):
        repeats = 0
        for place in PLACES:  # those with few windows first, as they tell soonest that the target is missed
            first = np.sort(met_first(items, edits, block, sampled, KINDS, (place,)), axis=1)
            repeats = max(repeats, int(first[:, math.ceil(recall * TRIALS) - 1].max()))
            if repeats > MOST_REPEATS:
                break
        else:
            return sampled, repeats
    return 0, 0


def run_limit(base: int) -> int:
    """Numbers below ``base`` that fit a code of 64 bits, four at most; shorter runs only admit more windows."""
    return max(n for n in range(1, 5) if n == 1 or base**n <= 2**64)


def shared_runs(items: list[np.ndarray], base: int, similarity: float) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The runs of a Block."""
    grams: dict[int, dict[int, set[tuple[int, int]]]] = defaultdict(lambda: defaultdict(set))
    for item in items:
        if not len(item):
            continue
        run = shared_run(len(item), edits_allowed(len(item), similarity))
        run = min(run, run_limit(base))
        for at in range(len(item) - run + 1):
            code = 0
            for word in item[at : at + run].tolist():
                code = code * base + word
            grams[run][code].add((at, len(item)))
    runs = {}
    for run, found in grams.items():
        codes = np.array(sorted(found), np.uint64)
        lists = [sorted(found[int(c)]) for c in codes]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
        runs[run] = (codes, offsets, np.array([x for xs in lists for x in xs], np.int64))
    return runs


def measured(
    items: list[np.ndarray], sizes: dict[int, list[int]], vocabulary: dict[str, int], similarity: float, recall: float
) -> dict[int, tuple[int, int]]:
    """``repeats_needed`` of every item size of a block, each measured by a task of its own."""
    base = len(vocabulary) + 2

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for size in batch["size"].tolist():
                rows = np.array([items[n] for n in sizes[size]])
                alone = Block(vocabulary, [], similarity, shared_runs(list(rows), base, similarity), {}, {}, {})
                found.append((size, *repeats_needed(rows, edits_allowed(size, similarity), alone, recall)))
            yield pd.DataFrame(found, columns=["size", "sampled", "repeats"])

    if not sizes:
        return {}
    spark = SparkSession.active()
    # Large sizes take longest and are dealt out first.
    asked = spark.sparkContext.parallelize([(s,) for s in sorted(sizes, reverse=True)], len(sizes))
    frame = spark.createDataFrame(asked, "size int")
    rows = frame.mapInPandas(measure, "size int, sampled int, repeats int").collect()
    return {r["size"]: (r["sampled"], r["repeats"]) for r in rows}


def build_block(texts: list[str | None], similarity: float = SIMILARITY, recall: float = RECALL) -> Block:
    split = [word_tokens(t or "") for t in texts]
    vocabulary = {w: i for i, w in enumerate(sorted({w for ws in split for w in ws}), 1)}
    items = [np.array([vocabulary[w] for w in ws], np.int64) for ws in split]
    sizes: dict[int, list[int]] = defaultdict(list)
    base = len(vocabulary) + 2
    for number, item in enumerate(items):
        if len(item):
            sizes[len(item)].append(number)
    runs = shared_runs(items, base, similarity)
    coordinates: dict[int, int] = {}
    tables: dict[int, list[dict[int, list[int]]]] = {}
    needed = measured(items, dict(sizes), vocabulary, similarity, recall)
    for size, numbers in sizes.items():
        rows = np.array([items[n] for n in numbers])
        coordinates[size], repeats = needed[size]
        tables[size] = []
        for own in key_sets(rows, repeats, base - 1, coordinates[size]):
            filed: dict[int, list[int]] = defaultdict(list)
            for number, key in zip(numbers, own.tolist(), strict=True):
                filed[key].append(number)
            tables[size].append(dict(filed))
    return Block(vocabulary, items, similarity, runs, dict(sizes), coordinates, tables)


def windows_of(ids: np.ndarray, block: Block) -> set[tuple[int, int]]:
    """(start, size) of the windows that share a long enough run with some item.

    A passage that lost words may end its text before its window does: such a window
    is shorter than its size. Left out are only windows with fewer words before or
    after the run than an item that lost the allowed words has.
    """
    base, found = np.uint64(len(block.vocabulary) + 2), set()
    for run, (codes, offsets, places) in block.runs.items():
        n = len(ids) - run + 1
        if n <= 0:
            continue
        known = ids[:n] > 0
        for j in range(1, run):
            known &= ids[j : j + n] > 0
        at = np.flatnonzero(known)
        if not len(at):
            continue
        code = np.zeros(len(at), np.uint64)
        for j in range(run):
            code = code * base + ids[at + j].astype(np.uint64)
        slot = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        hit = codes[slot] == code
        for p, s in zip(at[hit].tolist(), slot[hit].tolist(), strict=True):
            for shift, size in places[offsets[s] : offsets[s + 1]].tolist():
                lost = edits_allowed(size, block.similarity)
                if p >= shift - lost and len(ids) - p >= size - shift - lost:
                    found.add((max(0, p - shift), size))
    return found


def search(texts: Iterable[str | None], block: Block) -> list[list[tuple[int, int, int, int]]]:
    """For each whole text (item number, first word, words, distance) of every item found in it, by item."""
    get, documents = block.vocabulary.get, []
    by_size: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for d, text in enumerate(texts):
        words = word_tokens(text or "")
        ids = np.array([get(w, 0) for w in words], np.int64)
        found = windows_of(ids, block) if len(ids) else ()
        documents.append(ids if found else None)
        for start, size in sorted(found):
            by_size[size].append((d, start))
    met: dict[tuple[int, int], set[int]] = defaultdict(set)
    for size, places in by_size.items():
        if not block.sampled[size]:
            for d, start in places:
                for number in block.sizes[size]:
                    met[d, number].add(start)
            continue
        for at in range(0, len(places), WINDOWS):
            some = places[at : at + WINDOWS]
            rows = np.full((len(some), size), block.padding, np.int64)
            for i, (d, start) in enumerate(some):
                window = documents[d][start : start + size]
                rows[i, : len(window)] = window
            keys_of = key_sets(rows, len(block.tables[size]), block.padding, block.sampled[size])
            for own, filed in zip(keys_of, block.tables[size], strict=True):
                known = np.fromiter(filed, np.uint64, len(filed))
                for i in np.flatnonzero(np.isin(own, known)).tolist():
                    for number in filed[int(own[i])]:
                        met[some[i][0], number].add(some[i][1])
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in documents]
    for (d, number), starts in sorted(met.items()):
        item, ids = block.items[number], documents[d]
        allowed = edits_allowed(len(item), block.similarity)
        best, ranges = None, []
        for start in sorted(starts):
            low, high = max(0, start - allowed), min(len(ids), start + len(item) + allowed)
            if ranges and low <= ranges[-1][1]:  # windows of one passage are verified at once
                ranges[-1][1] = high
            else:
                ranges.append([low, high])
        for low, high in ranges:
            distance, first, end = best_run(item, ids[low:high])
            if distance <= allowed and (best is None or distance < best[3]):
                best = (number, low + first, end - first, distance)
        if best:
            out[d].append(best)
    return out


def _searcher(block: Block):
    names = ("item", "start", "words", "distance")

    @F.pandas_udf(MATCHES)
    def matches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # Several batches are searched together; of their texts only the word numbers are held.
        while True:
            rows = characters = 0

            def some() -> Iterator[str | None]:
                nonlocal rows, characters
                for batch in batches:
                    rows += len(batch)
                    characters += int(batch.str.len().sum())
                    yield from batch
                    if rows >= ROWS or characters >= CHARACTERS:
                        break

            found = search(some(), block)
            if not rows:
                return
            yield pd.Series([[dict(zip(names, m, strict=True)) for m in ms] for ms in found], dtype=object)

    return matches


def blocks_of(texts: list[str | None]) -> list[tuple[int, list[str | None]]]:
    """(number of the first item, items) of at most BLOCK_WORDS words, or one item."""
    out: list[tuple[int, list[str | None]]] = []
    words = BLOCK_WORDS + 1
    for i, text in enumerate(texts):
        more = len(word_tokens(text or ""))
        if words + more > BLOCK_WORDS:
            out.append((i, []))
            words = 0
        out[-1][1].append(text)
        words += more
    return out


def matches_column(
    texts: list[str | None], text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL
) -> Column:
    """Matches of each row's text with the items, which are numbered in the given order."""
    found = [
        (first, _searcher(build_block(block, similarity, recall))(F.col(text))) for first, block in blocks_of(texts)
    ]
    if not found:
        return F.expr(f"CAST(array() AS {MATCHES})")
    shifted = [
        F.transform(column, lambda m, first=first: m.withField("item", (m["item"] + first).cast("int")))
        if first
        else column
        for first, column in found
    ]
    return F.concat(*shifted) if len(shifted) > 1 else shifted[0]


def read_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> list[tuple[int | None, str | None]]:
    """The stated query set, in order of its ids."""
    rows = benchmark.select(F.col(item_id), F.col(text)).collect()
    return sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def contaminations(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, start, words, distance): a row for each document and item found in it."""
    items = read_items(benchmark)
    found = docs.select("doc_id", F.explode(matches_column([t for _, t in items], "text", similarity)).alias("m"))
    ids = F.array(*[F.lit(i).cast("long") for i, _ in items]) if items else F.expr("array(cast(null as long))")
    return found.select(
        "doc_id",
        ids[F.col("m.item")].alias("item_id"),
        F.col("m.start").alias("first_word"),
        F.col("m.words").alias("words"),
        F.col("m.distance").alias("distance"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """The documents in which no item was found."""
    items = [t for _, t in read_items(benchmark)]
    return docs.filter(F.size(matches_column(items, text, similarity)) == 0)
