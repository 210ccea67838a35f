"""Language-model scoring by a hidden Markov model.

Tokens are whitespace-separated words with A-Z in lower case, then one end token.
Word counts are summed over all training documents. The HEAD most frequent words
have an emission probability of their own in each state; every other word is
emitted as one of a few shape classes, times its share of the class, which
depends on its own exact count. As many words as the corpus has of a class only
once are set aside for words of it that the corpus lacks. HEAD bounds what is sent to the executors; the
rest of the vocabulary, of any size, is only ever joined.

Baum-Welch: each task runs the scaled forward-backward recursion over its
documents and returns expected emission and transition counts, which Spark sums;
the driver holds the states' parameters alone. A document's score is the exact
log10 likelihood of its whole token sequence under the trained model, from the
scaled forward recursion.

Null texts count as empty: their one token is the end. Without training documents
all counts are 0 and the states are equal. Rows with equal texts have equal
scores; null ids are training rows if the remainder of the empty text says so.
"""

from __future__ import annotations

import math
import sys
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factprep.llm.common import remainder, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEAD = 1 << 18
STATES = 8
ROUNDS = 3
#: Tokens whose recursion runs side by side, words counted before a task passes them on.
BATCH, COUNTED = 1_500_000, 400_000
#: Texts whose symbols are passed on at a time.
ENCODED_ROWS = 500
#: Most tasks of a training round, as each returns counts for up to HEAD words.
TASKS = 4096
#: Pseudo-counts of the word distribution in every state, and of each transition.
PRIOR, TRANSITION_PRIOR = 1000.0, 1.0
CLASSES = 20


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def word_class(word: bytes) -> int:
    """Shape of a word: length, letters only, plain ASCII."""
    n = len(word)
    size = 0 if n < 4 else 1 if n < 7 else 2 if n < 10 else 3 if n < 14 else 4
    plain = word.isascii()
    return size * 4 + 2 * (not (word.isalpha() if plain else word.decode("utf-8", "replace").isalpha())) + plain


# --- counts -----------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
    counts: Counter[bytes] = Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        if counts:
            arrays = [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)
            counts.clear()

    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(tokens(text))
            if len(counts) > COUNTED:
                yield from flush()
    yield from flush()


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n) over the training texts."""
    parts = training.select(F.col("text").cast("binary")).mapInArrow(_count, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Head words in order of their symbol, their counts, the totals of the rest by class, and the words seen once."""

    words: list[bytes]
    counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    once: np.ndarray
    documents: int
    tokens: int
    types: int

    @property
    def end(self) -> int:
        return len(self.words) + CLASSES

    @property
    def symbols(self) -> int:
        return self.end + 1

    def novel(self) -> np.ndarray:
        """Expected tokens, by symbol, of words that the training texts lack."""
        return np.concatenate((np.zeros(len(self.words)), self.once + 0.5, [0]))

    def totals(self) -> np.ndarray:
        return np.concatenate((self.counts, self.class_tokens, [self.documents])) + self.novel()


def _cut(counted: list[tuple[int, int]], most: int) -> tuple[int, int]:
    """The key at which rows, counted by key from the first on, reach ``most``, and the rows still wanted of it."""
    for key, rows in counted:
        if rows >= most:
            return key, most
        most -= rows
    raise ValueError("There are fewer rows.")


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The ``most`` words of highest count; of words at the cutting count, those first by hash.

    The cut is found from histograms: of logarithms of the counts, of the counts in the cutting step, and of hashes at the
    cutting count. So no task ever sorts more than one of 65,536 parts of the words of one count.
    """
    if counts.count() <= most:
        return counts
    falling = lambda frame, key: sorted(
        ((r["k"], r["c"]) for r in frame.groupBy(key.alias("k")).agg(F.count("*").alias("c")).collect()), reverse=True
    )
    step, mark = F.floor(F.log2("n") * 64), F.shiftright(F.xxhash64("word"), 48)
    at, left = _cut(falling(counts, step), most)
    least, left = _cut(falling(counts.filter(step == at), F.col("n")), left)
    tied = counts.filter(F.col("n") == least)
    part, left = _cut(falling(tied, mark), left)
    above = counts.filter((F.col("n") > least) | ((F.col("n") == least) & (mark > part)))
    return above.unionByName(tied.filter(mark == part).orderBy("word").limit(left))


def vocabulary(counts: DataFrame, documents: int, head: int = HEAD) -> Vocabulary:
    rows = most_frequent(counts, head).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    words, numbers = [bytes(w) for w in rows["word"].to_pylist()], rows["n"].to_numpy()
    known = counts.sparkSession.sparkContext.broadcast(frozenset(words))

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, CLASSES + 1), np.int64)
        sums[0] = np.arange(CLASSES + 1)
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                c = word_class(word)
                listed = word in known.value
                sums[1:, CLASSES] += n, 1, 0
                sums[1:, c] += n * (not listed), not listed, n == 1
        yield pa.RecordBatch.from_arrays([pa.array(s) for s in sums], names=["class", "n", "words", "once"])

    found = np.zeros((3, CLASSES + 1), np.int64)
    parts = counts.mapInArrow(classes, "class long, n long, words long, once long")
    for r in parts.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("n", "words", "once")]).collect():
        found[:, r["class"]] = r["n"], r["words"], r["once"]
    return Vocabulary(
        words,
        np.asarray(numbers, np.int64),
        found[0, :CLASSES],
        found[1, :CLASSES],
        found[2, :CLASSES],
        documents,
        int(found[0, CLASSES]) + documents,
        int(found[1, CLASSES]) + (documents > 0),
    )


# --- the model --------------------------------------------------------------


@dataclass
class Model:
    start: np.ndarray
    moves: np.ndarray
    emissions: np.ndarray  # symbol, state


def first_model(words: Vocabulary, states: int = STATES) -> Model:
    """Lasting states that each slightly prefer words of some endings, so that training can tell them apart."""
    totals = words.totals() + 1e-3
    prefer = np.ones((words.symbols, states))
    for i, word in enumerate(words.words):
        prefer[i, int.from_bytes(word[-2:], "big") * 2654435761 % 2**32 * states >> 32] = 3
    for c in range(CLASSES + 1):
        prefer[len(words.words) + c, c % states] = 1.5
    emissions = totals[:, None] * prefer
    moves = np.ones((states, states)) + 100 * np.eye(states)
    return Model(
        np.full(states, 1 / states), moves / moves.sum(axis=1, keepdims=True), emissions / emissions.sum(axis=0)
    )


class Packed:
    """Sequences laid out by time: all first symbols, then all second ones; longest sequence first."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray):
        begin = np.cumsum(lengths) - lengths
        self.order = np.argsort(-lengths, kind="stable")
        lengths, begin = lengths[self.order], begin[self.order]
        # Sequences still running at each time.
        self.active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(1, int(lengths[0]) + 1), side="left")
        self.offsets = np.cumsum(self.active) - self.active
        first = np.cumsum(lengths) - lengths
        time = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        self.symbols = np.empty(len(time), np.int64)
        self.symbols[self.offsets[time] + np.repeat(np.arange(len(lengths)), lengths)] = values[
            np.repeat(begin, lengths) + time
        ]


def forward(packed: Packed, model: Model, emitted: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Scales of every token, and on request the scaled forward probabilities."""
    moves = model.moves.astype(emitted.dtype)
    alpha, scales = np.empty_like(emitted) if keep else None, np.empty(len(emitted), emitted.dtype)
    offsets, active = packed.offsets.tolist(), packed.active.tolist()
    now = model.start.astype(emitted.dtype) * emitted[: active[0]]
    for t, n in enumerate(active):
        o = offsets[t]
        if t:
            now = now[:n] @ moves
            now *= emitted[o : o + n]
        scale = now.sum(axis=1)
        now /= scale[:, None]
        scales[o : o + n] = scale
        if keep:
            alpha[o : o + n] = now
    return scales, alpha


def log_likelihoods(values: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """log10 probability of each of the sequences that lie one after the other in ``values``."""
    packed = Packed(values, lengths)
    scales, _ = forward(packed, model, model.emissions[packed.symbols], False)
    logs, out = np.log10(scales), np.zeros(len(lengths))
    for o, n in zip(packed.offsets.tolist(), packed.active.tolist(), strict=True):
        out[:n] += logs[o : o + n]
    back = np.empty_like(out)
    back[packed.order] = out
    return back


def expected_counts(
    values: np.ndarray, lengths: np.ndarray, model: Model
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions (symbol, state) of the sequences."""
    kind = np.float32
    packed = Packed(values, lengths)
    emitted = model.emissions.astype(kind)[packed.symbols]
    scales, alpha = forward(packed, model, emitted, True)
    states, back = len(model.start), model.moves.astype(kind).T
    offsets, active = packed.offsets.tolist(), packed.active.tolist()
    seen = np.zeros((states, states))
    emitted /= scales[:, None]
    beta = np.ones((active[0], states), kind)
    later = 0
    for t in range(len(active) - 1, -1, -1):
        o, n = offsets[t], active[t]
        if later:
            p = offsets[t + 1]
            inner = emitted[p : p + later] * beta[:later]
            seen += alpha[o : o + later].T @ inner
            beta[:later] = inner @ back
        alpha[o : o + n] *= beta[:n]
        later = n
    symbols = model.emissions.shape[0]
    counts = np.stack([np.bincount(packed.symbols, a, symbols) for a in np.ascontiguousarray(alpha.T)], axis=1)
    return alpha[: active[0]].sum(axis=0, dtype=float), seen * model.moves, counts


def encode(words: list[bytes], numbers: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """Symbols of a whole text, its end included, and the places of its rest words."""
    get, head = numbers.get, len(numbers)
    symbols = [get(w, -1) for w in words]
    symbols.append(head + CLASSES)
    rest = [i for i, s in enumerate(symbols) if s < 0]
    for i in rest:
        symbols[i] = head + word_class(words[i])
    return symbols, rest


ENCODED = (
    "doc_id long, held_out boolean, t1 long, t2 long, symbols array<int>, rest array<struct<word: binary, n: long>>"
)


def encode_texts(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """Every text as symbols, with its rest words and how often it has them."""
    known = docs.sparkSession.sparkContext.broadcast(words.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {w: i for i, w in enumerate(known.value)}
        for batch in batches:
            texts = batch.column("text")
            for at in range(0, len(batch), ENCODED_ROWS):
                symbols, ends, spelled, times, rest_ends = array("i"), [0], [], [], [0]
                for text in texts.slice(at, ENCODED_ROWS).to_pylist():
                    own = tokens(text)
                    found, rest = encode(own, numbers)
                    symbols.extend(found)
                    ends.append(len(symbols))
                    if rest:
                        counted = Counter([own[i] for i in rest])
                        spelled.extend(counted.keys())
                        times.extend(counted.values())
                    rest_ends.append(len(spelled))
                rest_words = pa.StructArray.from_arrays(
                    [pa.array(spelled, pa.binary()), pa.array(times, pa.int64())], names=["word", "n"]
                )
                part = batch.slice(at, ENCODED_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc_id", "held_out", "t1", "t2")),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(symbols, np.int32))),
                        pa.ListArray.from_arrays(pa.array(rest_ends, pa.int32()), rest_words),
                    ],
                    names=["doc_id", "held_out", "t1", "t2", "symbols", "rest"],
                )

    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
        F.col("text").cast("binary").alias("text"),
    )
    return keyed.mapInArrow(run, ENCODED)


def sequences(column: pa.ListArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past the last, values, lengths) of the column's lists, about BATCH values at a time."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + BATCH, side="right")) - 1)
        to = min(to, len(column))
        yield at, to, values[ends[at] : ends[to]], np.diff(ends[at : to + 1])
        at = to


def train(encoded: DataFrame, words: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over the symbols of all training texts, one pass for each round."""
    spark = encoded.sparkSession
    model, totals = first_model(words, states), words.totals()
    if not words.documents:
        return model
    share = (totals + 1e-3) / (totals + 1e-3).sum()
    texts = encoded.select("symbols").coalesce(TASKS)
    names = [f"s{k}" for k in range(states)]
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(astuple(model))

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            now = Model(*sent.value)
            sums = np.zeros((now.emissions.shape[0] + states + 1, states))
            for batch in batches:
                for _, _, values, lengths in sequences(batch.column(0)):
                    starts, moves, counts = expected_counts(values, lengths, now)
                    sums[0] += starts
                    sums[1 : states + 1] += moves
                    sums[states + 1 :] += counts
            rows = np.flatnonzero(sums.any(axis=1))
            arrays = [pa.array(rows), *(pa.array(sums[rows, k], pa.float32()) for k in range(states))]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", *names])

        parts = texts.mapInArrow(expect, "row long, " + ", ".join(f"{n} float" for n in names))
        found = parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
        sums = np.zeros((words.symbols + states + 1, states))
        sums[found["row"].to_numpy()] = np.stack([found[n].to_numpy() for n in names], axis=1)
        starts, moves = sums[0] + TRANSITION_PRIOR, sums[1 : states + 1] + TRANSITION_PRIOR
        seen = sums[states + 1 :]
        emissions = seen + words.novel()[:, None] * (seen.sum(axis=0) / seen.sum()) + PRIOR * share[:, None]
        sent.unpersist()
        model = Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emissions / emissions.sum(axis=0))
    return model


# --- scores -----------------------------------------------------------------

SCORED = "doc_id long, held_out boolean, t1 long, t2 long, n_tokens long, head_known long, head_base double, head_score double"


def score(encoded: DataFrame, words: Vocabulary, counts: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row."""
    sent = encoded.sparkSession.sparkContext.broadcast(astuple(model))
    head = len(words.words)
    base = np.log10(np.concatenate((words.counts, np.zeros(CLASSES), [words.documents])) + 1.0)
    # A rest word's share of its class: (count + 1) / (tokens + words + novel words + 1); the counts are joined below.
    shares = np.zeros(words.symbols)
    shares[head : head + CLASSES] = -np.log10(words.class_tokens + words.class_words + words.once + 1.0)
    listed = np.ones(words.symbols, np.int64)
    listed[head : head + CLASSES] = 0
    listed[words.end] = words.documents > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = Model(*sent.value)
        for batch in batches:
            for at, to, values, lengths in sequences(batch.column("symbols")):
                begin = np.cumsum(lengths) - lengths
                results = [
                    pa.array(lengths, pa.int64()),
                    pa.array(np.add.reduceat(listed[values], begin)),
                    pa.array(np.add.reduceat(base[values], begin)),
                    pa.array(log_likelihoods(values, lengths, now) + np.add.reduceat(shares[values], begin)),
                ]
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "held_out", "t1", "t2")), *results],
                    names=[c.split()[0] for c in SCORED.split(", ")],
                )

    rows = encoded.select("doc_id", "held_out", "t1", "t2", "symbols").mapInArrow(run, SCORED)
    # Rest words of equal texts are looked up for each and weighed by their number.
    copies = encoded.groupBy("t1", "t2").agg(F.count("*").alias("copies"))
    looked = stored(
        encoded.select("t1", "t2", F.inline("rest"))
        .withColumnRenamed("n", "times")
        .join(counts, "word", "left")
        .groupBy("t1", "t2")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("rest_log"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rest_known"),
        )
        .join(copies, ["t1", "t2"])
        .select("t1", "t2", (F.col("rest_log") / F.col("copies")).alias("rest_log"), F.expr("rest_known div copies AS rest_known")),
        "rest",
    )
    unit = math.log10(words.tokens + words.types + 1)
    more = F.coalesce("rest_log", F.lit(0.0))
    return rows.join(looked, ["t1", "t2"], "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("head_base") + more - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (F.col("head_score") + more).alias("score"),
    )


def held_out():
    return remainder("doc_id", 7) == 2


def scored(docs: DataFrame, head: int = HEAD, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Counts, training and scores of the documents, learning from those not held out."""
    training = docs.filter(~held_out())
    counts = stored(word_counts(training), "words")
    words = vocabulary(counts, training.count(), head)
    encoded = stored(encode_texts(docs, words), "encoded")
    return score(encoded, words, counts, train(encoded.filter("NOT held_out"), words, states, rounds))
