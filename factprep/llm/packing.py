"""Packing token sequences by best-fit decreasing.

Documents are tokenised whole, ended by one end id, and cut into full windows;
what is left of each document is packed with others: longest first, each into
the open window with the least room that still holds it. A segment tree over
remaining capacities finds that window in logarithmic time.

Each task packs its own documents, in blocks of at most BLOCK of them, so nothing is
shuffled and memory is bounded; a sequence's number is made of partition, block
and window. A sequence is written as long as it is filled; its consumer pads it.

Null texts count as empty and give the end id alone. Repeated rows are packed
each on its own; null ids pass through.
"""

from __future__ import annotations

import json
import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 2048
END = 1
BLOCK = 65_536
#: Words, lately used and before that, whose ids a worker remembers, and the longest of them in characters.
REMEMBERED, LONGEST = 100_000, 32
#: A space that white space follows.
SPACED = [" " + c for c in " \t\n\r\x0b\x0c\x85\xa0"]
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Letters up to here are classed alike by every Unicode version; other texts take the tokenizer's own path.
PLAIN = regex.compile(r"[\x00-ɏ‐-‧]*")


class Windows:
    """Open windows by remaining capacity: a segment tree of counts, and a stack of windows at each leaf."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(self.leaves)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.counts[node] += by
            node >>= 1

    def put(self, room: int, window: int) -> None:
        self.stacks[room].append(window)
        self._add(room, 1)

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of at least ``need`` that some window has."""
        node = need + self.leaves
        if self.counts[node]:
            return need
        while node > 1:
            if not node & 1 and self.counts[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.leaves:
            node *= 2
            if not self.counts[node]:
                node += 1
        return node - self.leaves

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.stacks[room].pop()


def best_fit(lengths: list[int], capacity: int = WINDOW) -> list[tuple[int, int]]:
    """(window, offset) of each length, none longer than the capacity; windows count from 0."""
    windows, placed, opened = Windows(capacity), [(0, 0)] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[i]
        room = windows.tightest(need)
        if room is None:
            room, window = capacity, opened
            opened += 1
        else:
            window = windows.take(room)
        placed[i] = (window, capacity - room)
        if room > need:
            windows.put(room - need, window)
    return placed


def byte_ranks(tokenizer: str) -> dict[bytes, int]:
    """The byte strings of a byte-level BPE file with their ids, which are also the ranks of their merges."""
    with open(tokenizer, encoding="utf-8") as file:
        whole = json.load(file)
    added = {t["id"] for t in whole["added_tokens"]}
    vocabulary = {t: i for t, i in whole["model"]["vocab"].items() if i not in added}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    return {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if all(c in byte_of for c in t)}


def added_tokens(tokenizer: str) -> list[str]:
    """Texts that the tokenizer file adds to its vocabulary as whole tokens."""
    with open(tokenizer, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file)["added_tokens"]]


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit numbers.

    A byte-level BPE splits a text by its pattern and merges each piece alone. No piece
    goes on over a space that a letter, digit or sign follows, other than to start
    with it; so in texts where no white space follows a space, the ids of words between
    spaces are remembered. Pieces are merged by a second library from the same
    file, as that is several times faster on single words; texts with letters that the two
    may class differently go to the tokenizer itself.
    """

    def __init__(self, tokenizer: str, pattern: str):
        import tiktoken

        self.file, self.tokenizer = tokenizer, None
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_ranks(tokenizer), special_tokens={})
        self.merge = encoding.encode_ordinary
        # Such marks in a text are tokens of their own, which only the tokenizer tells.
        self.marks = added_tokens(tokenizer)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.file)
        return pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, text: str) -> bytes:
        ids = self.older.get(text) or pack(self.merge(" " + text))
        if len(text) <= LONGEST:
            if len(self.words) >= REMEMBERED:
                self.words, self.older = {}, self.words
            self.words[text] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if any(mark in text for mark in self.marks):
            return self.whole(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if not PLAIN.fullmatch(text):
                return self.whole(text)
        if text.endswith(" ") or any(pair in text for pair in SPACED):
            return pack(self.merge(text))
        first, *words = text.split(" ")
        get, word = self.words.get, self.word
        return pack(self.merge(first)) + b"".join([get(w) or word(w) for w in words])


def encoder(tokenizer: str, pattern: str) -> Encoder:
    """The worker's encoder; it outlives the task, and so does what it remembers."""
    kept = vars(sys).setdefault("_encoders", {})
    if (tokenizer, pattern) not in kept:
        kept[tokenizer, pattern] = Encoder(tokenizer, pattern)
    return kept[tokenizer, pattern]


def pack(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes() if len(ids) > 64 else struct.pack(f"<{len(ids)}I", *ids)


def _packer(tokenizer: str, pattern: str, window: int, end: int, block: int):
    schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])
    ending = pack([end])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, pattern)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 40
        pieces: list[list[int]] = []  # doc_id, start, length, crc, tokens
        documents = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            full = [p for p in pieces if p[2] == window]
            part = [p for p in pieces if p[2] < window]
            placed = best_fit([p[2] for p in part], window)
            rows = [[*p, number + i, 0] for i, p in enumerate(full)]
            number += len(full)
            rows += [[*p, number + w, o] for p, (w, o) in zip(part, placed, strict=True)]
            number += max((w for w, _ in placed), default=-1) + 1
            pieces.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + ending
                tokens = len(ids) // 4
                for start in range(0, tokens, window):
                    cut = ids[4 * start : 4 * (start + window)]
                    pieces.append([doc, start, len(cut) // 4, zlib.crc32(cut), tokens])
                documents += 1
                if documents % block == 0:
                    yield from flush()
        yield from flush()

    return run


def packed(
    docs: DataFrame, tokenizer: str, pattern: str, *, window: int = WINDOW, end: int = END, block: int = BLOCK
) -> DataFrame:
    """One row for each piece: where it lies in its document and in which sequence at which offset."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_packer(tokenizer, pattern, window, end, block), PIECES)
