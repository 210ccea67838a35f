import random
import zlib

import public_tokenizers
import pytest
from llm.corpus import documents, empty_documents, odd_documents
from tokenizers import Tokenizer

from factprep.llm import packing

ROOT = "/root/testdata/sf0.001"
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def plain_tokenizer():
    tokenizer = Tokenizer.from_file(PATH)
    return tokenizer


def slow_best_fit(lengths, capacity):
    rooms, placed = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [r for r in rooms if r >= lengths[i]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - lengths[i])
        else:
            rooms.append(capacity - lengths[i])
        placed[i] = True
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 60) for _ in range(rng.randint(0, 300))]
    placed = packing.best_fit(lengths, 64)
    filled = {}
    for (window, offset), n in sorted(zip(placed, lengths, strict=True)):
        assert offset == filled.get(window, 0)
        filled[window] = offset + n
    assert sorted(64 - n for n in filled.values()) == slow_best_fit(lengths, 64)


def test_encoder_agrees_with_the_tokenizer():
    encode, plain, rng = packing.Encoder(PATH, PATTERN), plain_tokenizer(), random.Random(4)
    letters = [chr(c) for c in range(0x250)] + list("’—…  語字🙂​<|endoftext|>")
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(1500)]
    few = " \n\t'sab1.,é\xa0|"
    texts += ["".join(rng.choices(few, k=rng.randint(0, 14))) for _ in range(6000)]
    texts += [" ".join("".join(rng.choices("ab'.é\n", k=rng.randint(1, 5))) for _ in range(9)) for _ in range(3000)]
    texts += ["", "<|endoftext|>", "don't we'll  \n\n x", " \x1c\x1f\x85\xa0 a", "a" * 500, "it's 12,345.67\r\n\tend "]
    for text in texts:
        assert encode(text) == packing.pack(plain.encode(text, add_special_tokens=False).ids), text


def valid(rows, texts):
    """Every id lies in one piece; sequences are gapless and not too long."""
    plain = plain_tokenizer()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for doc, pieces in by_doc.items():
        ids = packing.pack(plain.encode(texts[doc] or "", add_special_tokens=False).ids + [1])
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids) // 4)
            assert p.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + p.length)])
            at += p.length
        assert 4 * at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.WINDOW
    return len(by_sequence)


def test_documents_are_packed_with_little_padding(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    rows = packing.packed(docs.coalesce(1), PATH, PATTERN).collect()
    sequences = valid(rows, {r.doc_id: r.text for r in docs.collect()})
    assert sequences <= 1.03 * sum(r.length for r in rows) / packing.WINDOW + 2


def test_blocks_keep_sequences_apart(spark):
    docs = documents(spark, [f"text {i} " * i for i in range(60)])
    rows = packing.packed(docs.repartition(3), PATH, PATTERN, block=7).collect()
    valid(rows, {i: f"text {i} " * i for i in range(60)})


def test_odd_and_empty_tables(spark):
    rows = packing.packed(odd_documents(spark), PATH, PATTERN).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert sum(r.doc_tokens for r in rows if r.doc_id == 0) == 2
    assert packing.packed(empty_documents(spark), PATH, PATTERN).collect() == []
