import hashlib
import itertools
import random
import string

import numpy as np
import pyarrow as pa
import pytest
from llm.corpus import documents, empty_documents, odd_documents

from factprep.llm import pii

CARD, PHONE, MAIL, IP = "4111 1111 1111 1111", "+1 (200) 555-0100", "ann.b@mail.example.com", "10.20.30.40"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (f"a {MAIL} b", [(0, 2, 24)]),
        ("a@b", []),
        ("x@y.z.w!", [(0, 0, 7)]),
        (f"at {IP}.", [(1, 3, 14)]),
        ("256.1.1.1 1.2.3.4.5", [(1, 10, 17)]),
        ("00001.0255.3.4", [(1, 0, 14)]),
        (CARD, [(2, 0, 19)]),
        ("4111 1111 1111 1112", []),
        ("4111-1111-1111-1111", [(2, 0, 19)]),
        (f"call {PHONE}", [(3, 5, 22)]),
        ("+1234567", []),
        (f"é {PHONE} {CARD}", []),  # both patterns run across both
        ("٣" * 16, []),
    ],
)
def test_patterns(text, expected):
    assert sorted(pii.pattern_spans(text)[0]) == expected


NAME, HOST = set(string.ascii_letters + string.digits + "._%+-"), set(string.ascii_letters + string.digits + "-")


def slow_spans(text):
    """Base spans by trying every end of every start, longest first, with no regular expressions."""
    digits = lambda x: [int(c) for c in x if c in string.digits]

    def email(x):
        name, _, host = x.partition("@")
        parts = host.split(".")
        return name and set(name) <= NAME and len(parts) > 1 and all(p and set(p) <= HOST for p in parts)

    def ip(x):
        return x.count(".") == 3 and all(p and set(p) <= set(string.digits) for p in x.split("."))

    def card(x):
        if len(x) < 2 or not set(x) <= set(string.digits + " -") or x[0] in " -" or x[-1] in " -":
            return False
        return not any(a in " -" and b in " -" for a, b in itertools.pairwise(x))

    def phone(x):
        inner = set(string.digits + " ().-")
        return len(x) >= 4 and x[0] == "+" and x[1].isdigit() and x[-1].isdigit() and set(x[1:]) <= inner

    def luhn(x):
        twice = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits(x)))]
        return sum(twice) % 10 == 0

    kinds = [
        (email, lambda x: True),
        (ip, lambda x: all(int(p) <= 255 for p in x.split("."))),
        (card, lambda x: 13 <= len(digits(x)) <= 19 and luhn(x)),
        (phone, lambda x: 9 <= len(digits(x)) <= 15),
    ]
    out = []
    for number, (fits, check) in enumerate(kinds):
        at = 0
        while at < len(text):
            end = next((e for e in range(len(text), at, -1) if fits(text[at:e])), None)
            if end and check(text[at:end]):
                out.append((number, at, end))
            at = end or at + 1
    return out


def test_base_spans_by_trying_every_place():
    rng = random.Random(3)
    parts = [CARD, PHONE, MAIL, IP, "4111111111111111", "+12005550100", "a@b.c", "1.2.3.4", "256", "0", " ", "-", ".", "@", "+", "é", "("]
    count = 0
    for _ in range(400):
        text = "".join(rng.choice(parts) if rng.random() < 0.7 else rng.choice("019.-+ @ax") for _ in range(rng.randint(1, 9)))
        spans = sorted(pii.pattern_spans(text)[0])
        assert spans == sorted(slow_spans(text)), text
        count += len(spans)
    assert count > 300


def test_gradients():
    rng, w = np.random.default_rng(1), {k: v.astype(np.float64) for k, v in pii.first_weights().items()}
    rows, tags = rng.integers(0, pii.SYMBOLS, (3, 7)), rng.integers(0, pii.TAGS, (3, 7))
    _, grads = pii.gradients(rows, tags, w)
    for name, weight in w.items():
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in weight.shape)
            step = 1e-3
            change = []
            for sign in (1, -1):
                moved = {k: v.copy() for k, v in w.items()}
                moved[name][at] += sign * step
                change.append(pii.gradients(rows, tags, moved)[0])
            assert abs((change[0] - change[1]) / (2 * step) - grads[name][at]) < 2e-3, name


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(4)
    w = {"start": rng.normal(size=pii.TAGS), "moves": rng.normal(size=(pii.TAGS, pii.TAGS))}
    stretches = [rng.normal(size=(n, pii.TAGS)).astype(np.float32) for n in (1, 3, 2, 4)]
    for scores, path in zip(stretches, pii.viterbi(stretches, w), strict=True):
        total = lambda p, s=scores: w["start"][p[0]] + sum(s[t, k] for t, k in enumerate(p)) + sum(
            w["moves"][a, b] for a, b in zip(p, p[1:], strict=False)
        )
        every = np.stack(np.meshgrid(*[range(pii.TAGS)] * len(scores), indexing="ij"), axis=-1).reshape(-1, len(scores))
        assert abs(total(path.tolist()) - max(total(p) for p in every.tolist())) < 1e-4


@pytest.fixture(scope="module")
def texts():
    import duckdb

    rows = duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet' ORDER BY doc_id").fetchall()
    return [t for (t,) in rows]


@pytest.fixture(scope="module")
def model(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts[:8000])], names=["text"])
    rows = [tuple(r.values()) for out in pii._windows([batch]) for r in out.to_pylist()]
    return pii.Recogniser(pii.train(*pii.training_rows(rows)))


def test_held_out_labels_are_learned(texts, model):
    batch = pa.RecordBatch.from_arrays([pa.array(texts[8000:])], names=["text"])
    rows = [tuple(r.values()) for out in pii._windows([batch]) for r in out.to_pylist()]
    assert len(rows) > 50
    spans = found = right = 0
    for text, tags, _, _ in rows:
        scores, _ = pii.emissions(np.array([pii.symbols(text) + [pii.PAD] * (pii.WINDOW - len(text))]), model.weights)
        got = set(pii.spans_of(pii.viterbi([scores[: len(text), 0]], model.weights)[0]))
        own = set(pii.spans_of(np.array([int(c) for c in tags])))
        spans, found, right = spans + len(own), found + len(got), right + len(own & got)
    assert right / spans > 0.95 and right / found > 0.95


def test_touching_spans_are_parted(model):
    texts = [f"Der Text hat {PHONE} {CARD} und mehr.", f"zu {PHONE} {IP} von", "no data 1, 2 and 3.0 here", ""]
    added = model.added(texts, [[] for _ in texts])
    kinds = [{pii.KINDS[k]: texts[i][a:b] for k, a, b in spans} for i, spans in enumerate(added)]
    assert kinds == [{"phone": PHONE, "card": CARD}, {"phone": PHONE, "ip": IP}, {}, {}]


def planted(texts, seed=9):
    """Held-out texts without personal data into which a span in another spelling, or a number that is none, is put."""
    rng = np.random.default_rng(seed)
    batch = pa.RecordBatch.from_arrays([pa.array(texts[8000:])], names=["text"])
    rows = [tuple(r.values()) for out in pii._windows([batch]) for r in out.to_pylist()]
    plain = [t[:400] for t in texts[8000:] if t and len(t) > 400 and not any(c in "0123456789@" for c in t[:400])][:400]
    for i, text in enumerate(plain * 2):
        at = text.find(" ", int(rng.integers(50, 300))) + 1
        if i % 2:
            window, tags, a, b = rows[rng.integers(len(rows))]
            piece, tags = pii.respelled(window[a:b], [int(c) for c in tags[a:b]], rng)
            yield text[:at] + piece + " " + text[at:], {((tags[0] - 1) // 2, at, at + len(piece))}
        else:
            yield text[:at] + pii.decoy(rng)[0] + " " + text[at:], set()


def test_other_spellings_are_found_and_other_numbers_left_alone(texts, model):
    rows = list(planted(texts))
    added = model.added([t for t, _ in rows], [pii.pattern_spans(t)[0] for t, _ in rows])
    right = sum(len(own & set(found)) for (_, own), found in zip(rows, added, strict=True))
    assert right / sum(len(own) for _, own in rows) > 0.95
    assert right / sum(map(len, added)) > 0.98


def test_spellings_that_no_example_has(model):
    texts = [
        "Sie rief gestern (200) 555 0100 an und",
        "und zahlte mit 4111_1111_1111_1111 wie",
        "am 2024-03-15 um 10:30 kamen 1,200,300 oder 12345678",
        "Nummer 4111.1111.1111.1112 ist keine",
    ]
    added = model.added(texts, [[] for _ in texts])
    found = [{pii.KINDS[k]: texts[i][a:b] for k, a, b in spans} for i, spans in enumerate(added)]
    assert found == [
        {"phone": "(200) 555 0100"},
        {"card": "4111_1111_1111_1111"},
        {},
        {},
    ]


@pytest.mark.parametrize(
    ("kind", "text", "expected"),
    [
        ("email", "a (at) b.c", True),
        ("email", "a[at]b[dot]c", True),
        ("email", "a at b.c", False),
        ("ip", "10[.]20[.]30[.]40", True),
        ("ip", "10[.]20[.]30[.]400", False),
        ("ip", "10.20.30", False),
        ("card", "4111.1111.1111.1111", True),
        ("card", "4111.1111.1111.1112", False),
        ("phone", "200-555-0100", True),
        ("phone", "2005550100", False),
        ("phone", "200-555-01x0", False),
    ],
)
def test_checks_in_any_spelling(kind, text, expected):
    assert pii.likely(kind, text) == expected


def test_margin_is_the_difference_of_two_paths():
    rng = np.random.default_rng(6)
    w = {"start": rng.normal(size=pii.TAGS), "moves": rng.normal(size=(pii.TAGS, pii.TAGS))}
    scores, path = rng.normal(size=(6, pii.TAGS)), np.array([1, 2, 0, 3, 4, 4])
    total = lambda p: w["start"][p[0]] + sum(scores[t, k] for t, k in enumerate(p)) + sum(
        w["moves"][a, b] for a, b in itertools.pairwise(p)
    )
    assert np.isclose(pii.margin(scores, path, 0, 2, w), total(path) - total([0, 0, 0, 3, 4, 4]))
    assert np.isclose(pii.margin(scores, path, 3, 6, w), total(path) - total([1, 2, 0, 0, 0, 0]))


def test_base_spans_stay_and_added_ones_are_apart(spark, model, texts):
    some = texts[:3000]
    rows = pii.found(documents(spark, some), model).collect()
    for r in rows:
        base = sorted(pii.pattern_spans(some[r.doc_id])[0])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert len(spans) == len(base) + r.n_added
        assert {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))
        places = sorted((int(a), int(b)) for k, a, b in spans if [pii.KINDS.index(k), int(a), int(b)] not in map(list, base))
        assert all(x[1] <= y[0] for x, y in zip(places, places[1:], strict=False))


def test_fit_and_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    model = pii.fit(odd)
    assert model.weights is None
    done = pii.found(odd, model)
    assert set(odd.columns) <= set(done.columns) and done.count() == odd.count()
    assert {r.spans for r in done.collect()} == {""}
    trained = pii.fit(documents(spark, [f"text {i} {MAIL} and {PHONE} too" for i in range(20)]), sample=10)
    assert trained.weights is not None
    assert pii.found(empty_documents(spark), trained).collect() == []


def test_long_stretches_are_decoded_alone():
    """Memory goes by the characters there are, not by the longest stretch times their number."""
    import tracemalloc

    rng, w = np.random.default_rng(1), pii.first_weights()
    stretches = [rng.normal(size=(n, pii.TAGS)).astype(np.float32) for n in [150_000, *[40] * 1500]]
    tracemalloc.start()
    paths = pii.viterbi(stretches, w)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6, peak
    for i in (0, 1, 700, 1500):
        assert (paths[i] == pii.viterbi([stretches[i]], w)[0]).all()
