"""Personal data: fixed patterns, and a character-level BiLSTM with CRF transitions.

The patterns find e-mail addresses, IP addresses, payment cards and phone numbers,
left to right without overlaps, and drop what fails their checks. Where two of them
touch ("+1 (200) 555-0100 4111111111111111") a pattern runs across both and loses
them; and they know one spelling of each kind. The network, trained in numpy from the
patterns' spans, labels every character from its surroundings. Its spans are added
if they overlap no span of the patterns, cut no word or number, pass their kind's
check in any spelling (``likely``), and the best labelling beats the one without
them by MARGIN in log probability. Spans that pass the pattern need no margin.

Every kind needs a digit, "@" or a bracketed "at", so the network reads the characters
near any of those, in overlapping windows of WINDOW characters; all others are outside
any span. The windows' label scores are averaged, weighed towards their middles, and
one Viterbi pass over each stretch reconciles them.

Training takes a bounded sample: the SAMPLE windows around spans that come first by
hash; as many in which two spans are put side by side, in spellings that the
patterns do not know or between numbers that are no personal data. Without spans nothing
is added. Null texts count as empty and, like empty ones, have no spans. Repeated rows
have equal spans; other columns pass through, those named like the results are
replaced.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The kinds with their patterns, in the order in which results list them.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
KINDS = list(PATTERNS)
AT, DOT = r"(?:@|[\x20]*[(\[{][\x20]*(?:at|AT)[\x20]*[)\]}][\x20]*)", r"(?:\.|[\x20]*[(\[{][\x20]*(?:dot|DOT|\.)[\x20]*[)\]}][\x20]*)"
TRIGGER = re.compile(r"[0-9@]|[(\[{][\x20]*(?:at|AT)[\x20]*[)\]}]")
MAIL = re.compile(rf"[A-Za-z0-9._%+-]+{AT}[A-Za-z0-9-]+(?:{DOT}[A-Za-z0-9-]+)+")
#: Characters between the digits of numbers in any spelling.
BETWEEN = set(" .,-/()[]{}+_:")

WINDOW, STRIDE, REACH = 64, 32, 32
SAMPLE = 2000
EMBEDDED, HIDDEN = 10, 20
STEPS, ROWS, RATE = 400, 64, 0.02
#: Log probability by which a labelling with a span in another spelling must beat the one without it.
MARGIN = 6.0
#: Outside; then beginning and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
#: Digits and letters are one symbol each; other printable ASCII characters stand for themselves.
OTHERS = " \n.,@-+()%_:;/!?*#&$=|'\"[]{}"
PAD, DIGIT, UPPER_CASE, LOWER_CASE, OTHER, FIRST = 0, 1, 2, 3, 4, 5
SYMBOLS = FIRST + len(OTHERS)
CHUNK = 2048
#: Characters, padding included, that are decoded side by side, or one stretch.
CELLS = 1 << 20
Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def passes(kind: str, text: str) -> bool:
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def likely(kind: str, text: str) -> bool:
    """Whether a text passes its kind's check in any spelling."""
    if kind == "email":
        return MAIL.fullmatch(text) is not None
    if not all("0" <= c <= "9" or c in BETWEEN for c in text):
        return False
    parts = re.findall("[0-9]+", text)
    return passes(kind, ".".join(parts)) and (kind != "ip" or len(parts) == 4) and (kind != "phone" or len(parts) > 1)


def cuts(text: str, start: int, end: int) -> bool:
    """Whether a span starts or ends inside a word or number."""
    return text[start : start + 1].isalnum() and text[max(0, start - 1) : start].isalnum() or (
        text[end - 1 : end].isalnum() and text[end : end + 1].isalnum()
    )


def pattern_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Spans of the patterns in a whole text, and the matches of at least nine digits that fail."""
    spans, failed = [], []
    if not TRIGGER.search(text):
        return spans, failed
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        if kind == "email" and "@" not in text:
            continue
        for m in pattern.finditer(text):
            if passes(kind, m[0]):
                spans.append((number, m.start(), m.end()))
            elif sum(c.isdigit() for c in m[0]) >= 9:
                failed.append(m.span())
    return spans, failed


def symbols(text: str) -> list[int]:
    out = []
    for c in text:
        if "0" <= c <= "9":
            out.append(DIGIT)
        elif c.isupper():
            out.append(UPPER_CASE)
        elif c.isalpha():
            out.append(LOWER_CASE)
        else:
            at = OTHERS.find(c)
            out.append(OTHER if at < 0 else FIRST + at)
    return out


# --- network ----------------------------------------------------------------


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def first_weights(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    small = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    weights = {"embedding": small(SYMBOLS, EMBEDDED), "out": small(2 * HIDDEN, TAGS), "out_bias": np.zeros(TAGS)}
    for side in "fb":
        bias = np.zeros(4 * HIDDEN)
        bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
        weights |= {f"{side}x": small(EMBEDDED, 4 * HIDDEN), f"{side}h": small(HIDDEN, 4 * HIDDEN), f"{side}bias": bias}
    moves = np.zeros((TAGS, TAGS))
    for tag in range(2, TAGS, 2):  # inside follows the same kind's beginning or inside only
        moves[:, tag] = -4
        moves[[tag - 1, tag], tag] = 1
    weights |= {"moves": moves, "start": np.where(np.arange(TAGS) % 2 + (np.arange(TAGS) == 0) > 0, 0.0, -4.0)}
    return {k: v.astype(np.float32) for k, v in weights.items()}


def run_lstm(x: np.ndarray, w: dict[str, np.ndarray], side: str) -> tuple[np.ndarray, list]:
    """Hidden states over time (first axis), and what the backward pass needs."""
    inputs, hidden = x @ w[f"{side}x"] + w[f"{side}bias"], w[f"{side}h"]
    steps, n = x.shape[:2]
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    out, kept = np.empty((steps, n, HIDDEN), np.float32), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        z = inputs[t] + h @ hidden
        gates = sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, c = c, f * c + i * g
        squashed = np.tanh(c)
        kept.append((t, i, f, o, g, before, squashed, h))
        h = o * squashed
        out[t] = h
    return out, kept


def back_lstm(x, kept, dout, w, side, grads) -> np.ndarray:
    hidden = w[f"{side}h"]
    dz_all = np.empty((*x.shape[:2], 4 * HIDDEN), np.float32)
    dh = np.zeros_like(kept[0][5])
    dc = np.zeros_like(dh)
    grads[f"{side}h"] = np.zeros_like(hidden)
    for t, i, f, o, g, before, squashed, h in reversed(kept):
        dh = dh + dout[t]
        dc = dc + dh * o * (1 - squashed * squashed)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        grads[f"{side}h"] += h.T @ dz
        dz_all[t] = dz
        dh, dc = dz @ hidden.T, dc * f
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    grads[f"{side}x"] = x.reshape(-1, EMBEDDED).T @ flat
    grads[f"{side}bias"] = flat.sum(axis=0)
    return dz_all @ w[f"{side}x"].T


def emissions(rows: np.ndarray, w: dict[str, np.ndarray]) -> tuple[np.ndarray, tuple]:
    """Label scores (time, row, tag) of windows of symbols (row, time)."""
    x = w["embedding"][rows.T]
    ahead, kept_f = run_lstm(x, w, "f")
    back, kept_b = run_lstm(x, w, "b")
    both = np.concatenate([ahead, back], axis=2)
    return both @ w["out"] + w["out_bias"], (x, both, kept_f, kept_b)


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def gradients(rows: np.ndarray, tags: np.ndarray, w: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-likelihood of the label sequences under the CRF, and its gradients."""
    scores, (x, both, kept_f, kept_b) = emissions(rows, w)
    steps, n, _ = scores.shape
    tags, moves, each = tags.T, w["moves"], np.arange(rows.shape[0])
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[0] = w["start"] + scores[0]
    for t in range(1, steps):
        alpha[t] = scores[t] + log_sum(alpha[t - 1][:, :, None] + moves, 1)
    for t in range(steps - 2, -1, -1):
        beta[t] = log_sum(moves + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
    total = log_sum(alpha[-1], 1)
    dscores = np.exp(alpha + beta - total[:, None])
    pairs = np.exp(
        alpha[:-1][:, :, :, None] + moves + (scores[1:] + beta[1:])[:, :, None, :] - total[:, None, None]
    ).sum(axis=(0, 1))
    gold = w["start"][tags[0]] + sum(scores[t, each, tags[t]] for t in range(steps))
    gold = gold + sum(moves[tags[t - 1], tags[t]] for t in range(1, steps))
    for t in range(steps):
        dscores[t, each, tags[t]] -= 1
    np.subtract.at(pairs, (tags[:-1].ravel(), tags[1:].ravel()), 1)
    dscores /= n
    grads = {"moves": pairs / n, "start": dscores[0].sum(axis=0)}
    flat = dscores.reshape(-1, TAGS)
    grads["out"], grads["out_bias"] = both.reshape(-1, 2 * HIDDEN).T @ flat, flat.sum(axis=0)
    dboth = dscores @ w["out"].T
    dx = back_lstm(x, kept_f, dboth[:, :, :HIDDEN], w, "f", grads) + back_lstm(x, kept_b, dboth[:, :, HIDDEN:], w, "b", grads)
    grads["embedding"] = np.zeros_like(w["embedding"])
    np.add.at(grads["embedding"], rows.T.ravel(), dx.reshape(-1, EMBEDDED))
    return float((total - gold).mean()), grads


def train(rows: np.ndarray, tags: np.ndarray, steps: int = STEPS) -> dict[str, np.ndarray]:
    """Adam over shuffled batches; the same input gives the same weights."""
    w, rng = first_weights(), np.random.default_rng(3)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    order = np.zeros(0, int)
    for step in range(1, steps + 1):
        if len(order) < ROWS:
            order = np.concatenate([order, rng.permutation(len(rows))])
        taken, order = order[:ROWS], order[ROWS:]
        _, grads = gradients(rows[taken], tags[taken], w)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = RATE * min(1.0, 2.0 * (1 - (step - 1) / steps))
        for k, g in grads.items():
            g = g * min(1.0, 5 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            update = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
            w[k] = (w[k] - rate * update).astype(np.float32)
    return w


def viterbi(stretches: list[np.ndarray], w: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Best label sequence of each stretch of scores (time, tag); all of them side by side."""
    order = sorted(range(len(stretches)), key=lambda i: -len(stretches[i]))
    out: list[np.ndarray] = [np.zeros(0, int)] * len(stretches)
    at = 0
    while at < len(order):
        # The longest comes first and sets the width of all that are padded to it.
        some = order[at : at + max(1, min(CHUNK, CELLS // max(1, len(stretches[order[at]]))))]
        at += len(some)
        lengths = np.array([len(stretches[i]) for i in some])
        padded = np.zeros((int(lengths[0]), len(some), TAGS), np.float32)
        for j, i in enumerate(some):
            padded[: lengths[j], j] = stretches[i]
        score, back = w["start"] + padded[0], np.zeros(padded.shape, np.int8)
        for t in range(1, len(padded)):
            n = int((lengths > t).sum())
            step = score[:n, :, None] + w["moves"]
            back[t, :n] = step.argmax(axis=1)
            score[:n] = step.max(axis=1) + padded[t, :n]
        best = score.argmax(axis=1)
        for j, i in enumerate(some):
            path, tag = np.empty(lengths[j], int), int(best[j])
            for t in range(lengths[j] - 1, -1, -1):
                path[t] = tag
                tag = int(back[t, j, tag])
            out[i] = path
    return out


# --- labelled spans ---------------------------------------------------------


def _labels(spans: list[Span], start: int, end: int) -> list[int]:
    tags = [0] * (end - start)
    for kind, a, b in spans:
        for i in range(max(a, start), min(b, end)):
            tags[i - start] = 1 + 2 * kind + (i > a)
    return tags


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows around spans, with their labels as text; windows with a failed match teach nothing."""
    for batch in batches:
        texts, tags, first, last = [], [], [], []
        for text in batch.column(0).to_pylist():
            spans, failed = pattern_spans(text or "")
            ordered = sorted(spans, key=lambda s: s[1])
            if any(x[2] > y[1] for x, y in zip(ordered, ordered[1:], strict=False)):
                continue
            for _, a, b in ordered:
                start = max(0, a - int(hashlib.md5(text[a:b].encode()).hexdigest()[:4], 16) % (WINDOW // 2))
                end = min(len(text), start + WINDOW)
                cut = any(s < start < e or s < end < e for _, s, e in spans)
                if b <= end and not cut and not any(s < end and e > start for s, e in failed):
                    texts.append(text[start:end])
                    tags.append("".join(map(str, _labels(spans, start, end))))
                    first.append(a - start)
                    last.append(b - start)
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()), pa.array(tags, pa.string()), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
            names=["window", "tags", "first", "last"],
        )


def spaced(piece: tuple[str, list[int]], rng: np.random.Generator) -> tuple[str, list[int]]:
    """A run of digits sometimes written in groups of four; other spans as they are."""
    text, tags = piece
    mark = ("", "", " ", "-")[rng.integers(4)]
    if not mark or not text.isdigit():
        return piece
    text = mark.join(text[i : i + 4] for i in range(0, len(text), 4))
    return text, [tags[0]] + [tags[0] + 1] * (len(text) - 1)


def respelled(text: str, tags: list[int], rng: np.random.Generator) -> tuple[str, list[int]]:
    """A span in a spelling that its pattern does not know."""
    kind, parts = KINDS[(tags[0] - 1) // 2], re.findall("[0-9]+", text)
    form = int(rng.integers(4))
    if kind == "email":
        left, right = ("()", "[]", "{}")[rng.integers(3)]
        left, right = (left, right) if form % 2 else (" " + left, right + " ")
        at, dot = ("at", "dot") if rng.random() < 0.7 else ("AT", "DOT")
        name, host = text.split("@")
        text = name + left + at + right + (host if form < 2 else host.replace(".", left + dot + right))
    elif kind == "ip":
        text = ("[.]", " . ", "(.)", " [.] ")[form].join(parts)
    elif kind == "card":
        digits = "".join(parts)
        text = (".", "  ", "/", " - ")[form].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    else:
        if len(parts) == 1:
            parts = [parts[0][:-7], parts[0][-7:-4], parts[0][-4:]]
        text = (text[1:], "00 " + " ".join(parts), "-".join(parts), ".".join(parts))[form]
    return text, [tags[0]] + [tags[0] + 1] * (len(text) - 1)


def decoy(rng: np.random.Generator) -> tuple[str, list[int]]:
    """A number that is no personal data: a date, time, amount, version, code or plain digits."""
    few = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    text = (
        lambda: f"20{few(2)}-0{1 + rng.integers(9)}-{10 + rng.integers(20)}",
        lambda: f"{10 + rng.integers(20)}.0{1 + rng.integers(9)}.20{few(2)} {10 + rng.integers(13)}:{10 + rng.integers(49)}",
        lambda: f"{1 + rng.integers(99)},{few(3)},{few(3)}.{few(2)}",
        lambda: ".".join(few(1 + rng.integers(2)) for _ in range(2 + rng.integers(2))),
        lambda: f"{few(3)}-{few(1)}-{few(2)}-{few(6)}-{few(1)}",
        lambda: few(1 + rng.integers(14)),
        lambda: " ".join(few(1 + rng.integers(5)) for _ in range(3)),
        lambda: f"{few(3)} (at) {few(2)}",
    )[rng.integers(8)]()
    return text, [0] * len(text)


def training_rows(labelled: list[tuple[str, str, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags of the labelled windows, and of windows in which two spans are put side by side."""
    rng, windows = np.random.default_rng(2), [(t, [int(c) for c in g]) for t, g, _, _ in labelled]
    pieces = [(t[a:b], [int(c) for c in g[a:b]]) for t, g, a, b in labelled]
    plain = [t[:a] for t, g, a, _ in labelled if a > 4 and set(g[:a]) == {"0"}] or [""]
    for _ in range(len(labelled)):
        text, tags = plain[rng.integers(len(plain))][-int(rng.integers(1, 20)) :], []
        tags = [0] * len(text)
        for i in range(2):
            piece = pieces[rng.integers(len(pieces))]
            drawn = rng.random()
            piece = decoy(rng) if drawn < 0.3 else respelled(*piece, rng) if drawn < 0.65 else spaced(piece, rng)
            gap = (" ", " ", ", ", "\n", "; ", " and ")[rng.integers(6)] if i else ""
            text, tags = text + gap + piece[0], tags + [0] * len(gap) + piece[1]
        more = plain[rng.integers(len(plain))][:20]
        text, tags = text + " " + more, tags + [0] * (1 + len(more))
        windows.append((text[:WINDOW], tags[:WINDOW]))
    rows, labels = np.zeros((len(windows), WINDOW), np.int64), np.zeros((len(windows), WINDOW), np.int64)
    for i, (text, tags) in enumerate(windows):
        rows[i, : len(text)] = symbols(text)
        labels[i, : len(text)] = tags
    return rows, labels


@dataclass(frozen=True)
class Recogniser:
    weights: dict[str, np.ndarray] | None = None

    def added(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """For each whole text the network's spans that pass their checks and overlap no base span."""
        out: list[list[Span]] = [[] for _ in texts]
        if self.weights is None:
            return out
        stretches: list[tuple[int, int, int]] = []  # text, start, end
        for i, text in enumerate(texts):
            for m in TRIGGER.finditer(text):
                start, end = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
                if stretches and stretches[-1][0] == i and start <= stretches[-1][2]:
                    stretches[-1] = (i, stretches[-1][1], end)
                else:
                    stretches.append((i, start, end))
        scores = [np.zeros((e - s, TAGS), np.float32) for _, s, e in stretches]
        sums = [np.zeros((e - s, 1), np.float32) for _, s, e in stretches]
        middle = 1 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]).astype(np.float32)[:, None]
        places: list[tuple[int, int, int]] = []
        rows: list[list[int]] = []

        def flush() -> None:
            if not rows:
                return
            found, _ = emissions(np.array(rows), self.weights)
            for j, (k, start, size) in enumerate(places):
                scores[k][start : start + size] += found[:size, j] * middle[:size]
                sums[k][start : start + size] += middle[:size]
            places.clear()
            rows.clear()

        for k, (i, start, end) in enumerate(stretches):
            coded = symbols(texts[i][start:end])
            for at in range(0, max(1, len(coded) - STRIDE), STRIDE):
                part = coded[at : at + WINDOW]
                rows.append(part + [PAD] * (WINDOW - len(part)))
                places.append((k, at, len(part)))
                if len(rows) >= CHUNK:
                    flush()
        flush()
        scores = [s / np.maximum(t, 1e-6) for s, t in zip(scores, sums, strict=True)]
        paths = viterbi(scores, self.weights)
        for (i, start, _), path, score in zip(stretches, paths, scores, strict=True):
            for kind, a, b in spans_of(path):
                span = (kind, start + a, start + b)
                text, name = texts[i][span[1] : span[2]], KINDS[kind]
                if any(span[1] < e and span[2] > s for _, s, e in base[i]):
                    continue
                known = PATTERNS[name].fullmatch(text) and passes(name, text)
                if known or (
                    likely(name, text)
                    and not cuts(texts[i], span[1], span[2])
                    and margin(score, path, a, b, self.weights) >= MARGIN
                ):
                    out[i].append(span)
        return out


def margin(scores: np.ndarray, path: np.ndarray, start: int, end: int, w: dict[str, np.ndarray]) -> float:
    """Log probability of a path over the same path with the labels from start to end outside."""

    def total(tags: np.ndarray) -> float:
        first, last = max(0, start - 1), min(len(path), end + 1)
        part = tags[first:last]
        entry = float(w["start"][part[0]]) if first == 0 else 0.0
        return entry + float(scores[np.arange(first, last), part].sum()) + float(w["moves"][part[:-1], part[1:]].sum())

    without = path.copy()
    without[start:end] = 0
    return total(path) - total(without)


def spans_of(path: np.ndarray) -> list[Span]:
    """(kind, start, end) of the runs of labels."""
    out: list[Span] = []
    for at in np.flatnonzero(path).tolist():
        kind, begins = (int(path[at]) - 1) // 2, path[at] % 2 == 1
        if out and not begins and out[-1][2] == at and out[-1][0] == kind:
            out[-1] = (kind, out[-1][1], at + 1)
        else:
            out.append((kind, at, at + 1))
    return out


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Recogniser:
    windows = docs.select(F.col(text)).mapInArrow(_windows, "window string, tags string, first int, last int")
    taken = windows.distinct().orderBy(F.xxhash64("window"), "window", "first").limit(sample).collect()
    if not taken:
        return Recogniser()
    return Recogniser(train(*training_rows([tuple(r) for r in taken])))


RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def found(docs: DataFrame, model: Recogniser, text: str = "text") -> DataFrame:
    """The documents with the patterns' counts, the digest of their spans, and all spans."""

    def results(texts: pd.Series) -> pd.DataFrame:
        whole = [t or "" for t in texts]
        base = [pattern_spans(t)[0] for t in whole]
        added = model.added(whole, base)
        rows = [
            (
                *(sum(s[0] == k for s in b) for k in range(len(KINDS))),
                hashlib.sha256(listed(b).encode()).hexdigest(),
                listed(b + a),
                len(a),
            )
            for b, a in zip(base, added, strict=True)
        ]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    names = [c.split()[0] for c in RESULT.split(", ")]
    out = docs.withColumn("__found", F.pandas_udf(results, RESULT)(F.col(text)))
    return out.withColumns({n: F.col(f"__found.{n}") for n in names}).drop("__found")
