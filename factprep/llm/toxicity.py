"""Toxicity by maximum-scoring segments.

Token scores are log-odds between toxic and other training texts with an
informative Dirichlet prior (FLAT for every token, and PRIOR spread by the tokens' share in
all training texts). A token counts once in a text, so that no single text makes a
token toxic by repeating it. Tokens whose log-odds stand out by Z_LEAST standard errors form
the lexicon, all others share one pooled score, lowered by DRIFT so that segments
stay local. A linear scan finds all maximal-scoring segments of a text, that is,
its toxic passages. Their scores follow an extreme-value law: with the scale from
Karlin and Altschul's equation and the constant fitted on non-toxic training
texts, a segment's evidence is scale * score - ln(constant * tokens). The evidence
of a text's significant segments is summed, and a logistic curve fitted on the
training rows turns it into the score.

Texts are lower-cased runs of letters and digits, whole and of any length. Null and
empty texts have no evidence and get the curve's value there. Without labelled
rows of both classes the score is the share of label 1 (0.5 without any).
Repeated rows score alike; other columns pass through, one named like the score
is replaced.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factprep.llm.common import stored, word_tokens

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRIOR, FLAT = 500.0, 0.5
Z_LEAST = 3.0
DRIFT = 0.25
COUNTED = 300_000
BIN = 0.25
#: Quantile of non-toxic texts' best segments at which the extreme-value law is fitted.
TAIL = 0.95


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter[str], Counter[str]] = (Counter(), Counter())

    def flush() -> Iterator[pa.RecordBatch]:
        words = list(counts[0].keys() | counts[1].keys())
        if words:
            arrays = [pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in counts)]
            yield pa.RecordBatch.from_arrays(arrays, names=["token", "n0", "n1"])
            counts[0].clear()
            counts[1].clear()

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[label].update(set(word_tokens(text or "")))
            if len(counts[0]) + len(counts[1]) > COUNTED:
                yield from flush()
    yield from flush()


def scan(hits: list[tuple[int, float]], step: float) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, first token, past the last) of a text in linear time.

    ``hits`` are the tokens with positive scores, in order; every other one scores ``step`` < 0.
    """
    stack: list[tuple[int, int, float, float]] = []  # first, past, total before, total after
    best: list[int] = []  # for each open segment, the nearest earlier one that starts lower
    total, last = 0.0, 0
    for at, value in hits:
        before = total + step * (at - last)
        total, last = before + value, at + 1
        first, low, high = at, before, total
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = best[j]
            if j < 0 or stack[j][3] >= high:
                break
            first, low = stack[j][0], stack[j][2]
            del stack[j:], best[j:]
        stack.append((first, at + 1, low, high))
        best.append(j)
    return [(high - low, first, past) for first, past, low, high in stack]


@dataclass(frozen=True)
class Toxicity:
    lexicon: dict[str, float]
    step: float = -1.0
    scale: float = 1.0
    constant: float = 1.0
    intercept: float = 0.0
    slope: float = 0.0

    def segments(self, words: list[str]) -> list[tuple[float, int, int]]:
        get = self.lexicon.get
        return scan([(i, s) for i, w in enumerate(words) if (s := get(w))], self.step)

    def passages(self, text: str | None) -> list[tuple[float, int, int]]:
        """(evidence, first token, past the last) of the significant segments."""
        words = word_tokens(text or "")
        floor = math.log(self.constant * max(1, len(words)))
        return [(e, a, b) for s, a, b in self.segments(words) if (e := self.scale * s - floor) > 0]

    def evidence(self, text: str | None) -> float:
        return sum(p[0] for p in self.passages(text))

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * np.log1p(evidence), -500, 500)))


def log_odds(rows: DataFrame) -> tuple[dict[str, float], float, float, dict[str, int], int]:
    """Lexicon, the others' pooled log-odds, the others' share in non-toxic text, and there the lexicon's counts and all."""
    counts = stored(
        rows.mapInArrow(_count, "token string, n0 long, n1 long")
        .groupBy("token")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")),
        "tokens",
    )
    totals = counts.agg(F.sum("n0"), F.sum("n1")).first()
    all0, all1 = (float(t or 0) for t in totals)
    if not all0 + all1:
        return {}, 0.0, 1.0, {}, 0
    prior = F.lit(FLAT) + F.lit(PRIOR) * (F.col("n0") + F.col("n1")) / F.lit(all0 + all1)
    mass = PRIOR + FLAT * counts.count()
    odds = lambda n, total: F.log((n + prior) / (F.lit(total + mass) - n - prior))
    weighed = (
        counts.withColumn("odds", odds(F.col("n1"), all1) - odds(F.col("n0"), all0))
        .withColumn("z", F.col("odds") / F.sqrt(1 / (F.col("n1") + prior) + 1 / (F.col("n0") + prior)))
        .filter((F.col("z") >= Z_LEAST) & (F.col("odds") > 0))
        # No more tokens than the bounded sample of labelled texts holds.
        .orderBy(F.desc("z"), "token")
        .collect()
    )
    rest0 = all0 - sum(r.n0 for r in weighed)
    rest1 = all1 - sum(r.n1 for r in weighed)
    pooled = math.log((rest1 + 1) / (all1 + 2)) - math.log((rest0 + 1) / (all0 + 2))
    return {r.token: r.odds for r in weighed}, pooled, rest0 / max(1, all0), {r.token: r.n0 for r in weighed}, int(all0)


def karlin_scale(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(scale * score)) = 1; scores must be negative on average."""
    value = lambda x: float((shares * np.exp(np.clip(x * scores, -700, 700))).sum())
    high = 1e-3
    while value(high) < 1 and high < 64:
        high *= 2
    low = 0.0 if high <= 1e-3 else high / 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 1 else (low, middle)
    return max(high, 1e-3)


def _binned(rows: DataFrame, value: Callable[[str | None], float]) -> list[tuple[int, int, int]]:
    """(label, bin, texts) of a value that is computed from each text."""

    @F.pandas_udf("double")
    def values(texts: pd.Series) -> pd.Series:
        return pd.Series([value(t) for t in texts], dtype="float64")

    binned = F.floor(values(F.col("text")) / BIN).alias("bin")
    return [(r["__label"], r["bin"], r["n"]) for r in rows.groupBy("__label", binned).agg(F.count("*").alias("n")).collect()]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    design = np.stack([np.ones_like(x), x], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 1e-2 * w
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(rows: DataFrame) -> Toxicity:
    """Learn from (text, __label) rows; every count and curve is over all of them."""
    lexicon, pooled, share, seen, all0 = log_odds(rows)
    sizes = dict(rows.groupBy("__label").count().collect())
    if len(sizes) < 2:
        rate = float(next(iter(sizes), 0.5))
        return Toxicity({}, intercept=-40.0 if rate == 0 else 40.0 if rate == 1 else 0.0)
    step = min(pooled, 0.0) - DRIFT
    scores = np.array([*lexicon.values(), step])
    shares = np.array([*((seen[w] + 0.5) / (all0 + 1) for w in lexicon), share])
    scale = karlin_scale(scores, shares / shares.sum())
    bare = Toxicity(lexicon, step, scale, 1.0)

    def loudest(text: str | None) -> float:
        """The extreme-value variable of the best segment, counted from -ln(tokens)."""
        words = word_tokens(text or "")
        top = max((s for s, _, _ in bare.segments(words)), default=0.0)
        return max(0.0, scale * top - math.log(max(1, len(words))) + 64)

    # ln(constant) is Gumbel's location, taken from the tail that the calibration is about.
    clean = sorted((b, n) for label, b, n in _binned(rows, loudest) if label == 0)
    least, at = TAIL * sum(n for _, n in clean), 0
    for b, n in clean:
        at += n
        if at >= least:
            location = (b + 0.5) * BIN - 64 + math.log(-math.log(TAIL))
            break
    calibrated = Toxicity(lexicon, step, scale, max(math.exp(location), 1e-3))
    bins = _binned(rows, calibrated.evidence)
    x = np.log1p(np.array([(b + 0.5) * BIN if b else 0.0 for _, b, _ in bins]))
    intercept, slope = logistic(x, np.array([label for label, _, _ in bins], float), np.array([n for *_, n in bins], float))
    return Toxicity(lexicon, step, scale, calibrated.constant, intercept, slope)


def with_scores(docs: DataFrame, model: Toxicity, text: str = "text", score: str = "score") -> DataFrame:
    @F.pandas_udf("double")
    def probabilities(texts: pd.Series) -> pd.Series:
        return pd.Series(model.probability(np.array([model.evidence(t) for t in texts], float)))

    return docs.withColumn(score, probabilities(F.col(text)))


def with_passages(docs: DataFrame, model: Toxicity, text: str = "text", name: str = "passages") -> DataFrame:
    """The documents with their toxic passages: evidence, first token and number of tokens."""
    names = ("evidence", "start", "tokens")

    @F.pandas_udf("array<struct<evidence: double, start: int, tokens: int>>")
    def passages(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [[dict(zip(names, (e, a, b - a), strict=True)) for e, a, b in model.passages(t)] for t in texts], dtype=object
        )

    return docs.withColumn(name, passages(F.col(text)))
