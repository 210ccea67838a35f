"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each document becomes a short vector of transformed statistics. Shares of a few words
say little, so a text of n words has its statistics drawn towards the training
mean, by n / (n + RELIABLE). Class means and
covariances come from sums that Spark aggregates, so training reads every
labelled row and the driver sees two small matrices. Each class covariance is
shrunk towards the pooled one and then towards its own diagonal; the score is
the posterior from Mahalanobis log-densities with cached Cholesky factors.

Null and empty texts have the statistics of a text without words and are scored
like any other. Without labelled rows of both classes every score is the share
of label 1 among them (0.5 without any). Other columns pass through; a column
that already has the score's name is replaced.
"""

from __future__ import annotations

import math
import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factprep.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATISTICS = (
    "words", "word_bytes", "word_spread", "upper", "digits", "symbols", "bars", "shouts", "stops",
    "distinct_words", "line_words", "repeated_lines", "packed",
)
#: Words at which a text's own statistics count as much as the mean.
RELIABLE = 20
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
SYMBOLS = b"#$%&*@^~<>=+/\\_{}[]`"
BARS = b"|\t"
SHOUTS = b"!?"
STOPS = b".,;:"


def document_statistics(text: bytes | None) -> list[float]:
    """Transformed statistics of a whole UTF-8 text, in the order of STATISTICS."""
    text = text or b""
    words = text.split()
    n, size = len(words), max(1, len(text))
    share = lambda those: math.sqrt((len(text) - len(text.translate(None, those))) / size)
    lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1)
    lines = text.split(b"\n")
    return [
        math.log1p(n),
        math.log1p(lengths.mean()),
        math.log1p(lengths.std()),
        share(UPPER),
        share(DIGITS),
        share(SYMBOLS),
        share(BARS),
        share(SHOUTS),
        share(STOPS),
        math.log1p(len(set(words))) / math.log(n + 2),
        math.log1p(n / len(lines)),
        math.sqrt(1 - len(set(lines)) / len(lines)),
        len(zlib.compress(text, 1)) / (size + 20),
    ]


def _statistics(texts: pd.Series) -> pd.Series:
    return pd.Series([document_statistics(t) for t in texts])


@dataclass(frozen=True)
class Discriminant:
    """Per class (0, 1): log prior, mean and inverse Cholesky factor with its log-determinant."""

    prior: tuple[float, float]
    mean: np.ndarray | None = None
    means: np.ndarray | None = None
    whitening: np.ndarray | None = None
    halves: np.ndarray | None = None

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(rows), self.prior[1])
        words = np.expm1(rows[:, :1])
        rows = self.mean + words / (words + RELIABLE) * (rows - self.mean)
        odds = np.zeros(len(rows))
        for c, sign in ((0, -1), (1, 1)):
            z = (rows - self.means[c]) @ self.whitening[c].T
            odds += sign * (math.log(self.prior[c]) - self.halves[c] - 0.5 * (z * z).sum(axis=1))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(rows: DataFrame, *, towards_pooled: float = 0.1, towards_diagonal: float = 0.05) -> Discriminant:
    """Learn from (text, __label) rows: sums over their statistics, all on Spark."""
    p = len(STATISTICS)
    x = stored(
        rows.select("__label", F.pandas_udf(_statistics, "array<double>")(F.col("text").cast("binary")).alias("x")),
        "statistics",
    )
    mean = np.array(x.agg(*[F.avg(F.col("x")[i]) for i in range(p)]).first(), float)
    weight = F.expm1(F.col("x")[0]) / (F.expm1(F.col("x")[0]) + RELIABLE)
    # Without rows there is no mean, and nothing to draw towards it.
    drawn = [(m + F.col("weight") * (F.col("x")[i] - m)).alias(f"x{i}") for i, m in enumerate(np.nan_to_num(mean).tolist())]
    x = x.withColumn("weight", weight).select("__label", *drawn)
    at = [F.col(f"x{i}") for i in range(p)]
    sums = [F.sum(a).alias(f"s{i}") for i, a in enumerate(at)]
    products = [F.sum(at[i] * at[j]).alias(f"p{i}_{j}") for i in range(p) for j in range(i, p)]
    found = {r["__label"]: r for r in x.groupBy("__label").agg(F.count("*").alias("n"), *sums, *products).collect()}
    total = sum(r["n"] for r in found.values())
    if len(found) < 2:
        share = 0.5 if not total else float(next(iter(found)))
        return Discriminant((1 - share, share))
    means, scatters, counts = np.zeros((2, p)), np.zeros((2, p, p)), np.zeros(2)
    for c, r in found.items():
        counts[c] = r["n"]
        means[c] = [r[f"s{i}"] / r["n"] for i in range(p)]
        for i in range(p):
            for j in range(i, p):
                scatters[c, i, j] = scatters[c, j, i] = r[f"p{i}_{j}"] - r["n"] * means[c, i] * means[c, j]
    pooled = scatters.sum(axis=0) / max(1, total - 2) + 1e-9 * np.eye(p)
    whitening, halves = np.zeros((2, p, p)), np.zeros(2)
    for c in (0, 1):
        own = (1 - towards_pooled) * scatters[c] / max(1, counts[c] - 1) + towards_pooled * pooled
        own = (1 - towards_diagonal) * own + towards_diagonal * np.diag(np.diag(own)) + 1e-6 * np.eye(p)
        factor = np.linalg.cholesky(own)
        whitening[c] = np.linalg.inv(factor)
        halves[c] = np.log(np.diag(factor)).sum()
    return Discriminant(tuple(counts / total), mean, means, whitening, halves)


def with_scores(docs: DataFrame, model: Discriminant, text: str = "text", score: str = "score") -> DataFrame:
    """The documents with a column for the probability of label 1."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.array([document_statistics(t) for t in texts])))

    return docs.withColumn(score, scored(F.col(text).cast("binary")))
