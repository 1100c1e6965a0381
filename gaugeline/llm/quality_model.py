"""Document quality by Bradley-Terry ranking.

Each document has a score w . x of its features x. Of a good and a bad document
the good one is preferred with probability 1 / (1 + exp(-(score difference))),
so w is the logistic fit, without intercept, of feature differences over
preference pairs. The cut between kept and rejected is a quantile of the scores
of all documents. Its level is the share of the corpus that is expected to be
bad: labelled rows tell the share of bad ones at each score, as steps that fall
with the score, and the scores of all documents weight these shares. Reported
scores are moved so that the cut is at ``KEEP_FROM``.

Features are shares and means of the whole text, found in one pass over its
words. Pairs come from at most ``SAMPLE_ROWS`` labelled rows, drawn by hash;
the corpus is read once for the quantile, of which ``STEPS`` counts reach the
driver, and once for the scores. No text is shuffled.

Null text is "". Rows that are labelled alike and have the same features, so
all copies of a text, count once in the fit; in the quantile each row counts,
and as copies move the level as much as the ranks they leave the cut where it
was. Without labels of both kinds nothing can be ranked and every score is
``KEEP_FROM``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from gaugeline.llm.arrays import releasing
from gaugeline.llm.labelled import labelled_sample

# Labelled rows that the fit may see.
SAMPLE_ROWS = 20_000
# Good documents that each bad one is compared with, and the other way round.
PAIRS_EACH = 8
# A document is kept from this score on.
KEEP_FROM = 0.7
# Steps between the lowest and the highest learned score at which the corpus is counted.
STEPS = 4096

_DELETE_ALL_BUT = {
    "symbol": bytes(b for b in range(256) if b not in b"#*$%&|<>"),
    "loud": bytes(b for b in range(256) if b not in b"!?"),
    "upper": bytes(b for b in range(256) if not 65 <= b <= 90),
    "digit": bytes(b for b in range(256) if not 48 <= b <= 57),
    "stop": bytes(b for b in range(256) if b not in b".,;:"),
}
FEATURES = 13


def text_features(text: str | None) -> list[float]:
    """The features of a whole text."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words) or 1
    letters = sum(map(len, words)) or 1
    share = {k: len(raw.translate(None, d)) / letters for k, d in _DELETE_ALL_BUT.items()}
    same = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    alone = sum(1 for w in words if not w.translate(None, b"#*$%&|<>!?.,;:-"))
    return [
        share["symbol"],
        share["loud"],
        share["upper"],
        share["digit"],
        share["stop"],
        same / n,
        len(set(words)) / n,
        pairs / max(1, len(words) - 1),
        alone / n,
        1 - len(set(lines)) / max(1, len(lines)),
        min(letters / n, 30.0),
        math.log1p(len(words)),
        float(len(words) < 5),
    ]


@F.pandas_udf(ArrayType(DoubleType()))
@releasing
def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([text_features(t) for t in texts])


@dataclass
class Ranking:
    """A fitted ranking: the score is ``weights . (x - means) / scales``, cut at ``cut``.

    The learned scores span ``edges``; ``bad`` is the share of bad documents below the
    first edge, up to each further one, and above the last. ``level`` of the documents
    that the cut was set for lie below it.
    """

    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    means: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    scales: np.ndarray = field(default_factory=lambda: np.ones(FEATURES))
    cut: float = 0.0
    edges: np.ndarray = field(default_factory=lambda: np.empty(0))
    bad: np.ndarray = field(default_factory=lambda: np.empty(0))
    level: float | None = None

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.means) / self.scales).clip(-8, 8) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1, ``KEEP_FROM`` at the cut."""
        moved = self.raw(x) - self.cut + math.log(KEEP_FROM / (1 - KEEP_FROM))
        return 1 / (1 + np.exp(-moved.clip(-30, 30)))


def fit_pairs(differences: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights that minimise the mean of log(1 + exp(-w . d)), by Newton steps."""
    weights = np.zeros(differences.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp((differences @ weights).clip(-30, 30)))
        slope = -(differences * p[:, None]).mean(0) + ridge * weights
        curve = (differences * (p * (1 - p))[:, None]).T @ differences / len(p)
        step = np.linalg.solve(curve + ridge * np.eye(len(weights)), slope)
        weights = weights - step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def best_cut(scores: np.ndarray, good: np.ndarray) -> float:
    """The score between two neighbours that sorts most labelled documents rightly."""
    order = np.argsort(scores, kind="stable")
    scores, good = scores[order], good[order]
    # right[k]: documents on the right side if the k lowest are rejected.
    right = np.append(0, np.cumsum(~good)) + good.sum() - np.append(0, np.cumsum(good))
    edge = np.append(True, np.append(scores[1:] > scores[:-1], True))
    right = np.where(edge, right, -1)
    best = np.flatnonzero(right == right.max())
    k = int(best[len(best) // 2])
    if k == 0:
        return float(scores[0])
    return float(scores[-1]) + 1.0 if k == len(scores) else float((scores[k - 1] + scores[k]) / 2)


def bad_shares(scores: np.ndarray, good: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The share of bad documents at the scores ``at``: the closest steps that fall with the score.

    Neighbouring scores whose shares would rise are pooled; a step lies midway between scores.
    """
    levels, place = np.unique(scores, return_inverse=True)
    pools: list[tuple[float, float, int]] = []
    for last, (bad, number) in enumerate(zip(np.bincount(place, ~good), np.bincount(place))):
        while pools and pools[-1][0] * number <= bad * pools[-1][1]:
            bad, number = bad + pools[-1][0], number + pools[-1][1]
            pools.pop()
        pools.append((bad, number, last))
    ends = np.array([last for _, _, last in pools[:-1]], int)
    shares = np.array([bad / number for bad, number, _ in pools])
    return shares[np.searchsorted((levels[ends] + levels[ends + 1]) / 2, at)]


def quantile_cut(ranking: Ranking, counts: np.ndarray) -> tuple[float, float]:
    """(cut, level): the quantile of the counted scores below which as many lie as are expected to be bad.

    ``counts`` has one number per entry of ``ranking.bad``. The cut is midway in a stretch
    without documents, and in proportion between the edges of a step with some.
    """
    edges, total = ranking.edges, int(counts.sum())
    rejected = round(float(counts @ ranking.bad))
    level, widest = rejected / total, 8 * float(np.abs(ranking.weights).sum()) + 1
    if rejected in (0, total):
        return (widest if rejected else -widest), level
    below = np.cumsum(counts)[:-1]
    tied = np.flatnonzero(below == rejected)
    if len(tied):
        return float(edges[tied[0]] + edges[tied[-1]]) / 2, level
    upper = int(np.searchsorted(below, rejected))
    if upper in (0, len(edges)):
        return float(edges[min(upper, len(edges) - 1)]), level
    part = (rejected - below[upper - 1]) / (below[upper] - below[upper - 1])
    return float(edges[upper - 1] + part * (edges[upper] - edges[upper - 1])), level


def fit_ranking(rows: list[tuple[list[float], int]], seed: int = 17) -> Ranking:
    """A ranking from features and labels of a bounded number of documents."""
    good = np.array([label == 1 for _, label in rows], bool)
    if not good.any() or good.all():
        return Ranking()
    x = np.array([f for f, _ in rows], float)
    means, scales = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = ((x - means) / scales).clip(-8, 8)
    draw = np.random.default_rng(seed)
    a, b = np.flatnonzero(good), np.flatnonzero(~good)
    first = np.concatenate([draw.choice(a, PAIRS_EACH * len(b)), np.repeat(a, PAIRS_EACH)])
    second = np.concatenate([np.repeat(b, PAIRS_EACH), draw.choice(b, PAIRS_EACH * len(a))])
    ranking = Ranking(fit_pairs(z[first] - z[second]), means, scales)
    scores = ranking.raw(x)
    ranking.cut = best_cut(scores, good)
    ranking.edges = np.linspace(scores.min(), scores.max(), STEPS + 1)
    middles = (ranking.edges[1:] + ranking.edges[:-1]) / 2
    ranking.bad = bad_shares(scores, good, np.concatenate([scores.min(keepdims=True), middles, scores.max(keepdims=True)]))
    return ranking


def count_scores(docs: DataFrame, ranking: Ranking) -> np.ndarray:
    """How many documents have a score in each step of ``ranking``."""

    @F.pandas_udf(IntegerType())
    @releasing
    def step(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([text_features(t) for t in texts], float).reshape(-1, FEATURES)
            yield pd.Series(np.searchsorted(ranking.edges, ranking.raw(x)).astype(np.int32))

    counts = np.zeros(len(ranking.bad), np.int64)
    for row in docs.select(step("text").alias("step")).groupBy("step").count().collect():
        counts[row["step"]] = row["count"]
    return counts


def learn_quality(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> Ranking:
    """A ranking learned from the labels (doc_id, quality) whose rows ``learn`` admits, cut for ``docs``."""
    sample = labelled_sample(docs, labels, "quality", learn, rows)
    drawn = (
        sample.select(features("text").alias("x"), "label")
        .distinct()
        .orderBy(F.xxhash64("x", "label"), "x", "label")
        .limit(rows)
        .collect()
    )
    ranking = fit_ranking(sorted((r["x"], r["label"]) for r in drawn))
    if len(ranking.edges):
        ranking.cut, ranking.level = quantile_cut(ranking, count_scores(docs, ranking))
    return ranking


def score_column(ranking: Ranking, text: Column) -> Column:
    """The score of ``text``; the ranking's few numbers travel with the function."""

    @F.pandas_udf(DoubleType())
    @releasing
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([text_features(t) for t in texts], float).reshape(-1, FEATURES)
            yield pd.Series(ranking.scores(x))

    return score(text)
