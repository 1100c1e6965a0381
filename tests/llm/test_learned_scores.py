"""Scores learned from labels, computed a second time in plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import quality_model, toxicity
from gaugeline.llm.char_model import restore
from gaugeline.llm.labelled import fold
from gaugeline.llm.queries import QUERIES, labels
from tests.llm import brute


def learned_labels(spark, folder: str, name: str, folds: int, held: int) -> dict[int, int]:
    """The labels that may be learned from and do not contradict each other."""
    seen = defaultdict(set)
    for row in labels(spark, folder).collect():
        if row.doc_id is not None and row[name] in (0, 1) and brute.fold(row.doc_id, folds) != held:
            seen[row.doc_id].add(row[name])
    return {i: found.pop() for i, found in seen.items() if len(found) == 1}


def sources(spark, folder: str) -> list[tuple[int, str]]:
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def plain_quality_features(text: str | None) -> list[float]:
    text = text or ""
    words = re.findall(brute.WORD, text)
    letters = sum(len(w.encode()) for w in words)
    count = lambda chars: sum(c in chars for w in words for c in w) / max(1, letters)
    lines = [line for line in text.split("\n") if re.search(brute.WORD, line)]
    neighbours = [(words[i], words[i + 1]) for i in range(len(words) - 1)]
    n = max(1, len(words))
    return [
        count("#*$%&|<>"),
        count("!?"),
        count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        count("0123456789"),
        count(".,;:"),
        sum(a == b for a, b in neighbours) / n,
        len(set(words)) / n,
        len(set(neighbours)) / max(1, len(neighbours)),
        sum(all(c in "#*$%&|<>!?.,;:-" for c in w) for w in words) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        min(30.0, max(1, letters) / n),
        math.log(1 + len(words)),
        float(len(words) < 5),
    ]


def falling_shares(scores: np.ndarray, bad: np.ndarray) -> dict[float, float]:
    """The closest shares that fall with the score, by the min-max formula over all stretches."""
    levels = sorted(set(scores.tolist()))
    number = [int((scores == s).sum()) for s in levels]
    hits = [int(bad[scores == s].sum()) for s in levels]

    def mean(a: int, b: int) -> float:
        return sum(hits[a : b + 1]) / sum(number[a : b + 1])

    last = len(levels)
    return {s: min(max(mean(a, b) for b in range(i, last)) for a in range(i + 1)) for i, s in enumerate(levels)}


@pytest.mark.parametrize("seed", range(4))
def test_shares_fall_with_the_score(seed):
    draw = np.random.default_rng(seed)
    scores = draw.integers(0, 25, 60).astype(float)
    good = draw.random(60) < scores / 25
    expected = falling_shares(scores, ~good)
    found = quality_model.bad_shares(scores, good, np.array(list(expected)))
    np.testing.assert_allclose(found, list(expected.values()))


@pytest.mark.parametrize("seed", range(4))
def test_cut_is_a_quantile(seed):
    """As many documents lie below it as are expected to be bad, whatever share of the corpus they are."""
    draw = np.random.default_rng(seed)
    x = np.concatenate([draw.normal(0, 1, (300, 1)), draw.normal(2, 1, (300, 1))])
    pad = np.zeros((600, quality_model.FEATURES - 1))
    rows = [(list(f), int(i >= 300)) for i, f in enumerate(np.hstack([x, pad]))]
    ranking = quality_model.fit_ranking(rows)
    corpus = np.hstack([draw.normal(1.5, 1.5, (20_000, 1)), np.zeros((20_000, quality_model.FEATURES - 1))])
    raw = ranking.raw(corpus)
    counts = np.bincount(np.searchsorted(ranking.edges, raw), minlength=len(ranking.bad))
    cut, level = quality_model.quantile_cut(ranking, counts)
    sample = ranking.raw(np.array([f for f, _ in rows]))
    wanted = quality_model.bad_shares(sample, np.arange(600) >= 300, raw).mean()
    assert abs(level - wanted) < 0.002 and abs((raw < cut).mean() - level) < 0.002
    # All alike: kept or rejected as a whole, and never a crash.
    for place in (0, len(counts) // 2, len(counts) - 1):
        alone = np.zeros(len(counts), int)
        alone[place] = 1000
        assert math.isfinite(quality_model.quantile_cut(ranking, alone)[0])


def test_quality_scores(spark, tiny_dir, table_dir):
    for folder in (tiny_dir, table_dir):
        docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
        known = learned_labels(spark, folder, "quality", 4, 2)
        texts = sources(spark, folder)
        for _, text in texts:
            np.testing.assert_allclose(quality_model.text_features(text), plain_quality_features(text), rtol=1e-12)
        sample = {(tuple(plain_quality_features(t)), known[i]) for i, t in texts if i in known}
        ranking = quality_model.learn_quality(docs, labels(spark, folder), fold(4) != 2)
        x = np.array([f for f, _ in sorted(sample)])
        np.testing.assert_allclose(ranking.means, x.mean(0), rtol=1e-9, atol=1e-12)
        np.testing.assert_allclose(ranking.scales, np.maximum(x.std(0), 1e-6), rtol=1e-6)

        def raw(features) -> float:
            z = [(v - m) / s for v, m, s in zip(features, ranking.means, ranking.scales)]
            return sum(w * min(8.0, max(-8.0, v)) for w, v in zip(ranking.weights, z))

        scores = {i: [] for i, _ in texts}
        for i, text in texts:
            odds = raw(plain_quality_features(text)) - ranking.cut + math.log(0.7 / 0.3)
            scores[i].append(1 / (1 + math.exp(-min(30.0, max(-30.0, odds)))))
        found = defaultdict(list)
        for row in QUERIES["op9_quality_classifier"](spark, folder).collect():
            found[row.doc_id].append(row.score)
        assert found.keys() == scores.keys()
        for i in scores:
            np.testing.assert_allclose(sorted(found[i]), sorted(scores[i]), rtol=1e-6, atol=1e-9)
        everything = np.array([raw(plain_quality_features(t)) for _, t in texts])
        # Documents with equal scores, or in one step, are not told apart.
        step = ranking.edges[1] - ranking.edges[0]
        assert (everything < ranking.cut - step).mean() <= ranking.level <= (everything < ranking.cut + step).mean()


def test_copies_do_not_move_the_quality_cut(spark, sf_dir):
    """One bad and one good text on a third of all rows each, labelled or not."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    marks = labels(spark, sf_dir).select("doc_id", "quality")
    plain = quality_model.learn_quality(docs, marks, F.lit(True))
    rows = docs.count()
    for quality in (0, 1):
        model = docs.join(marks.filter(F.col("quality") == quality), "doc_id").orderBy("doc_id").first()
        copies = spark.range(10**9, 10**9 + rows // 2).select(F.col("id").alias("doc_id"), F.lit(model.text).alias("text"))
        more = docs.unionByName(copies)
        for known in (marks, marks.unionByName(copies.select("doc_id", F.lit(quality).cast("int").alias("quality")))):
            ranking = quality_model.learn_quality(more, known, F.lit(True))
            assert abs(ranking.level - (plain.level * rows + (rows // 2 if quality == 0 else 0)) / (rows + rows // 2)) < 0.01

            def decided(r: quality_model.Ranking) -> dict[int, bool]:
                score = quality_model.score_column(r, F.col("text"))
                return {d: k for d, k in docs.select("doc_id", score >= quality_model.KEEP_FROM).collect()}

            before, after = decided(plain), decided(ranking)
            assert sum(before[i] != after[i] for i in before) <= len(before) // 500


def test_toxicity_scores(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    known = learned_labels(spark, sf_dir, "toxic", 3, 1)
    texts = sources(spark, sf_dir)
    chars = toxicity.learn_chars(docs)
    restored = {t: restore(t, chars) for _, t in texts}

    def signs(text: str) -> set[str]:
        words = {w.strip(toxicity._EDGES) for w in restored[text].split()}
        found = {("whole", w) for w in words} | {("start", w[:4]) for w in words if len(w) >= 4}
        return found | {(k, p) for w in words if len(w) >= 5 for k, p in (("start", w[:5]), ("end", w[-5:]))}

    sample = {(t, known[i]) for i, t in texts if i in known}
    counts = (Counter(), Counter())
    for text, label in sample:
        counts[label].update(signs(text))
    toxic = sum(label for _, label in sample)
    clean = len(sample) - toxic
    weights = {}
    for sign, a in counts[1].items():
        b = counts[0][sign]
        cells = ((a, toxic, a + b), (b, clean, a + b), (toxic - a, toxic, len(sample) - a - b), (clean - b, clean, len(sample) - a - b))
        g2 = 2 * sum(n * math.log(n * len(sample) / (side * both)) for n, side, both in cells if n)
        if a >= 3 and a * clean > 3 * b * toxic and g2 >= toxicity.LEAST_G2:
            weights[sign] = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
    assert 10 < len(weights) < toxicity.MOST_FEATURES

    def raw(text: str) -> float:
        return sum(sorted((weights[s] for s in signs(text) if s in weights), reverse=True)[:8])

    learned = [(raw(t), label) for t, label in sample]
    steps = sorted({round(r, 9) for r, _ in learned})
    cuts = [((a + b) / 2, b - a) for a, b in zip(steps, steps[1:]) if a + b > 0]
    right = [sum((r > c) == (label == 1) for r, label in learned) for c, _ in cuts]
    cut = max((n, gap, c) for n, (c, gap) in zip(right, cuts))[2]
    expected = {i: 1 / (1 + math.exp(-min(30.0, max(-30.0, raw(t) - cut + math.log(0.7 / 0.3))))) for i, t in texts}
    for row in QUERIES["op4_toxicity"](spark, sf_dir).collect():
        assert math.isclose(row.score, expected[row.doc_id], rel_tol=1e-6, abs_tol=1e-9)
