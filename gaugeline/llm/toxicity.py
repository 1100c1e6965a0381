"""Toxicity scored on text whose disguises are undone first.

Noisy channel: a character trigram model is counted over all documents; words
written with signs for letters, with spaced letters or with letters repeated
are character lattices, and Viterbi decoding gives their likeliest reading
(``char_model``). The restored text is then scored by the words it has:
whole words, their first four and five and last five letters, so that forms of
a word not seen before still count. What marks toxicity is learned from at
most ``SAMPLE_ROWS`` labelled rows: features that are significantly more
frequent in toxic documents, weighted by their log odds. A score moves so
that the cut that sorts most learned documents rightly is at ``TOXIC_FROM``.

Null text is "", which has no features and the lowest score. Without labels of
both kinds no feature is learned, and every score is below the cut.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from gaugeline.llm.arrays import releasing, text_chunks
from gaugeline.llm.char_model import SYMBOLS, CharModel, count_trigrams, restore
from gaugeline.llm.labelled import bounded, labelled_sample
from gaugeline.operators.stage import stage

# Labelled rows that the fit may see.
SAMPLE_ROWS = 20_000
# A document counts as toxic from this score on.
TOXIC_FROM = 0.7
# Least significance (G squared) of a feature, and the most features kept.
LEAST_G2 = 24.0
MOST_FEATURES = 20_000

_EDGES = ".,;:!?\"'()[]{}<>|#*%$&@+-_=/\\~`^…«»¡¿“”‘’—–"


def text_features(restored: str) -> set[str]:
    """Words, and beginnings and ends of words, of a restored text."""
    words = {w.strip(_EDGES) for w in set(restored.split())}
    found = {f"={w}" for w in words}
    for w in words:
        if len(w) > 4:
            found |= {f"{w[:4]}-", f"{w[:5]}-", f"-{w[-5:]}"}
        elif len(w) == 4:
            found.add(f"{w}-")
    return found


@dataclass
class ToxicModel:
    """The character model, the weights of features, and the cut."""

    chars: CharModel
    weights: dict[str, float] = field(default_factory=dict)
    cut: float = 1.0

    def __post_init__(self) -> None:
        self.parts: dict[str, dict[str, float]] = {"=": {}, "4": {}, "5": {}, "-": {}}
        for feature, weight in self.weights.items():
            if feature.startswith("="):
                self.parts["="][feature[1:]] = weight
            elif feature.startswith("-"):
                self.parts["-"][feature[1:]] = weight
            else:
                self.parts[str(len(feature) - 1)][feature[:-1]] = weight

    def raw(self, text: str | None) -> float:
        """The weight of the strongest signs of toxicity in the restored text."""
        words = {w.strip(_EDGES) for w in set(restore(text, self.chars).split())}
        found = [self.parts["="][w] for w in words & self.parts["="].keys()]
        for part, size in (("4", 4), ("5", 5)):
            if self.parts[part]:
                starts = {w[:size] for w in words if len(w) >= size}
                found += [self.parts[part][s] for s in starts & self.parts[part].keys()]
        if self.parts["-"]:
            ends = {w[-5:] for w in words if len(w) > 4}
            found += [self.parts["-"][e] for e in ends & self.parts["-"].keys()]
        return sum(sorted(found, reverse=True)[:8])

    def score(self, text: str | None) -> float:
        """Between 0 and 1, ``TOXIC_FROM`` at the cut."""
        moved = self.raw(text) - self.cut + math.log(TOXIC_FROM / (1 - TOXIC_FROM))
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, moved))))


def learn_chars(docs: DataFrame) -> CharModel:
    """The character model of all texts; at most 28**3 counts reach the driver."""
    counts = count_trigrams(docs).filter(F.col("code") < SYMBOLS**3)
    return CharModel({row["code"]: row["times"] for row in counts.collect()})


def _significance(a: np.ndarray, b: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """G squared of features in ``a`` of the toxic and ``b`` of the clean documents."""

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12))

    share = (a + b) / (toxic + clean)
    return 2 * (
        part(a, toxic * share)
        + part(toxic - a, toxic * (1 - share))
        + part(b, clean * share)
        + part(clean - b, clean * (1 - share))
    )


def learn_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> ToxicModel:
    """A model from the labels (doc_id, toxic) whose rows ``learn`` admits.

    The sample is restored and counted in tasks; each sends a feature once. At
    most ``MOST_FEATURES`` of the significant ones reach the driver.
    """
    chars = learn_chars(docs)
    drawn = labelled_sample(docs, labels, "toxic", learn, rows)
    # Copies of a text count once: their words would all look like signs of its label.
    sample = bounded(stage(drawn.dropDuplicates(["text", "label"]), "toxic-sample"), rows)
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return ToxicModel(chars)

    @releasing
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(texts, batch.column("label").to_pylist()):
                seen[label].update(text_features(restore(text, chars)))
            names = sorted(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([s[n] for n in names], pa.int64()) for s in seen)],
                ["feature", "clean", "toxic"],
            )

    counted = (
        sample.select("text", "label")
        .mapInArrow(count, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter((F.col("toxic") >= 3) & (F.col("toxic") * clean > 3 * F.col("clean") * toxic))
        .orderBy(F.col("toxic").desc(), "clean", "feature")
        .limit(5 * MOST_FEATURES)
        .toPandas()
    )
    a, b = counted["toxic"].to_numpy(float), counted["clean"].to_numpy(float)
    significance = _significance(a, b, toxic, clean)
    weights = np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (clean + 1))
    kept = np.flatnonzero(significance >= LEAST_G2)
    kept = kept[np.argsort(-significance[kept], kind="stable")][:MOST_FEATURES]
    names = counted["feature"].tolist()
    model = ToxicModel(chars, {names[i]: float(weights[i]) for i in kept})
    raw = sample.select("label", raw_column(model, F.col("text")).alias("raw")).toPandas()
    model.cut = toxic_cut(raw["raw"].to_numpy(float), raw["label"].to_numpy() == 1)
    return model


def toxic_cut(raw: np.ndarray, toxic: np.ndarray) -> float:
    """The middle between two neighbouring scores that sorts most documents rightly, above 0.

    Of several such gaps between scores it is the widest.
    """
    levels = np.unique(raw)
    cuts, gaps = (levels[:-1] + levels[1:]) / 2, np.diff(levels)
    cuts, gaps = cuts[cuts > 0], gaps[cuts > 0]
    if not len(cuts):
        return 1.0
    clean = np.sort(raw[~toxic])
    bad = np.sort(raw[toxic])
    right = np.searchsorted(clean, cuts) + len(bad) - np.searchsorted(bad, cuts)
    best = np.flatnonzero(right == right.max())
    return float(cuts[best[np.argmax(gaps[best])]])


def raw_column(model: ToxicModel, text: Column) -> Column:
    @F.pandas_udf(DoubleType())
    @releasing
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.raw(t) for t in texts], dtype=float)

    return raw(text)


def score_column(model: ToxicModel, text: Column) -> Column:
    """The score of ``text``; the model (some MB at most) travels with the function."""

    @F.pandas_udf(DoubleType())
    @releasing
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype=float)

    return score(text)
