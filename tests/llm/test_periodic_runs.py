"""Runs of words against a search period by period."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from gaugeline.llm import periodic_runs
from gaugeline.llm.periodic_runs import Grammar, find_runs, numbered_words, text_runs
from gaugeline.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.test_queries import ordered


def expected(text: str | None) -> tuple:
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    found = brute.runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return len(words), found, " ".join(w for i, w in enumerate(words) if i not in gone)


def random_texts(rng: random.Random) -> list[str]:
    texts = []
    for _ in range(rng.randint(1, 12)):
        n = rng.choice([0, 1, 11, 12, 13, 40, 100, 200])
        words = [f"w{rng.randrange(rng.choice([1, 2, 3, 5, 30]))}" for _ in range(n)]
        if n and rng.random() < 0.6:
            start = rng.randrange(n)
            period = 1 + rng.randrange(max(1, (n - start) // 2))
            words = [words[i] if i < start else words[start + (i - start) % period] for i in range(n)]
        if n and rng.random() < 0.3:
            words[rng.randrange(n)] = "other"
        texts.append(rng.choice([" ", "\n", " \t"]).join(words))
    return texts + rng.sample(texts, k=len(texts) // 2)


@pytest.mark.parametrize("seed", range(150))
def test_runs_of_batches(seed):
    texts = random_texts(random.Random(seed))
    assert text_runs(texts) == [expected(t) for t in texts]


@pytest.mark.parametrize("period", [1, 2, 3, 5, 7, 12])
def test_shortest_runs(period):
    """One word less than max(12, 2 q) is none."""
    least = max(12, 2 * period)
    words = [f"w{i % period}" for i in range(least)]
    assert text_runs([" ".join(words)])[0][1] == [(0, least, period)]
    assert text_runs([" ".join(words[:-1])])[0][1] == []


def test_fibonacci_words():
    """Strings with as many runs as there can be."""
    a, b = "x", "xy"
    while len(b) < 1500:
        a, b = b, b + a
    assert text_runs([" ".join(b)]) == [expected(" ".join(b))]


def test_grammar_spells_the_text():
    """Every nonterminal stands for equal words at all its places, and pairs repeat."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(300)) for _ in range(5)]
    symbols, first = numbered_words([t.encode() for t in texts])
    grammar = Grammar(symbols, int(symbols.max()) + 2 - len(first))
    assert len(grammar.size)
    assert np.bincount(grammar.names).min() >= 2
    for name in range(len(grammar.size)):
        places = grammar.places[grammar.names == name].tolist()
        assert len({tuple(symbols[p : p + grammar.size[name]]) for p in places}) == 1
    # What is left covers the text without gaps.
    assert grammar.at[0] == 0 and (np.diff(grammar.at) > 0).all()


def test_long_stretches_beyond_the_steps(monkeypatch):
    monkeypatch.setattr(periodic_runs, "_STEP_LEVELS", 2)
    monkeypatch.setattr(periodic_runs, "_STEP_BYTES", 0)
    texts = [" ".join(["a", "b", "c"] * 200), " ".join(map(str, range(500)))]
    assert text_runs(texts) == [expected(t) for t in texts]


def test_very_long_text():
    """Half a million words of period 1, and as many different ones."""
    started = time.monotonic()
    [(n, found, kept)] = text_runs(["a " * 500_000])
    assert (n, found, kept) == (500_000, [(0, 500_000, 1)], "a")
    assert text_runs([" ".join(map(str, range(500_000)))])[0][1] == []
    assert time.monotonic() - started < 60


def test_operator_keeps_rows_and_columns(spark, hard):
    wide = hard.selectExpr("*", "1 AS n_words", "2 AS runs", "'x' AS collapsed")
    found = find_runs(wide, "found")
    assert found.columns == [*wide.columns, "found"]
    rows = [(r.found.n_words, [tuple(x) for x in r.found.runs], r.found.collapsed) for r in found.collect()]
    assert ordered((n, str(r), c) for n, r, c in rows) == ordered(
        (n, str(r), c) for n, r, c in (expected(row.text) for row in hard.collect())
    )


def test_nothing_is_shuffled(spark, tiny_dir):
    plan = QUERIES["op11_periodic_runs"](spark, tiny_dir)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan


@pytest.mark.parametrize("name", ["table_dir", "tiny_dir"])
def test_query(spark, request, name):
    folder = request.getfixturevalue(name)
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_periodic_runs"](spark, folder).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    )
    assert ordered(map(tuple, found.collect())) == ordered((i, *brute.periodic(i, t)) for i, t in docs)
