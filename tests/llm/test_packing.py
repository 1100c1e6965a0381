"""Packing: every id once, next to nothing padded, neighbours as BM25 ranks them."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gaugeline.llm import packing
from gaugeline.llm.packing import pack_documents, pack_shard
from gaugeline.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.test_queries import ordered


def plain_scores(docs: list[list[int]], seed: int) -> list[float]:
    """BM25 of every document for the heaviest terms of ``seed``, term by term."""
    found = Counter(t for doc in docs for t in set(doc))
    mean = sum(map(len, docs)) / len(docs)

    def weight(term: int, doc: list[int]) -> float:
        times = doc.count(term)
        rarity = math.log(1 + (len(docs) - found[term] + 0.5) / (found[term] + 0.5))
        return rarity * times * 2.2 / (times + 1.2 * (0.25 + 0.75 * len(doc) / mean))

    asked = sorted(set(docs[seed]), key=lambda t: (-weight(t, docs[seed]), t))[: packing.QUERY_TERMS]
    return [sum(weight(t, doc) for t in asked) for doc in docs]


def random_shard(seed: int) -> list[list[int]]:
    rng = random.Random(seed)
    topics = [[rng.randrange(2000) for _ in range(60)] for _ in range(4)]
    docs = []
    for _ in range(rng.choice([1, 2, 30, 80])):
        size = rng.choice([0, 1, 20, 70, 300])
        docs.append([*rng.choices(rng.choice(topics), k=size), 1])
    return docs + [list(docs[0])]


@pytest.mark.parametrize("seed", range(12))
def test_scores(seed):
    docs = random_shard(seed)
    index = packing.ShardIndex(np.concatenate(docs), np.array([len(d) for d in docs]))
    for doc in range(0, len(docs), 7):
        # Term for term alike; only ties among the heaviest terms may be asked differently.
        assert index.scores(doc) == pytest.approx(plain_scores(docs, doc), abs=1e-9)


def plain_packing(docs: list[list[int]], window: int) -> list[list[int]]:
    """The documents of each sequence, in order, by the greedy rule of the module."""
    unused, sequences, rest = list(range(len(docs))), [], None
    while unused or rest:
        doc, size = rest or (unused.pop(0), None)
        size = len(docs[doc]) if size is None else size
        rest = None
        while size >= window:
            sequences.append([doc])
            size -= window
        if not size:
            continue
        sequences.append([doc])
        room = window - size
        scores = plain_scores(docs, doc)
        queue = sorted(unused, key=lambda d: (-round(scores[d], 9), d))
        for other in queue:
            unused.remove(other)
            sequences[-1].append(other)
            if len(docs[other]) > room:
                rest = other, len(docs[other]) - room
            room -= len(docs[other])
            if room <= 0:
                break
    return sequences


@pytest.mark.parametrize("seed", range(12))
def test_greedy_order(seed):
    docs = random_shard(seed)
    counts = np.array([len(d) for d in docs])
    found = defaultdict(list)
    for doc, _, _, sequence, _ in pack_shard(np.concatenate(docs), counts, 128):
        found[sequence].append(doc)
    expected = plain_packing(docs, 128)
    full = [found[s] for s in range(len(found))][: len(expected) - 1]
    assert full == expected[: len(expected) - 1]
    tail = [doc for s in range(len(expected) - 1, len(found)) for doc in found[s]]
    assert list(dict.fromkeys(tail)) == expected[-1]


def check_pieces(rows, documents: list[tuple], window: int) -> None:
    """``rows`` of (doc_id, start, length, crc, doc_tokens, sequence_id, offset) hold every id once."""
    tokens = Counter()
    for _, ids in documents:
        tokens[len(ids)] += 1
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for doc_id, start, length, crc, size, sequence, offset in rows:
        assert length > 0
        sequences[sequence].append((offset, length))
        pieces[doc_id, size].append((start, length, crc))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0  # so nothing is padded
    wanted = defaultdict(list)
    for doc_id, ids in documents:
        wanted[doc_id, len(ids)].append(np.array(ids, "<u4"))
    assert set(pieces) == set(wanted)
    for key, found in pieces.items():
        assert sum(length for _, length, _ in found) == key[1] * len(wanted[key])
        left = {start: Counter() for start, _, _ in found}
        for start, length, crc in found:
            left[start][length, crc] += 1
            assert any(zlib.crc32(ids[start : start + length].tobytes()) == crc for ids in wanted[key])
        if len(wanted[key]) == 1:
            at = 0
            for start, length, _ in sorted(found):
                assert start == at
                at += length


@pytest.mark.parametrize("name", ["table_dir", "tiny_dir"])
def test_query(spark, request, name, tokenizer):
    folder = request.getfixturevalue(name)
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    documents = [(i, [*brute.encoded(tokenizer, t), 1]) for i, t in docs]
    rows = QUERIES["op12_packing"](spark, folder).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
    check_pieces([tuple(r) for r in rows.collect()], documents, 2048)


def test_small_shards_and_tasks(spark, hard, tokenizer, monkeypatch):
    """Any cutting of the order keeps every id, and sequence ids stay unique."""
    monkeypatch.setattr(packing, "SHARD_TOKENS", 500)
    monkeypatch.setattr(packing, "TASK_TOKENS", 5_000)
    documents = [(r.doc_id, [*brute.encoded(tokenizer, r.text), 1]) for r in hard.collect()]
    found = pack_documents(hard, tokenizer, 64, 1)
    rows = [(r.doc_id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in found.collect()]
    check_pieces(rows, documents, 64)


def test_neighbours_share_more_than_chance(spark, sf_dir):
    """Documents of one sequence are in one language far more often than documents drawn at random."""
    found = QUERIES["op12_packing"](spark, sf_dir).select("doc_id", "sequence_id")
    langs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    held = defaultdict(set)
    lang = {r.doc_id: r.lang for r in langs.collect()}
    for row in found.collect():
        held[row.sequence_id].add(row.doc_id)
    pairs = [(a, b) for docs in held.values() for a in docs for b in docs if a < b]
    shares = Counter(lang.values())
    chance = sum((n / len(lang)) ** 2 for n in shares.values())
    assert sum(lang[a] == lang[b] for a, b in pairs) / len(pairs) > 2 * chance


def test_window_must_be_a_power_of_two(spark, hard, tokenizer):
    with pytest.raises(ValueError):
        pack_documents(hard, tokenizer, 100, 1)


def test_equal_rows_are_documents_of_their_own(spark, tokenizer):
    rows = [(7, "the same text")] * 40 + [(None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pack_documents(docs, tokenizer, 2048, 1).collect()
    assert ordered((r.doc_id, r.length) for r in found if r.doc_id is None) == [(None, 1)] * 3
    assert sum(r.length for r in found) == 40 * found[0].doc_tokens + 3 if found[0].doc_id else True
