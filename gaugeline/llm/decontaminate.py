"""Benchmark passages in documents, found by an Aho-Corasick automaton.

Texts and benchmark items are normalised alike: A-Z become lower case, every
other ASCII character that is no digit or letter separates words, and words
stand between single spaces. A window is 13 consecutive words of an item, or
all words of a shorter one. One automaton over all windows reads each
normalised text once; where a window occurs, offsets lead back to the
original's code points.

The windows are written to the shared folder in files of at most
``SHARD_CHARS`` characters, dealt by hash. Each worker builds its automaton
from them; a benchmark too large for one has several, which read a batch of
texts in turn, so a worker holds one at a time whatever the benchmark's size.

Null text and null items have no words. Items that share a window are all
reported; item ids may be of any type and are given as strings. An item without
an id marks words but is not listed.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.arrays import releasing
from gaugeline.llm.shared_files import mapped_file, write_file
from gaugeline.operators.stage import stage, stage_path

WINDOW_WORDS = 13
# Characters of windows in one automaton, which takes some 50 bytes for each.
SHARD_CHARS = 2_000_000

# Code points scanned before the next automaton takes its turn.
CHUNK_CHARS = 8_000_000

_RESULT = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"

_KEPT = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isdigit() or 97 <= b <= 122 else 32 for b in range(256)
)


def normal_words(raw: bytes) -> list[bytes]:
    """The words of a UTF-8 text."""
    return raw.translate(_KEPT).split()


def item_windows(text: str | None, size: int) -> list[str]:
    """The windows of an item, each between spaces, its bytes as characters."""
    words = normal_words((text or "").encode())
    count = max(1, len(words) - size + 1) if words else 0
    return [f" {b' '.join(words[i : i + size]).decode('latin-1')} " for i in range(count)]


def write_windows(benchmark: DataFrame, size: int = WINDOW_WORDS, shard_chars: int = SHARD_CHARS) -> list[str]:
    """Write the distinct windows of ``benchmark`` (item_id, text); the URIs of their files.

    The list has one entry per ``shard_chars`` characters of windows.
    """
    spark = benchmark.sparkSession
    folder = stage_path(spark, "windows")
    cut = F.udf(lambda text: item_windows(text, size), "array<string>")
    windows = stage(
        benchmark.select(F.col("item_id").cast("string").alias("item"), F.explode(cut("text")).alias("window"))
        .distinct()
        .groupBy("window")
        .agg(F.sort_array(F.collect_list("item")).alias("items")),
        "windows",
    )
    chars = windows.agg(F.sum(F.length("window"))).first()[0]
    if not chars:
        return []
    shards = -(-chars // shard_chars)

    def write(frame: pd.DataFrame) -> pd.DataFrame:
        body = json.dumps([[w, list(i)] for w, i in zip(frame["window"], frame["items"])])
        return pd.DataFrame({"uri": [write_file(folder, "json", body.encode())]})

    dealt = windows.withColumn("shard", F.pmod(F.xxhash64("window"), F.lit(shards)))
    files = stage(dealt.groupBy("shard").applyInPandas(write, "uri string"), "window-files")
    return sorted(row["uri"] for row in files.collect())


@functools.lru_cache(maxsize=1)
def _automaton(uri: str) -> tuple[ahocorasick.Automaton, list[tuple[int, list[str]]]]:
    """The automaton of one file of windows, and each window's word count and items."""
    automaton, known = ahocorasick.Automaton(), []
    for window, items in json.loads(mapped_file(uri).tobytes()):
        automaton.add_word(window, len(known))
        known.append((window.count(" ") - 1, items))
    automaton.make_automaton()
    return automaton, known


def _found(raw: bytes, hits: list[tuple[int, int]], items: set[str], n_words: int) -> tuple:
    """The result for a text with occurrences, given as (first word, number of words)."""
    marks = np.zeros(n_words + 1, np.int64)
    for first, count in hits:
        marks[first] += 1
        marks[first + count] -= 1
    hit = np.cumsum(marks[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    inside = np.frombuffer(raw.translate(_KEPT), np.uint8) != 32
    bounds = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    codes = np.cumsum(np.append(0, (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
    spans = [
        {"start": int(codes[bounds[2 * a]]), "end": int(codes[bounds[2 * b - 1]])}
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())
    ]
    return n_words, int(hit.sum()), sorted(items), spans


def scan_texts(texts: list[str | None], uris: list[str]) -> list[tuple]:
    """(words, hit words, items, spans of hit words) of each text."""
    raws = [(text or "").encode() for text in texts]
    joined = [f" {b' '.join(normal_words(raw)).decode('latin-1')} " for raw in raws]
    hits: dict[int, set[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    for uri in uris:
        automaton, known = _automaton(uri)
        for row, text in enumerate(joined):
            if found := list(automaton.iter(text)):
                gaps = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
                ends = np.searchsorted(gaps, [end for end, _ in found]).tolist()
                for end, (_, number) in zip(ends, found):
                    count, owners = known[number]
                    hits.setdefault(row, set()).add((end - count, count))
                    items.setdefault(row, set()).update(owners)
    return [
        _found(raw, sorted(hits[i]), items[i], words) if i in hits else (words, 0, [], [])
        for i, (raw, words) in enumerate(zip(raws, (t.count(" ") - 1 if len(t) > 2 else 0 for t in joined)))
    ]


def _slices(texts: list[str | None], chars: int) -> Iterator[list[str | None]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text or "") > chars:
            yield texts[first:i]
            first, size = i, 0
        size += len(text or "")
    yield texts[first:]


def scanner(uris: list[str]) -> Callable[[Column], Column]:
    """A column function from texts to a struct of n_words, n_hit, items and spans."""

    @F.pandas_udf(_RESULT)
    @releasing
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in _RESULT.split(", ")]
        for texts in batches:
            rows = [row for part in _slices(texts.tolist(), CHUNK_CHARS) for row in scan_texts(part, uris)]
            yield pd.DataFrame(rows, columns=names)

    return scan


def find_contamination(docs: DataFrame, benchmark: DataFrame, name: str = "contamination") -> DataFrame:
    """``docs`` (any columns, text among them) with a struct column ``name``.

    The struct has n_words, n_hit, items (sorted), spans, and contaminated: at
    least one word in 20 lies in an occurrence of a window.
    """
    found = scanner(write_windows(benchmark.select("item_id", "text")))(F.col("text"))
    result = docs.withColumn(name, found)
    hit, words = F.col(f"{name}.n_hit"), F.col(f"{name}.n_words")
    return result.withColumn(
        name, F.col(name).withField("contaminated", (hit > 0) & (20 * hit >= words))
    )
