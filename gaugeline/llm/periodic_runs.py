"""Maximal periodic runs of words, found on a Re-Pair grammar of each batch of texts.

A run is a stretch of consecutive words with smallest period q, at least
max(``LEAST_WORDS``, 2 q) words long, that no neighbouring word extends with
the same period.

1. Words become numbers, and every text ends with a separator of its own.
   Re-Pair replaces repeated pairs of symbols by nonterminals. Each round takes
   all pairs that are more frequent than the pairs overlapping them; the
   grammar is shared by the texts of a batch, so copies are worked on once.
2. What is left of a text, its start rule, is halved down to single symbols:
   these halves are its last nonterminals, each with one place.
3. Every run lies in some lowest nonterminal X -> A B and crosses the boundary
   of A and B there. It repeats a word triple next to the boundary at distance
   q, or it is shorter than twice three words at the boundary, which
   max(12, 2 q) excludes; so triples equal to those beside the boundary are the
   only candidates, and each is extended both ways inside X, once per X.
4. Runs of a nonterminal are translated to all places where it was put, which
   are its places in the derivation, and stretches of one period that share at
   least a period are merged. A multiple of the smallest period has the same
   maximal stretch and goes.

Words and stretches are told apart by 64-bit hashes within a batch. Memory
follows the batch (``CHUNK_CHARS``) or the one text that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gaugeline.llm.arrays import gathered, mixed, releasing, span_hashes, text_chunks

# Fixed value: fewer words are no run, whatever their period.
LEAST_WORDS = 12
# Re-Pair ends when a round would replace less than this part of the symbols;
# what is left to the start rules is handled by their halves.
LEAST_SHARE = 1 / 64
# Equal stretches are measured in steps of at most 2**10 words, or more where their
# hashes fit this many bytes.
_STEP_LEVELS = 10
_STEP_BYTES = 256_000_000
_LONG_WORD = 200
_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_TURN = np.uint64(0x9E3779B97F4A7C15)

_RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(_RUN, False)),
        T.StructField("collapsed", T.StringType()),
    ]
)


def numbered_words(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, first symbol of each text and the end).

    Equal words have equal numbers; each text is closed by a number that occurs once.
    """
    data = b"\n".join(raws) + b"\n"
    codes = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate([[True], _IS_SPACE[codes]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    hashes = span_hashes(codes, starts, ends)
    for i in np.flatnonzero(ends - starts > _LONG_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]], 7)
    distinct, words = np.unique(hashes, return_inverse=True)
    stops = np.cumsum([len(raw) + 1 for raw in raws])
    row = np.searchsorted(stops, starts, "right")
    first = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(raws)) + 1)])
    symbols = np.empty(len(words) + len(raws), np.int64)
    symbols[np.arange(len(words)) + row] = words
    symbols[first[1:] - 1] = len(distinct) + np.arange(len(raws))
    return symbols, first


class Grammar:
    """Re-Pair over ``symbols``; those from ``words`` on are separators and stay alone.

    ``left`` and ``size`` describe nonterminals by words of their halves and
    of the whole, ``names`` and ``places`` list all places of nonterminals.
    The symbols that are left begin at ``at``.
    """

    def __init__(self, symbols: np.ndarray, words: int, least_share: float = LEAST_SHARE):
        rules = int(symbols.max()) + 1 if len(symbols) else 0
        base = rules
        at = np.arange(len(symbols))
        length = np.ones(len(symbols), np.int64)
        ordinary = symbols < words
        left, size, names, places = [], [], [], []
        while True:
            chosen, pair = self._round(symbols, ordinary)
            if len(chosen) < max(2, least_share * len(symbols)):
                break
            distinct, first, name = np.unique(pair, return_index=True, return_inverse=True)
            left.append(length[chosen[first]])
            size.append(left[-1] + length[chosen[first] + 1])
            names.append(rules - base + name)
            places.append(at[chosen])
            symbols = symbols.copy()
            symbols[chosen] = rules + name
            length[chosen] += length[chosen + 1]
            rules += len(distinct)
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            symbols, at, length, ordinary = symbols[keep], at[keep], length[keep], ordinary[keep]
        none = [np.empty(0, np.int64)]
        self.left, self.size, self.names, self.places = (
            np.concatenate(parts or none) for parts in (left, size, names, places)
        )
        self.at = at

    @staticmethod
    def _round(symbols: np.ndarray, ordinary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions whose pair is replaced in this round, the pairs)."""
        can = np.flatnonzero(ordinary[:-1] & ordinary[1:])
        pair = symbols[can] * np.int64(1 << 31) + symbols[can + 1]
        # In a row of one symbol every other pair counts.
        same = np.zeros(len(can), bool)
        same[1:] = (pair[1:] == pair[:-1]) & (can[1:] == can[:-1] + 1)
        index = np.arange(len(can))
        opened = np.maximum.accumulate(np.where(same, 0, index))
        even = (index - opened) % 2 == 0
        can, pair = can[even], pair[even]
        distinct, kind, count = np.unique(pair, return_inverse=True, return_counts=True)
        rank = np.empty(len(distinct), np.int64)
        rank[np.argsort(count, kind="stable")] = np.arange(len(distinct))
        weight = np.full(len(symbols) + 2, -1, np.int64)
        weight[can + 1] = np.where(count[kind] > 1, rank[kind], -1)
        own = weight[can + 1]
        wins = (own > weight[can]) & (own > weight[can + 2]) & (own >= 0)
        times = np.bincount(kind[wins], minlength=len(distinct))
        wins &= times[kind] > 1
        return can[wins], pair[wins]


def _halves(at: np.ndarray, row: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, boundary, end) of the nonterminals that halve what is left of each text.

    ``at`` are the places of all symbols left, separators last in each text.
    """
    opens = np.searchsorted(row, np.arange(len(first) - 1))
    symbols = np.bincount(row, minlength=len(first) - 1) - 1
    width = 1
    while len(symbols) and width < symbols.max():
        nodes = np.maximum(-(-(symbols - width) // (2 * width)), 0)
        text = np.repeat(np.arange(len(nodes)), nodes)
        number = gathered(np.zeros(len(nodes), np.int64), nodes)
        low = opens[text] + number * 2 * width
        high = np.minimum(low + 2 * width, opens[text] + symbols[text])
        yield at[low], at[low + width], at[high]
        width *= 2


class Stretches:
    """Lengths of equal stretches of ``symbols``, by hashes of 1, 2, 4, ... symbols."""

    def __init__(self, symbols: np.ndarray):
        level = mixed(symbols.astype(np.uint64) + _TURN)
        self.levels, width = [level], 1
        most = max(_STEP_LEVELS, _STEP_BYTES // max(1, level.nbytes) - 1)
        while len(self.levels) <= most and 2 * width <= len(level):
            longer = np.zeros(len(level), np.uint64)
            longer[: len(level) - width] = mixed(level[: len(level) - width] * _TURN + level[width:])
            level, width = longer, 2 * width
            self.levels.append(level)

    def after(self, x: np.ndarray, y: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Equal symbols from ``x`` and from ``y`` on, at most ``room``."""
        return self._measured(x, y, 1, room)

    def before(self, x: np.ndarray, y: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Equal symbols that end before ``x`` and before ``y``, at most ``room``."""
        return self._measured(x, y, -1, room)

    def _measured(self, x: np.ndarray, y: np.ndarray, way: int, room: np.ndarray) -> np.ndarray:
        found = np.zeros(len(x), np.int64)
        top = len(self.levels) - 1
        for k in range(top, -1, -1):
            width = 1 << k
            active = np.flatnonzero(found + width <= room)
            while len(active):
                shift = found[active] if way > 0 else -found[active] - width
                same = self.levels[k][x[active] + shift] == self.levels[k][y[active] + shift]
                active = active[same]
                found[active] += width
                # Only the widest step is taken more than once.
                active = active[found[active] + width <= room[active]] if k == top else active[:0]
        return found


def _crossing(
    stretches: Stretches, triples: np.ndarray, low: np.ndarray, middle: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of runs that cross the boundary of nodes, inside them."""
    node = np.repeat(np.arange(len(low)), high - low + 1)
    point = gathered(low, high - low + 1)
    border = middle[node]
    # triples[i + 3] are the words from i on.
    near = (triples[point + 3] == triples[border + 3]) | (triples[point] == triples[border])
    near &= point != border
    node, point, border = node[near], point[near], border[near]
    x, y = np.minimum(point, border), np.maximum(point, border)
    start = x - stretches.before(x, y, x - low[node])
    end = y + stretches.after(x, y, high[node] - y)
    period = y - x
    runs = end - start >= np.maximum(LEAST_WORDS, 2 * period)
    found = np.stack([node, start, end, period])[:, runs]
    found = found[:, np.lexsort(found[::-1])]
    fresh = np.ones(found.shape[1], bool)
    fresh[1:] = (found[:3, 1:] != found[:3, :-1]).any(axis=0)
    return tuple(found[:, fresh])


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal stretches (start, end, smallest period), in order of start and period."""
    if not len(start):
        return start, end, period
    order = np.lexsort((end, start, period))
    start, end, period = start[order], end[order], period[order]
    # Ends that grow from period to period let one running maximum serve all.
    lift = (np.cumsum(np.append(0, period[1:] != period[:-1]))) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift)
    opens = np.append(True, start[1:] + lift[1:] > reach[:-1] - period[1:])
    first = np.flatnonzero(opens)
    start, period = start[first], period[first]
    end = np.maximum.reduceat((end + lift), first) - lift[first]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    smallest = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))
    start, end, period = start[smallest], end[smallest], period[smallest]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def batch_runs(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, end, period) of all runs in ``symbols``, by place in ``symbols``."""
    grammar = Grammar(symbols, int(symbols.max(initial=0)) + 2 - len(first))
    stretches = Stretches(symbols)
    padded = np.concatenate([np.full(3, -1), symbols, np.full(4, -1)]).astype(np.uint64)
    triples = mixed(mixed(mixed(padded[:-2]) + padded[1:-1]) + padded[2:])
    found = []
    large = np.flatnonzero(grammar.size >= LEAST_WORDS)
    if len(large):
        order = np.argsort(grammar.names, kind="stable")
        names, places = grammar.names[order], grammar.places[order]
        begin, stop = np.searchsorted(names, large, "left"), np.searchsorted(names, large, "right")
        low = places[begin]  # any place shows the words of a nonterminal
        node, start, end, period = _crossing(
            stretches, triples, low, low + grammar.left[large], low + grammar.size[large]
        )
        times = (stop - begin)[node]
        shift = places[gathered(begin[node], times)] - np.repeat(low[node], times)
        found.append([np.repeat(start, times) + shift, np.repeat(end, times) + shift, np.repeat(period, times)])
    row = np.searchsorted(first, grammar.at, "right") - 1
    for low, middle, high in _halves(grammar.at, row, first):
        wide = high - low >= LEAST_WORDS
        if wide.any():
            found.append(_crossing(stretches, triples, low[wide], middle[wide], high[wide])[1:])
    if not found:
        return (np.empty(0, np.int64),) * 3
    return _merged(*(np.concatenate(parts) for parts in zip(*found)))


def text_runs(texts: list[str]) -> list[tuple[int, list[tuple[int, int, int]], str]]:
    """(words, runs as (start, length, period), words kept joined by spaces) of each text."""
    raws = [text.encode() for text in texts]
    symbols, first = numbered_words(raws)
    start, end, period = batch_runs(symbols, first)
    row = np.searchsorted(first, start, "right") - 1
    bounds = np.searchsorted(row, np.arange(len(raws) + 1))
    marks = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(marks, start + period, 1)
    np.add.at(marks, end, -1)
    kept = np.cumsum(marks[:-1]) == 0
    out = []
    for i, raw in enumerate(raws):
        words = raw.split()
        a, b = bounds[i], bounds[i + 1]
        runs = list(zip((start[a:b] - first[i]).tolist(), (end - start)[a:b].tolist(), period[a:b].tolist()))
        left = [w for w, k in zip(words, kept[first[i] :].tolist()) if k] if runs else words
        out.append((len(words), runs, b" ".join(left).decode()))
    return out


def _column(rows: list[tuple[int, list[tuple[int, int, int]], str]]) -> pa.StructArray:
    offsets = np.cumsum([0, *(len(runs) for _, runs, _ in rows)])
    flat = np.array([run for _, runs, _ in rows for run in runs], np.int64).reshape(-1, 3)
    fields = [pa.array(np.ascontiguousarray(c)) for c in flat.T]
    runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, _RUN.names))
    words, texts = pa.array([n for n, _, _ in rows], pa.int64()), pa.array([t for *_, t in rows], pa.string())
    return pa.StructArray.from_arrays([words, runs, texts], ["n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, name: str = "periodic") -> DataFrame:
    """``docs`` (any columns, text among them) with a struct column ``name``.

    A column of that name is replaced. The struct has n_words, runs (start,
    length, period in words, by start, then period) and collapsed: the words
    outside every run's repetitions, joined by spaces. Null text has no words.
    Rows are independent: equal rows have equal results, and nothing is shuffled.
    """

    @releasing
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches):
            found = _column(text_runs(texts))
            yield pa.RecordBatch.from_arrays([*rows.columns, found], [*rows.schema.names, name])

    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, RESULT)])
    return docs.mapInArrow(work, schema)
