"""A character trigram model of a corpus, and Viterbi decoding of disguised words.

Symbols: 0 for anything that is no letter, 1 to 26 for a to z, 27 for any other
letter. A lattice has one column per character of a disguised span; a column's
options are (symbol, text, log probability that the text was written as that
character). An option without a symbol leaves the character out: the rest of a
repeated run, or a separator between spaced letters. Viterbi finds the most
probable reading under model and channel together.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.arrays import releasing, text_chunks

SYMBOLS = 28
_OTHER_LETTER = 27

# Letters that a written character may stand for, likeliest first.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "tl", "8": "b", "9": "gq",
    "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "€": "e",
}
WILD = "*#%"
# Log probability that a sign inside a word stands for itself.
_AS_WRITTEN = math.log(1e-4)
_SIGNS = re.escape("".join(LEET) + WILD)
_SIGN_SET = frozenset("".join(LEET) + WILD)
_SPACED = re.compile(rf"(?<![\w{_SIGNS}])[^\W_](?:[ ._\-*](?:[^\W_]|[@$!])){{2,}}(?!\w)")



@functools.cache
def _symbol_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x80, 0x30000):
        if chr(code).isalpha():
            table[code] = _OTHER_LETTER
    for i in range(26):
        table[97 + i] = table[65 + i] = i + 1
    return table


def symbols(text: str) -> np.ndarray:
    return _symbol_table()[np.frombuffer(text.encode("utf-32-le"), "<u4")]


def count_trigrams(docs: DataFrame) -> DataFrame:
    """(code, times) of the symbol trigrams in all whole texts of ``docs`` (text).

    Texts count as bounded by non-letters; there are at most 28**3 codes, and each
    task sends every code once.
    """

    @releasing
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for _, texts in text_chunks(batches):
            s = symbols("  " + "  ".join(texts) + "  ").astype(np.int64)
            total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["code", "times"])

    counted = docs.select("text").mapInArrow(count, "code long, times long")
    return counted.groupBy("code").agg(F.sum("times").cast("long").alias("times"))


class CharModel:
    """Interpolated trigram log probabilities, from trigram counts."""

    def __init__(self, counts: dict[int, int]):
        three = np.zeros(SYMBOLS**3)
        for code, times in counts.items():
            three[code] = times
        three = three.reshape((SYMBOLS,) * 3)
        two, one = three.sum(0), three.sum((0, 1))
        p1 = (one + 1) / (one.sum() + SYMBOLS)
        p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
        p3 = (three + 5 * p2) / (three.sum(2, keepdims=True) + 5)
        self.log = np.log(p3).tolist()
        self.memo: dict[str, str] = {}

    def read(self, span: str, spaced: bool = False) -> str:
        """The likeliest plain text of a disguised span."""
        key = ("s" if spaced else "w") + span
        known = self.memo.get(key)
        if known is None:
            if len(self.memo) > 200_000:
                self.memo.clear()
            known = self.memo[key] = self._viterbi(lattice(span, spaced))
        return known

    def _viterbi(self, columns: list[list[tuple[int | None, str, float]]]) -> str:
        # Best path to each state (last two symbols): log probability, text as a chain.
        best = {(0, 0): (0.0, None)}
        for column in [*columns, [(0, "", 0.0)], [(0, "", 0.0)]]:
            after: dict[tuple[int, int], tuple] = {}
            for (a, b), (score, path) in best.items():
                follow = self.log[a][b]
                for symbol, text, channel in column:
                    state = (a, b) if symbol is None else (b, symbol)
                    value = score + channel + (0.0 if symbol is None else follow[symbol])
                    if state not in after or value > after[state][0]:
                        after[state] = (value, (path, text) if text else path)
            best = after
        path, out = max(best.values(), key=lambda v: v[0])[1], []
        while path is not None:
            path, text = path
            out.append(text)
        return "".join(reversed(out))


def _letter(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else _OTHER_LETTER if c.isalpha() else 0


def lattice(span: str, spaced: bool) -> list[list[tuple[int | None, str, float]]]:
    """The options for each character of ``span``, which is lower-cased."""
    columns: list[list[tuple[int | None, str, float]]] = []
    runs = [(c, len(list(g))) for c, g in itertools.groupby(span)]
    if any(n > 2 for _, n in runs):
        # A run of three or more was one letter or two; each count is as likely.
        runs = [(c, min(n, 2)) for c, n in runs]
        flexible = {i for i, (_, n) in enumerate(runs) if n == 2}
    else:
        flexible = set()
    for i, (c, n) in enumerate(runs):
        for copy in range(n):
            if spaced and c in " ._-*":
                column = [(None, "", math.log(0.97)), (0, " ", math.log(0.03))]
            elif c in LEET:
                shares = [0.9] if len(LEET[c]) == 1 else [0.6, 0.3]
                column = [(_letter(x), x, math.log(p)) for x, p in zip(LEET[c], shares)]
                column.append((0, c, _AS_WRITTEN))
            elif c in WILD:
                column = [(k + 1, chr(97 + k), math.log(0.9 / 26)) for k in range(26)] + [(0, c, _AS_WRITTEN)]
            else:
                column = [(_letter(c), c, 0.0)]
            if copy and i in flexible:
                column = [*column, (None, "", 0.0)]
            columns.append(column)
    return columns


@functools.cache
def _gate_table() -> np.ndarray:
    """1 for letters, 2 for signs that may stand for one, 4 for separators."""
    table = (_symbol_table() > 0).astype(np.uint8)
    for signs, kind in (("".join(LEET) + WILD, 2), (" ._-*", 4)):
        for c in signs:
            table[ord(c)] |= kind
    return table


def _places(text: str, kind: str) -> np.ndarray:
    """Where ``text`` can hold a word with signs, spaced letters or a repeated letter."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kinds = _gate_table()[codes]
    letter = (kinds & 1) > 0
    if kind == "repeated":
        return np.flatnonzero((codes[2:] == codes[1:-1]) & (codes[1:-1] == codes[:-2]) & letter[2:])
    sign = (kinds & 2) > 0
    if kind == "signs":
        return np.flatnonzero((letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:]))
    gap, some = (kinds & 4) > 0, letter | sign
    return np.flatnonzero(some[:-4] & gap[1:-3] & some[2:-2] & gap[3:-1] & some[4:])


def _replaced(text: str, places: np.ndarray, span: Callable[[int], tuple[int, int]], read: Callable[[str], str]) -> str:
    """``text`` with the spans around ``places`` read anew."""
    out, done = [], 0
    for place in places.tolist():
        if place < done:
            continue
        first, last = span(place)
        if last > first >= done:
            out += [text[done:first], read(text[first:last])]
            done = last
    return "".join([*out, text[done:]]) if out else text


_TAIL = re.compile(rf"[{re.escape(''.join(c for c in LEET if not c.isalnum()) + WILD)}]*$")


def _in_disguise(c: str) -> bool:
    return c.isalpha() or c in _SIGN_SET


def _disguised(span: str, model: CharModel) -> str:
    """The reading of a word with signs; signs around it are punctuation."""
    head = len(span) - len(span.lstrip(WILD))
    tail = _TAIL.search(span)[0]
    stop = len(span) if tail in ("$", "$$", "@") else len(span) - len(tail)
    core = span[head:stop]
    if not core or core.isalpha():
        return span
    return span[:head] + model.read(core) + span[stop:]


def restore(text: str | None, model: CharModel) -> str:
    """``text`` in lower case, with disguised words read by ``model``."""
    text = (text or "").lower()

    def word(place: int, inside: Callable[[str], bool]) -> tuple[int, int]:
        first, last = place, place + 1
        while first and inside(text[first - 1]):
            first -= 1
        while last < len(text) and inside(text[last]):
            last += 1
        return first, last

    def spaced(place: int) -> tuple[int, int]:
        found = _SPACED.match(text, place)
        return found.span() if found else (place, place)

    places = _places(text, "signs")
    text = _replaced(text, places, lambda i: word(i, _in_disguise), lambda s: _disguised(s, model))
    text = _replaced(text, _places(text, "spaced"), spaced, lambda s: model.read(s, True))
    places = _places(text, "repeated")
    return _replaced(text, places, lambda i: word(i, str.isalpha), model.read)
