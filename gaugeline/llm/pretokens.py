"""Pre-tokens of byte-level BPE found with array operations, and their ids.

The pattern of the tokenizer is fixed (:data:`PATTERN`). Its matches depend
only on the class of each code point (letter, number, white space, other), on
U+0020 and on the seven contractions, so a whole batch of texts is split at
once instead of match by match.
"""

from __future__ import annotations

import functools
import itertools
import json
from dataclasses import dataclass

import numpy as np
import regex
import tiktoken
import xxhash

from gaugeline.llm.arrays import gathered, span_hashes

# Fixed value: the byte-level pattern that the tokenizer files are made for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LETTER, NUMBER, SPACE, OTHER, SEPARATOR, SPECIAL = range(6)
_SEPARATOR_CODE, _SPECIAL_CODE = 0x110000, 0x110001

# Longer pre-tokens are hashed by a byte hash instead of a polynomial.
LONG_PIECE = 200

# Pre-tokens a worker remembers before it starts afresh.
CACHED_PIECES = 1_000_000


@functools.cache
def _classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110002, OTHER, np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        text = "".join(map(chr, range(low, high)))
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
            for match in regex.finditer(pattern, text):
                table[low + match.start() : low + match.end()] = kind
    table[_SEPARATOR_CODE], table[_SPECIAL_CODE] = SEPARATOR, SPECIAL
    return table


@dataclass
class Pieces:
    """Pre-tokens of a batch of texts, in order; ``rows`` says whose they are."""

    joined: str
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    hashes: np.ndarray
    special: np.ndarray

    def texts(self, picked: np.ndarray) -> list[str]:
        spans = zip(self.starts[picked].tolist(), self.ends[picked].tolist())
        return [self.joined[a:b] for a, b in spans]


def piece_starts(codes: np.ndarray) -> np.ndarray:
    """Where a pre-token begins, one flag per code."""
    kinds = _classes()[codes]
    start = np.ones(len(codes), bool)
    start[1:] = kinds[1:] != kinds[:-1]
    alone = kinds >= SEPARATOR
    start |= alone
    start[1:] |= alone[:-1]
    # The last white space before a visible character stands alone or, if it is
    # U+0020, belongs to what follows.
    last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & ~alone[1:])
    start[last] = True
    start[last[codes[last] == 0x20] + 1] = False
    for p in np.flatnonzero(codes == 0x27).tolist():
        if p and (kinds[p - 1] == OTHER or codes[p - 1] == 0x20):
            continue
        after = "".join(map(chr, itertools.takewhile(lambda c: c < 0x110000, codes[p + 1 : p + 3].tolist())))
        size = 1 if after[:1] in ("s", "t", "m", "d") else 2 if after in ("re", "ve", "ll") else 0
        if size:
            start[p + 1] = False
            if p + size + 1 < len(codes):
                start[p + size + 1] = True
    return start


def split_pieces(texts: list[str], special: str | None = None) -> Pieces:
    """Pre-tokens of ``texts``; every occurrence of ``special`` is one by itself."""
    segments: list[str] = []
    owners: list[int] = []
    opened: list[bool] = []
    for row, text in enumerate(texts):
        parts = text.split(special) if special and special in text else (text,)
        segments += parts
        owners += [row] * len(parts)
        opened += [False, *[True] * (len(parts) - 1)]
    if not segments:
        segments, owners, opened = [""], [0], [False]
    joined = "\0".join(segments) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4").copy()
    sizes = np.fromiter(map(len, segments), np.int64, len(segments)) + 1
    ends = np.cumsum(sizes)
    # The code after a segment: a special token if the next one follows in the same text.
    more = np.append(np.array(opened[1:], bool), False)
    codes[ends - 1] = np.where(more, _SPECIAL_CODE, _SEPARATOR_CODE)
    starts = np.flatnonzero(piece_starts(codes))
    stops = np.append(starts[1:], len(codes))
    real = codes[starts] != _SEPARATOR_CODE
    starts, stops = starts[real], stops[real]
    rows = np.array(owners, np.int64)[np.searchsorted(ends, starts, "right")]
    hashes = span_hashes(codes, starts, stops)
    for i in np.flatnonzero(stops - starts > LONG_PIECE).tolist():
        hashes[i] = xxhash.xxh64_intdigest(joined[starts[i] : stops[i]].encode(), 7)
    return Pieces(joined, starts, stops, rows, hashes, codes[starts] == _SPECIAL_CODE)


@dataclass
class Vocabulary:
    """A byte-level BPE vocabulary read from the file of the tokenizers library."""

    ranks: dict[bytes, int]
    special: str | None
    special_id: int | None

    @functools.cached_property
    def coder(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    @functools.cached_property
    def token_bytes(self) -> list[bytes]:
        """The bytes of each id."""
        out = [b""] * (max([*self.ranks.values(), self.special_id or 0]) + 1)
        for token, i in self.ranks.items():
            out[i] = token
        if self.special is not None:
            out[self.special_id] = self.special.encode()
        return out

    @functools.cached_property
    def decimals(self) -> list[bytes]:
        return [str(i).encode() for i in range(len(self.token_bytes))]


def _byte_letters() -> dict[str, int]:
    """The byte that each printable stand-in of byte-level BPE means."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def load_vocabulary(path: str) -> Vocabulary:
    """Read ``path``; raises if ids do not follow the order of the merges, as ranks must."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    letters = _byte_letters()
    model = data["model"]["vocab"]
    added = data["added_tokens"]
    if len(added) > 1:
        raise ValueError(f"{path}: one added token at most is supported")
    names = {token["content"] for token in added}
    ranks = {bytes(letters[c] for c in t): i for t, i in model.items() if t not in names}
    merged = [m if isinstance(m, str) else " ".join(m) for m in data["model"]["merges"]]
    order = [model[m.replace(" ", "")] for m in merged]
    if order != sorted(order):
        raise ValueError(f"{path}: ids do not follow the merges")
    only = added[0] if added else None
    return Vocabulary(ranks, only["content"] if only else None, only["id"] if only else None)


class PieceEncoder:
    """Ids of texts; each distinct pre-token is encoded once while it is remembered."""

    def __init__(self, vocabulary: Vocabulary, cached: int = CACHED_PIECES):
        self.vocabulary = vocabulary
        self.cached = cached
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.offsets = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        encode = self.vocabulary.coder.encode_ordinary
        found = [encode(piece) for piece in pieces]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        offsets = len(self.ids) + np.cumsum(lengths) - lengths
        flat = np.array([*itertools.chain.from_iterable(found)], np.uint32)
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.offsets = np.insert(self.offsets, at, offsets)
        self.lengths = np.insert(self.lengths, at, lengths)
        self.ids = np.concatenate([self.ids, flat])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text)."""
        pieces = split_pieces(texts, self.vocabulary.special)
        ordinary = np.flatnonzero(~pieces.special)
        distinct, first, inverse = np.unique(
            pieces.hashes[ordinary], return_index=True, return_inverse=True
        )
        if len(self.known) > self.cached:
            self._forget()
        at = np.searchsorted(self.known, distinct)
        fresh = np.ones(len(distinct), bool)
        inside = at < len(self.known)
        fresh[inside] = self.known[at[inside]] != distinct[inside]
        if fresh.any():
            self._learn(distinct[fresh], pieces.texts(ordinary[first[fresh]]))
            at = np.searchsorted(self.known, distinct)
        lengths = np.ones(len(pieces.starts), np.int64)
        lengths[ordinary] = self.lengths[at][inverse]
        offsets = np.zeros(len(pieces.starts), np.int64)
        offsets[ordinary] = self.offsets[at][inverse]
        ids = self.ids[gathered(offsets, lengths)] if len(self.ids) else np.zeros(lengths.sum(), np.uint32)
        if pieces.special.any():
            ids[(np.cumsum(lengths) - 1)[pieces.special]] = self.vocabulary.special_id
        counts = np.bincount(pieces.rows, weights=lengths, minlength=len(texts)).astype(np.int64)
        return ids, counts


_encoders: dict[str, PieceEncoder] = {}


def encoder_for(path: str) -> PieceEncoder:
    """The encoder this Python worker keeps for the tokenizer file ``path``."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(load_vocabulary(path))
    return _encoders[path]
