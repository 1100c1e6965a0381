"""Small numpy helpers for text work inside tasks: batches, hashes, packed arrays."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

# Code points handled at once; a longer text makes a batch of its own.
CHUNK_CHARS = 1_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_powers: list[np.ndarray] = []


def text_chunks(
    batches: Iterator[pa.RecordBatch], chars: int = CHUNK_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """(rows, their texts) of at most ``chars`` code points each, null texts as "".

    A single longer text is still one chunk: whole texts, never parts.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
        first, size = 0, 0
        for i, length in enumerate([*lengths, None]):
            if length is None or (i > first and size + length > chars):
                if i > first:
                    rows = batch.slice(first, i - first)
                    yield rows, [text or "" for text in rows.column("text").to_pylist()]
                first, size = i, 0
            size += length or 0


def release_memory() -> None:
    """Give back what this worker's allocators hold but do not use.

    Workers live on between tasks, several to an executor, and freed memory that
    each of them keeps adds up.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over the batches of a task, which ends with :func:`release_memory`."""

    @functools.wraps(work)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            release_memory()

    return run


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finalizer of a splitmix generator)."""
    shifted = values >> np.uint64(30)
    values = values ^ shifted
    for factor, shift in ((_MIX1, np.uint64(27)), (_MIX2, np.uint64(31))):
        values *= factor
        shifted = np.right_shift(values, shift, out=shifted)
        values ^= shifted
    return values


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_CHARS + 4096)
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = [
            np.concatenate([[np.uint64(1)], np.full(size - 1, base, np.uint64)]).cumprod(dtype=np.uint64)
            for base in (_BASE, inverse)
        ]
    return _powers[0], _powers[1]


def _symbol_values(symbols: np.ndarray) -> np.ndarray:
    value = (symbols.astype(np.uint64) + np.uint64(1)) * _MIX2
    return value ^ (value >> np.uint64(29))


_BYTE_VALUES = _symbol_values(np.arange(256))


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``symbols`` (integers), equal for equal spans.

    Polynomial over mixed symbols, modulo 2**64. Callers hash spans beyond a
    few hundred symbols by other means, as such sums have structured collisions
    from about 2**10 symbols on.
    """
    if not len(starts):
        return np.empty(0, np.uint64)
    powers, inverses = _power_table(len(symbols) + 1)
    value = _BYTE_VALUES[symbols] if symbols.dtype == np.uint8 else _symbol_values(symbols)
    value *= powers[: len(symbols)]
    total = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(value, out=total[1:])
    sums = (total[ends] - total[starts]) * inverses[starts]
    return mixed(sums + (ends - starts).astype(np.uint64) * _MIX1)


def packed(array: np.ndarray) -> bytes:
    """Unsigned integers as byte planes, compressed; small values cost little."""
    array = np.ascontiguousarray(array)
    width = 1
    top = int(array.max()) if len(array) else 0
    while top >> (8 * width):
        width += 1
    raw = array.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    body = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())
    return bytes([width]) + len(array).to_bytes(8, "little") + body


def unpacked(blob: bytes, narrow: bool = False) -> np.ndarray:
    """The inverse of :func:`packed`, as uint64 or, if ``narrow``, the type that just holds them."""
    width, count = blob[0], int.from_bytes(blob[1:9], "little")
    raw = zstandard.ZstdDecompressor().decompress(blob[9:], max_output_size=max(1, width * count))
    size = 1 << (width - 1).bit_length() if narrow else 8
    out = np.zeros((count, size), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, count).T
    return out.reshape(-1).view(f"<u{size}")


def squeezed(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unsqueezed(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompressobj().decompress(blob)


def gathered(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of concatenated slices ``offsets[i] : offsets[i] + lengths[i]``."""
    ends = np.cumsum(lengths)
    shift = np.repeat(offsets - (ends - lengths), lengths)
    return shift + np.arange(ends[-1] if len(ends) else 0)
