"""Packing of documents into sequences of one length, next to their lexical neighbours.

Documents are encoded once and dealt by similarity: in order of two minimum
hashes of their token ids, so that copies and texts that share much of their
vocabulary come to lie side by side. Each task cuts its part of that order into
shards of about ``SHARD_TOKENS`` tokens. A shard has an inverted index from
tokens to its documents with their BM25 weights.

The first unused document of a shard is a seed. While it is longer than a
window, whole windows are cut from it; what is left asks the index for unused
neighbours, best first, by its ``QUERY_TERMS`` heaviest terms. They fill the
window, the last one is cut where the window ends, and its rest is the
next seed. Documents that share no asked term follow in the order of the shard.
So every sequence is full but for the end of a shard, which is cut into
sequences of falling powers of two: these need no padding either.

Shards are independent, so the work grows with the number of documents, and no
task holds more than a shard (or one document that is longer). A seed finds
neighbours of its own shard only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.arrays import mixed, releasing, text_chunks
from gaugeline.llm.pretokens import encoder_for, load_vocabulary
from gaugeline.operators.stage import stage

# Tokens of one shard, and of one task that cuts its documents into shards.
SHARD_TOKENS = 1_000_000
TASK_TOKENS = 8_000_000
# Terms of a seed that are asked for: those with the largest BM25 weights.
QUERY_TERMS = 32
# The usual parameters of BM25.
K1, B = 1.2, 0.75

_SEQUENCE_BITS = 32
_SALTS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


class ShardIndex:
    """BM25 postings of the documents of a shard, given as ids and where each document ends."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        n = len(counts)
        doc = np.repeat(np.arange(n), counts)
        key, times = np.unique(ids.astype(np.int64) * n + doc, return_counts=True)
        term, self.doc = key // n, key % n
        opens = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
        self.bounds = np.append(opens, len(term))
        found = np.diff(self.bounds)
        rarity = np.log1p((n - found + 0.5) / (found + 0.5))
        length = counts / counts.mean()
        weight = times * (K1 + 1) / (times + K1 * (1 - B + B * length[self.doc]))
        self.weight = np.repeat(rarity, found) * weight
        # The postings of each document, heaviest first.
        number = np.repeat(np.arange(len(opens)), found)
        order = np.lexsort((number, -self.weight, self.doc))
        self.terms = number[order]
        self.ends = np.append(0, np.cumsum(np.bincount(self.doc, minlength=n)))

    def scores(self, doc: int) -> np.ndarray:
        """The BM25 score of every document for the heaviest terms of ``doc``."""
        terms = self.terms[self.ends[doc] : min(self.ends[doc] + QUERY_TERMS, self.ends[doc + 1])]
        spans = [slice(self.bounds[t], self.bounds[t + 1]) for t in terms.tolist()]
        docs = np.concatenate([self.doc[s] for s in spans])
        return np.bincount(docs, np.concatenate([self.weight[s] for s in spans]), len(self.ends) - 1)


def pack_shard(ids: np.ndarray, counts: np.ndarray, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of a shard, in order of their place."""
    index = ShardIndex(ids, counts)
    sizes = counts.tolist()
    used = np.zeros(len(sizes), bool)
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence, room, next_seed = 0, window, 0

    def put(doc: int, start: int) -> int:
        """Put ``doc`` from ``start`` into the open sequence; returns where it was cut."""
        nonlocal sequence, room
        length = min(room, sizes[doc] - start)
        pieces.append((doc, start, length, sequence, window - room))
        room -= length
        if not room:
            sequence, room = sequence + 1, window
        return start + length

    rest: tuple[int, int] | None = None
    while True:
        if rest is None:
            while next_seed < len(sizes) and used[next_seed]:
                next_seed += 1
            if next_seed == len(sizes):
                break
            rest = next_seed, 0
        doc, start = rest
        used[doc] = True
        rest = None
        while start < sizes[doc]:
            start = put(doc, start)
        if room == window:
            continue
        rest = _fill(index.scores(doc), used, sizes, put, lambda: room == window)
    return _without_padding(pieces, window)


def _fill(scores: np.ndarray, used: np.ndarray, sizes: list[int], put, full) -> tuple[int, int] | None:
    """Put unused documents into the open sequence, best first; returns what is left of the last."""
    scores = np.where(used, -1.0, scores)
    # Score first, then the order of the shard; documents without a shared term score 0.
    some = np.flatnonzero(scores > 0)
    best = some[np.lexsort((some, -scores[some]))].tolist()
    others = iter(np.flatnonzero(scores == 0).tolist())
    for doc in (*best, *others):
        used[doc] = True
        end = put(doc, 0)
        if end < sizes[doc]:
            return doc, end
        if full():
            return None
    return None


def _without_padding(pieces: list[tuple[int, int, int, int, int]], window: int) -> list[tuple[int, int, int, int, int]]:
    """The pieces with a last sequence that is not full cut into falling powers of two."""
    if not pieces:
        return pieces
    last = pieces[-1][3]
    total = pieces[-1][4] + pieces[-1][2]
    if total == window:
        return pieces
    out = [p for p in pieces if p[3] != last]
    sequence, room = last, 1 << (total.bit_length() - 1)
    size, left = room, total
    for doc, start, length, _, _ in pieces[len(out) :]:
        while length:
            part = min(length, room)
            out.append((doc, start, part, sequence, size - room))
            start, length, room, left = start + part, length - part, room - part, left - part
            if not room and left:
                sequence, size = sequence + 1, 1 << (left.bit_length() - 1)
                room = size
    return out


def minimum_hashes(ids: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two minimum hashes of the ids of each document that ends at ``ends``; none may be empty."""
    opens = np.append(0, ends[:-1])
    found = []
    for salt in _SALTS:
        table = mixed(np.arange(int(ids.max(initial=0)) + 1, dtype=np.uint64) * salt + salt)
        # Mixed again, or long documents, whose minima are small, would come first together.
        found.append(mixed(np.minimum.reduceat(table[ids], opens)).view(np.int64))
    return found


def pack_documents(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text), each text followed by ``end_id``, in sequences of ``window`` ids.

    One row per piece: doc_id, start and length in its document, ids
    (little-endian unsigned 32-bit integers), doc_tokens, sequence_id and the
    offset there. Null text is "", so just the end; equal rows and rows
    without doc_id are documents of their own. ``window`` is a power of two.
    """
    if window & (window - 1):
        raise ValueError("the window has to be a power of two")
    vocabulary = load_vocabulary(tokenizer)
    small = len(vocabulary.token_bytes) <= 1 << 16 and end_id < 1 << 16
    width = "<u2" if small else "<u4"

    @releasing
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer)
        for rows, texts in text_chunks(batches):
            ids, counts = encoder.encode(texts)
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id)
            ends = ends + np.arange(1, len(ends) + 1)
            raw = ids.astype(width)
            offsets = pa.py_buffer(np.append(0, ends * raw.itemsize).astype("<i4").tobytes())
            blobs = pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets, pa.py_buffer(raw.tobytes())])
            hashes = [pa.array(h) for h in minimum_hashes(ids, ends)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *hashes, pa.array(counts + 1, pa.int64()), blobs],
                ["doc_id", "first_hash", "second_hash", "n_ids", "ids"],
            )

    @releasing
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        done = 0
        for doc_ids, blobs in _shards(batches, SHARD_TOKENS * np.dtype(width).itemsize):
            counts = np.array([len(b) for b in blobs], np.int64) // np.dtype(width).itemsize
            ids = np.frombuffer(b"".join(blobs), width)
            pieces = pack_shard(ids, counts, window)
            yield from _piece_batches(pieces, doc_ids, ids, counts, (task << _SEQUENCE_BITS) + done)
            done += pieces[-1][3] + 1

    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    encoded = docs.mapInArrow(
        encode, "doc_id long, first_hash long, second_hash long, n_ids long, ids binary"
    )
    # Staged, as sorting samples its input first; the row number spreads equal rows.
    encoded = stage(encoded.withColumn("row", F.monotonically_increasing_id()), "encoded-documents")
    tasks = (encoded.agg(F.sum("n_ids")).first()[0] or 0) // TASK_TOKENS + 1
    order = ["first_hash", "second_hash", "doc_id", "n_ids", "row"]
    dealt = encoded.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return dealt.select("doc_id", "ids").mapInArrow(pack, PIECES)


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[bytes]]]:
    """(doc_ids, ids) of consecutive documents of at most ``most`` bytes, or of one longer document."""
    doc_ids, blobs, size = [], [], 0
    for batch in batches:
        for doc_id, blob in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
            if blobs and size + len(blob) > most:
                yield doc_ids, blobs
                doc_ids, blobs, size = [], [], 0
            doc_ids.append(doc_id)
            blobs.append(blob)
            size += len(blob)
    if blobs:
        yield doc_ids, blobs


def _piece_batches(
    pieces: list[tuple], doc_ids: list, ids: np.ndarray, counts: np.ndarray, first: int
) -> Iterator[pa.RecordBatch]:
    doc, start, length, sequence, offset = np.array(pieces, np.int64).T
    opens = np.cumsum(counts) - counts
    raw = memoryview(ids.astype("<u4")).cast("B")
    at = 4 * (opens[doc] + start)
    blobs = [bytes(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([doc_ids[d] for d in doc.tolist()], pa.int64()),
            pa.array(start),
            pa.array(length),
            pa.array(blobs, pa.binary()),
            pa.array(counts[doc]),
            pa.array(sequence + first),
            pa.array(offset),
        ],
        [f.split()[0] for f in PIECES.split(", ")],
    )
