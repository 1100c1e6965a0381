"""Token counts without ids: each distinct pre-token is counted once.

1. Tasks split texts into pre-tokens, a batch of texts at a time. A batch keeps
   its distinct pre-tokens, dealt into buckets by hash, and per document the
   numbers of these pre-tokens with their frequencies.
2. The distinct pre-tokens of all batches meet by bucket; a bucket's task
   counts the pieces of each distinct pre-token once and answers every batch.
3. Answers meet their batch by its id, and frequencies times counts are summed.

Rows between tasks are batches and buckets packed as bytes, so a frequent
pre-token costs one entry per batch, never one per occurrence, and no group
grows with a hot word. The first step is staged, as both later ones read it.

Null text counts as "". Every input row gives one result row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.arrays import packed, releasing, squeezed, text_chunks, unpacked, unsqueezed
from gaugeline.llm.pretokens import CACHED_PIECES, encoder_for, load_vocabulary, split_pieces
from gaugeline.operators.stage import stage

# Code points whose pre-tokens share one dictionary.
BATCH_CHARS = 12_000_000

_BATCHES = "batch string, bucket int, pieces binary, doc_ids binary, freqs binary"


class _Batch:
    """Distinct pre-tokens and document frequencies of some texts."""

    def __init__(self) -> None:
        self.doc_ids: list[int | None] = []
        self.n_bytes: list[int] = []
        self.known = np.empty(0, np.uint64)
        self.texts = np.empty(0, object)
        self.pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.specials: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_ids: list, texts: list[str], special: str | None) -> None:
        pieces = split_pieces(texts, special)
        ordinary = np.flatnonzero(~pieces.special)
        hashes = pieces.hashes[ordinary]
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        fresh = ~np.isin(distinct, self.known, assume_unique=True)
        at = np.searchsorted(self.known, distinct[fresh])
        self.known = np.insert(self.known, at, distinct[fresh])
        found = np.empty(int(fresh.sum()), object)
        found[:] = pieces.texts(ordinary[first[fresh]])
        self.texts = np.insert(self.texts, at, found)
        width = max(1, len(distinct))
        pair, times = np.unique(pieces.rows[ordinary] * width + inverse, return_counts=True)
        self.pairs.append((pair // width + len(self.doc_ids), distinct[pair % width], times))
        self.specials.append(np.bincount(pieces.rows[pieces.special], minlength=len(texts)))
        self.doc_ids += doc_ids
        self.n_bytes += [len(text.encode()) for text in texts]
        self.chars += sum(map(len, texts))

    def rows(self, buckets: int) -> Iterator[tuple]:
        """One row of frequencies and one per bucket that has pre-tokens."""
        name = uuid.uuid4().hex
        bucket = (self.known % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        docs, hashes, times = (
            (np.concatenate(x) for x in zip(*self.pairs)) if self.pairs else (np.empty(0, np.int64),) * 3
        )
        number = place[np.searchsorted(self.known, hashes.astype(np.uint64))]
        order_pairs = np.lexsort((number, docs))
        docs, number, times = docs[order_pairs], number[order_pairs], times[order_pairs]
        first = np.ones(len(docs), bool)
        first[1:] = docs[1:] != docs[:-1]
        steps = np.where(first, number, np.diff(number, prepend=0))
        blobs = [
            packed(np.bincount(docs, minlength=len(self.doc_ids))),
            packed(steps),
            packed(times),
            packed(np.array(self.n_bytes, np.int64)),
            packed(np.concatenate(self.specials)),
        ]
        sizes = np.array([len(b) for b in blobs], "<u8").tobytes()
        yield name, None, None, _packed_ids(self.doc_ids), sizes + b"".join(blobs)
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in range(buckets):
            mine = self.texts[order[bounds[b] : bounds[b + 1]]]
            if len(mine):
                lengths = np.fromiter((len(t.encode()) for t in mine), np.int64, len(mine))
                body = squeezed("".join(mine).encode())
                sized = packed(lengths)
                yield name, b, len(sized).to_bytes(8, "little") + sized + body, None, None


def _packed_ids(doc_ids: list[int | None]) -> bytes:
    """Document ids with nulls, as an Arrow stream."""
    batch = pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64())], ["doc_id"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked_pieces(blob: bytes) -> list[bytes]:
    size = int.from_bytes(blob[:8], "little")
    ends = np.cumsum(unpacked(blob[8 : 8 + size])).astype(np.int64)
    body = unsqueezed(blob[8 + size :])
    return [body[a:b] for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())]


def count_tokens(
    docs: DataFrame, tokenizer: str, buckets: int | None = None, batch_chars: int = BATCH_CHARS
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` (doc_id, text).

    ``buckets`` defaults to the session's shuffle partitions. A bucket's task
    remembers the counts of at most ``CACHED_PIECES`` pre-tokens at a time.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    special = load_vocabulary(tokenizer).special

    @releasing
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _BATCHES.split(", ")]
        kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary())

        def table(batch: _Batch) -> pa.RecordBatch:
            columns = zip(*batch.rows(buckets))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        batch = _Batch()
        for rows, texts in text_chunks(batches):
            batch.add(rows.column("doc_id").to_pylist(), texts, special)
            if batch.chars >= batch_chars:
                yield table(batch)
                batch = _Batch()
        if batch.doc_ids:
            yield table(batch)

    @releasing
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_for(tokenizer).vocabulary.coder.encode_ordinary
        known: dict[bytes, int] = {}
        for rows in batches:
            for batch, bucket, blob in zip(*(rows.column(i).to_pylist() for i in range(3))):
                if len(known) > CACHED_PIECES:
                    known.clear()
                counts = []
                for piece in _unpacked_pieces(blob):
                    n = known.get(piece)
                    if n is None:
                        n = known[piece] = len(encode(piece.decode()))
                    counts.append(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch]), pa.array([bucket], pa.int32()), pa.array([packed(np.array(counts))])],
                    ["batch", "bucket", "counts"],
                )

    @releasing
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for ids, blob, answers in zip(*(rows.column(i).to_pylist() for i in range(3))):
                ordered = sorted(answers or [], key=lambda a: a["bucket"])
                counts = [unpacked(a["counts"]) for a in ordered]
                pieces = np.concatenate(counts).astype(np.int64) if counts else np.empty(0, np.int64)
                ends = np.cumsum(np.frombuffer(blob[:40], "<u8")).astype(np.int64) + 40
                parts = [blob[a:b] for a, b in zip([40, *ends[:-1]], ends)]
                per_doc, steps, times, n_bytes, specials = (unpacked(p).astype(np.int64) for p in parts)
                stops = np.cumsum(per_doc)
                # Steps restart at each document: undo one long cumulative sum.
                run = np.cumsum(steps)
                before = np.repeat(np.append(0, run)[stops - per_doc], per_doc)
                weights = pieces[run - before] * times
                sums = np.append(0, np.cumsum(weights))
                with pa.ipc.open_stream(ids) as reader:
                    doc_ids = reader.read_all().column(0).combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids,
                        pa.array(n_bytes),
                        pa.array(sums[stops] - sums[stops - per_doc] + specials),
                    ],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    docs = docs.select(F.col("doc_id").cast("long"), "text")
    batches = stage(docs.mapInArrow(split, _BATCHES), "pretokens")
    answers = (
        batches.filter("bucket IS NOT NULL")
        .select("batch", "bucket", "pieces")
        .repartition(buckets, "bucket")
        .mapInArrow(count, "batch string, bucket int, counts binary")
        .groupBy("batch")
        .agg(F.collect_list(F.struct("bucket", "counts")).alias("answers"))
    )
    freqs = batches.filter("bucket IS NULL").select("batch", "doc_ids", "freqs")
    return (
        freqs.join(answers, "batch", "left")
        .select("doc_ids", "freqs", "answers")
        .mapInArrow(total, "doc_id long, n_bytes long, n_tokens long")
    )
