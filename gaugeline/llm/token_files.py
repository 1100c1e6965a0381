"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of whole documents, in ascending order of their ids, as

    header     8 bytes   b"GLPFOR1\\0"
    blocks     each: packed values, then exception positions and values
    block index          for each block: offset, minimum, width, exceptions (16 bytes)
    document index       doc_id, first id, number of ids (24 bytes each)
    footer     40 bytes  blocks, documents, ids, offsets of the two indexes

All numbers are little-endian. A block holds ``BLOCK_IDS`` ids (the last one
of a file fewer): the block's minimum is subtracted, and what is left is packed
bit after bit at the width that ``WIDTH_PERCENTILE`` per cent of the values fit
in. The others are exceptions: their low bits are packed like the rest, and
their position and whole value are stored after the block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.llm.arrays import releasing, text_chunks
from gaugeline.llm.pretokens import encoder_for, load_vocabulary
from gaugeline.llm.shared_files import mapped_file, write_file
from gaugeline.operators.stage import stage, stage_path

BLOCK_IDS = 4096
WIDTH_PERCENTILE = 95
# Ids in one file; a longer document has a file of its own.
FILE_IDS = 4_000_000

# Stands for a missing doc_id.
NO_DOC_ID = -(1 << 63)

_MAGIC = b"GLPFOR1\0"
_BLOCK = np.dtype([("offset", "<u8"), ("minimum", "<u4"), ("width", "u1"), ("pad", "u1"), ("exceptions", "<u2")])
_DOC = np.dtype([("doc_id", "<i8"), ("first", "<u8"), ("count", "<u8")])


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, one after the other."""
    if width == 0:
        return b""
    raw = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :width], bitorder="little").tobytes()


def unpack_bits(blob: np.ndarray, width: int, count: int) -> np.ndarray:
    """``count`` values of ``width`` bits each."""
    if width == 0:
        return np.zeros(count, np.uint32)
    bits = np.zeros((count, 32), np.uint8)
    bits[:, :width] = np.unpackbits(blob, count=count * width, bitorder="little").reshape(count, width)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(-1)


def file_image(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of a file with these documents."""
    parts, index, offset = [_MAGIC], np.zeros(-(-len(ids) // BLOCK_IDS), _BLOCK), len(_MAGIC)
    for b in range(len(index)):
        block = ids[b * BLOCK_IDS : (b + 1) * BLOCK_IDS]
        low = int(block.min())
        rest = block - np.uint32(low)
        fits = int(np.partition(rest, k := (len(rest) - 1) * WIDTH_PERCENTILE // 100)[k])
        width = fits.bit_length()
        odd = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
        index[b] = (offset, low, width, 0, len(odd))
        body = pack_bits(rest, width) + odd.astype("<u2").tobytes() + rest[odd].astype("<u4").tobytes()
        parts.append(body)
        offset += len(body)
    docs = np.zeros(len(doc_ids), _DOC)
    docs["doc_id"], docs["count"], docs["first"] = doc_ids, counts, np.cumsum(counts) - counts
    at = offset + index.nbytes
    footer = np.array([len(index), len(docs), len(ids), offset, at], "<u8")
    return b"".join([*parts, index.tobytes(), docs.tobytes(), footer.tobytes()])


def read_blocks(image: np.ndarray, first: int, last: int) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` (exclusive), found by the block index."""
    blocks, _, total, at, _ = np.frombuffer(image[-40:].tobytes(), "<u8").tolist()
    index = np.frombuffer(image[at : at + blocks * _BLOCK.itemsize].tobytes(), _BLOCK)
    out = []
    for b in range(first, last):
        offset, low, width, _, odd = index[b].tolist()
        count = min(BLOCK_IDS, total - b * BLOCK_IDS)
        size = -(-count * width // 8)
        values = unpack_bits(image[offset : offset + size], width, count)
        if odd:
            tail = image[offset + size : offset + size + 6 * odd].tobytes()
            places = np.frombuffer(tail[: 2 * odd], "<u2")
            values = values.copy()
            values[places] = np.frombuffer(tail[2 * odd :], "<u4")
        out.append(values + np.uint32(low))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def read_documents(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document index, all ids) of a file."""
    if image[:8].tobytes() != _MAGIC:
        raise ValueError("not a token file")
    blocks, docs, _, _, at = np.frombuffer(image[-40:].tobytes(), "<u8").tolist()
    index = np.frombuffer(image[at : at + docs * _DOC.itemsize].tobytes(), _DOC)
    return index, read_blocks(image, 0, blocks)


def read_document(image: np.ndarray, doc_id: int) -> np.ndarray:
    """The ids of one document: only the blocks that hold them are unpacked."""
    _, docs, _, _, at = np.frombuffer(image[-40:].tobytes(), "<u8").tolist()
    index = np.frombuffer(image[at : at + docs * _DOC.itemsize].tobytes(), _DOC)
    place = int(np.searchsorted(index["doc_id"], doc_id))
    if place == len(index) or index["doc_id"][place] != doc_id:
        return np.empty(0, np.uint32)
    first, count = int(index["first"][place]), int(index["count"][place])
    block = first // BLOCK_IDS
    ids = read_blocks(image, block, -(-(first + count) // BLOCK_IDS))
    return ids[first - block * BLOCK_IDS :][:count]


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None, files: int | None = None
) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text), each text followed by ``end_id``.

    Null text is "", a row without doc_id is filed under the smallest long.
    Documents with the same doc_id keep an order of their own, by number of ids
    and checksum. Ids go through one range shuffle, packed as 16 bits where they
    fit; bounds come from the doc_id column alone, so nothing is encoded twice.
    Returns the manifest, already written: part, place, uri, n_docs, n_ids; file
    order is (part, place). ``files`` is the number of ranges, by default the
    session's shuffle partitions.
    """
    spark = docs.sparkSession
    folder = folder or stage_path(spark, "token-files")
    ranges = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    vocabulary = load_vocabulary(tokenizer)
    small = len(vocabulary.token_bytes) <= 1 << 16 and end_id < 1 << 16
    width = "<u2" if small else "<u4"

    @releasing
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer)
        for rows, texts in text_chunks(batches):
            ids, counts = encoder.encode(texts)
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id).astype(width)
            raw = ids.tobytes()
            stops = (ends + np.arange(1, len(ends) + 1)) * ids.itemsize
            offsets = pa.py_buffer(np.append(0, stops).astype("<i4").tobytes())
            blobs = pa.Array.from_buffers(pa.binary(), len(stops), [None, offsets, pa.py_buffer(raw)])
            part = np.searchsorted(bounds, rows.column("doc_id").to_numpy(), "left").astype(np.int32)
            checks = [zlib.crc32(raw[a:b]) for a, b in zip(np.append(0, stops[:-1]).tolist(), stops.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), rows.column("doc_id"), pa.array(checks, pa.int64()), blobs],
                ["part", "doc_id", "check", "ids"],
            )

    @releasing
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "place", "uri", "n_docs", "n_ids"]
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        part, place, held, size = None, 0, [], 0

        def flush() -> pa.RecordBatch:
            counts = np.array([len(b) for _, b in held], np.int64) // np.dtype(width).itemsize
            ids = np.frombuffer(b"".join(b for _, b in held), width).astype(np.uint32)
            uri = write_file(folder, "pfor", file_image(np.array([d for d, _ in held], np.int64), counts, ids))
            row = ([part], [place], [uri], [len(counts)], [len(ids)])
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names)

        for rows in batches:
            for p, doc_id, blob in zip(*(rows.column(c).to_pylist() for c in ("part", "doc_id", "ids"))):
                count = len(blob) // np.dtype(width).itemsize
                if held and (p != part or size + count > FILE_IDS):
                    yield flush()
                    place, held, size = (place + 1 if p == part else 0), [], 0
                elif p != part:
                    place = 0
                part = p
                held.append((doc_id, blob))
                size += count
        if held:
            yield flush()

    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_DOC_ID)).alias("doc_id"), "text")
    at = [i / ranges for i in range(1, ranges)]
    found = docs.select(F.percentile_approx("doc_id", at, 100 * ranges)).first()[0] if at else None
    bounds = np.array(sorted(set(found or [])), np.int64)
    encoded = docs.mapInArrow(encode, "part int, doc_id long, check long, ids binary")
    dealt = encoded.repartition(ranges, "part").sortWithinPartitions(
        "part", "doc_id", F.length("ids"), "check"
    )
    return stage(
        dealt.select("part", "doc_id", "ids").mapInArrow(
            write, "part int, place int, uri string, n_docs long, n_ids long"
        ),
        "token-manifest",
    )


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. Files are read where
    their row of the manifest is; only the manifest is summed up in one place.
    """
    order = Window.orderBy("part", "place").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select(
        "uri", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).cast("long").alias("base")
    )

    @releasing
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for uri, base in zip(rows.column("uri").to_pylist(), rows.column("base").to_pylist()):
                index, ids = read_documents(mapped_file(uri))
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                ends = (index["first"] + index["count"]).tolist()
                spans = zip(index["first"].tolist(), ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(index["doc_id"], mask=index["doc_id"] == NO_DOC_ID),
                        pa.array(index["first"].astype(np.int64) + base),
                        pa.array(index["count"].astype(np.int64)),
                        pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in spans], pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return based.repartition(spread, "uri").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
