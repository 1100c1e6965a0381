"""BPE encoding and decoding by tree concatenation.

A text up to ``leaf_chars`` is encoded as it is. A longer one is cut into
halves, again and again, until the parts fit; the parts are encoded in
parallel, as rows of their own, and joined two by two up the tree. At a join
the tokens next to the cut can be wrong. A window around the cut is encoded
anew. On its left it begins at a boundary of the left part so far back that no
match before it can have looked at the cut; a match depends on nothing before
it, so that boundary is one of the whole text and nothing has to be compared
there. On its right it grows until the window's split into pre-tokens and the
right part's own have a boundary in common: from there on both agree, and the
result is exactly that of the whole text. In text without any boundary the
window grows until it holds the whole run.

Null text is encoded as "". Rows may repeat; every row gives one result row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.arrays import releasing, text_chunks
from gaugeline.llm.pretokens import PieceEncoder, Vocabulary, encoder_for, load_vocabulary, split_pieces

LEAF_CHARS = 32_768

# Code points of a window on either side of a cut, at first.
WINDOW_CHARS = 64

SCHEMA = "doc_id long, n_bytes long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary"


@dataclass
class Part:
    """A piece of text with its ids and the code-point ends of its pre-tokens."""

    text: str
    ids: np.ndarray
    ends: np.ndarray  # end of each pre-token, code points
    sizes: np.ndarray  # ids of each pre-token


def encode_part(text: str, encoder: PieceEncoder) -> Part:
    """Encode a text by itself, keeping where its pre-tokens end."""
    pieces = split_pieces([text], encoder.vocabulary.special)
    ids, _ = encoder.encode([text])
    token = encoder.vocabulary.token_bytes
    # Every pre-token is whole in the ids, so byte lengths tell how many ids each has.
    lengths = np.fromiter((len(token[i]) for i in ids.tolist()), np.int64, len(ids))
    at = np.cumsum(lengths)
    special = encoder.vocabulary.special or ""
    texts = pieces.texts(np.arange(len(pieces.starts)))
    owned = [special if s else t for s, t in zip(pieces.special.tolist(), texts)]
    ends = np.cumsum([len(t) for t in owned], dtype=np.int64)
    last = np.searchsorted(at, np.cumsum([len(t.encode()) for t in owned], dtype=np.int64))
    return Part(text, ids, ends, np.diff(last, prepend=-1))


def join_parts(left: Part, right: Part, encoder: PieceEncoder, window: int = WINDOW_CHARS) -> Part:
    """The encoding of ``left.text + right.text``."""
    if not left.text or not right.text:
        return right if not left.text else left
    cut, size = len(left.text), len(right.text)
    special = encoder.vocabulary.special
    reach_left = reach_right = window
    while True:
        # Left: start at a boundary of the left part, which is one of the whole text
        # if the part's matches before it did not look at the part's end. A match looks
        # one code point ahead, a contraction or special token as many as it has.
        guard = cut - (len(special) if special else 3) - 1
        safe = left.ends[left.ends <= min(guard, cut - reach_left)]
        # Only boundaries before the last two pre-tokens: the last may go on after the
        # cut, and the one before it may be white space that gives up its last character.
        safe = safe[: max(0, min(len(safe), len(left.ends) - 3))]
        from_piece = len(safe)
        begin = int(safe[-1]) if from_piece else 0
        stop = min(size, reach_right)
        middle = encode_part(left.text[begin:] + right.text[:stop], encoder)
        ends = middle.ends + begin - cut  # in code points of the right part
        if stop == size:
            agreed, to_piece, keep = True, len(right.ends), len(middle.ends)
        else:
            limit = stop - (len(special) if special else 3) - 1
            trusted = ends[: max(0, len(ends) - 3)]
            shared = np.intersect1d(trusted[(trusted > 0) & (trusted <= limit)], right.ends)
            agreed = len(shared) > 0
            if agreed:
                keep = int(np.searchsorted(ends, shared[0])) + 1
                to_piece = int(np.searchsorted(right.ends, shared[0])) + 1
        if agreed:
            first, kept, rest = (
                int(left.sizes[:from_piece].sum()),
                int(middle.sizes[:keep].sum()),
                int(right.sizes[:to_piece].sum()),
            )
            return Part(
                left.text + right.text,
                np.concatenate([left.ids[:first], middle.ids[:kept], right.ids[rest:]]),
                np.concatenate([left.ends[:from_piece], middle.ends[:keep] + begin, right.ends[to_piece:] + cut]),
                np.concatenate([left.sizes[:from_piece], middle.sizes[:keep], right.sizes[to_piece:]]),
            )
        reach_right *= 2


def halves(text: str, leaf_chars: int) -> list[str]:
    """The leaves of the tree over ``text``, in order."""
    if len(text) <= leaf_chars:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], leaf_chars) + halves(text[middle:], leaf_chars)


def join_tree(parts: list[Part], encoder: PieceEncoder) -> Part:
    """Join the leaves of one text two by two."""
    while len(parts) > 1:
        pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
        parts = [join_parts(*pair, encoder) if len(pair) == 2 else pair[0] for pair in pairs]
    return parts[0]


def decode_ids(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of ``ids``; bytes that are no UTF-8 become U+FFFD, as in the library."""
    token = vocabulary.token_bytes
    return b"".join([token[i] for i in ids.tolist()]).decode("utf-8", "replace")


def _result(ids: np.ndarray, n_bytes: int, vocabulary: Vocabulary, with_ids: bool) -> tuple:
    listed = ids.tolist()
    decimals, token = vocabulary.decimals, vocabulary.token_bytes
    digits = hashlib.sha256(b",".join([decimals[i] for i in listed])).hexdigest()
    text = b"".join([token[i] for i in listed]).decode("utf-8", "replace")
    decoded = hashlib.sha256(text.encode()).hexdigest()
    return n_bytes, len(listed), digits, decoded, ids.astype("<u4").tobytes() if with_ids else None


def _table(doc_ids: list, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 5
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
    arrays = [pa.array(doc_ids, pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))]
    return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in SCHEMA.split(", ")])


def encode_documents(
    docs: DataFrame, tokenizer: str, leaf_chars: int = LEAF_CHARS, with_ids: bool = True
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ids, and digests of ids and decoded text.

    ``ids`` holds little-endian unsigned 32-bit integers. Texts of more than
    ``leaf_chars`` code points travel as leaves, balanced over all tasks, and
    meet again by row; one text's ids have to fit one task, as the text itself
    does. ``tokenizer`` is the path of a file of the tokenizers library, with
    byte-level BPE, on every executor.
    """

    @releasing
    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer)
        for rows, texts in text_chunks(batches):
            ids, counts = encoder.encode(texts)
            parts = np.split(ids, np.cumsum(counts)[:-1])
            yield _table(
                rows.column("doc_id").to_pylist(),
                [_result(p, len(t.encode()), encoder.vocabulary, with_ids) for p, t in zip(parts, texts)],
            )

    @releasing
    def leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_for(tokenizer)
        for frame in frames:
            parts = [encode_part(text, encoder) for text in frame["part"]]
            yield pd.DataFrame(
                {
                    "row": frame["row"],
                    "doc_id": frame["doc_id"],
                    "place": frame["place"],
                    "part": frame["part"],
                    "ids": [p.ids.astype("<u4").tobytes() for p in parts],
                    "ends": [p.ends.astype("<i8").tobytes() for p in parts],
                    "sizes": [p.sizes.astype("<i8").tobytes() for p in parts],
                }
            )

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        encoder = encoder_for(tokenizer)
        frame = frame.sort_values("place")
        parts = [
            Part(t, np.frombuffer(i, "<u4"), np.frombuffer(e, "<i8"), np.frombuffer(s, "<i8"))
            for t, i, e, s in zip(frame["part"], frame["ids"], frame["ends"], frame["sizes"])
        ]
        joined = join_tree(parts, encoder)
        row = _result(joined.ids, len(joined.text.encode()), encoder.vocabulary, with_ids)
        return _table([frame["doc_id"].iloc[0]], [row]).to_pandas()

    load_vocabulary(tokenizer)  # a bad file fails here, not in a task
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    long = F.length("text") > leaf_chars
    direct = docs.filter(~long).mapInArrow(short, SCHEMA)
    cut = F.udf(lambda text: halves(text, leaf_chars), "array<string>")
    parts = (
        docs.filter(long)
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", F.posexplode(cut("text")).alias("place", "part"))
    )
    # A number keeps them apart: by bytes, which leaves have few of, tasks would be merged.
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    encoded = parts.repartition(spread, "row", "place").mapInPandas(
        leaves, "row long, doc_id long, place int, part string, ids binary, ends binary, sizes binary"
    )
    return direct.unionByName(encoded.groupBy("row").applyInPandas(whole, SCHEMA))
