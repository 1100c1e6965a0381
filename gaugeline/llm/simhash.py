"""SimHash near-duplicates, searched in BK-trees.

A document's fingerprint has 64 bits: bit i is set if it is set in over half
of the XXH64 values of its three-word shingles, repeats included. Two
documents are linked if their fingerprints differ in at most ``RADIUS`` bits;
a group is what links connect.

Equal fingerprints are one vertex from the start. The distinct ones are dealt
into shards by pigeonhole: of four blocks of bits, one must be equal in two
fingerprints that differ in three bits at most, so each fingerprint goes to
four shards, one per block and value, and meets every partner in at least one.
A shard whose fingerprints are too many for one tree is dealt again by the bits
it does not share, with the same argument. Each shard is a BK-tree: a child
hangs under the edge numbered with its Hamming distance to the parent, and a
search follows only edges within the radius of the distance at hand. Tasks
build and search many shards at once, with arrays, and return a spanning forest
of the links found instead of all pairs.

Trees meet their queries by shuffle, not by broadcast: a broadcast of all
trees would grow with the corpus.

Vertices are fingerprints, not doc_ids: rows that share a doc_id are in one group
only if links connect their texts. A group's name is the smallest doc_id of its
rows, so two groups may have the same name.

Null and empty text have fingerprint zero, linked like any other. A row with a
null doc_id links like any other but names nothing: a group of such rows alone
has no name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from gaugeline.llm.arrays import releasing
from gaugeline.llm.components import connected_components, forest
from gaugeline.operators.stage import stage

SHINGLE_WORDS = 3
RADIUS = 3
# Fingerprints of a shard above which it is dealt again, while unshared bits last.
SHARD_ROWS = 20_000
# Fingerprints whose trees a task builds together.
TASK_ROWS = 200_000
_FRONTIER = 2_000_000


def text_fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a whole text, unsigned."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        hashes = [digest(joined, 42)]
    else:
        ends, at = [], -1
        for word in words:
            at += len(word) + 1
            ends.append(at)
        starts = [0, *(end + 1 for end in ends)]
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[size - 1 :])]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
@releasing
def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The fingerprint's 64 bits as a long."""
    for texts in batches:
        yield pd.Series(np.array([text_fingerprint(t) for t in texts], np.uint64).view(np.int64))


def hexadecimal(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


class BKForest:
    """BK-trees over runs of equal keys; fingerprints of a run are distinct."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        """``keys`` are sorted; the first value of a run is its tree's root."""
        self.values = values
        self.roots = np.searchsorted(keys, keys)
        node = self.roots.copy()
        left = np.flatnonzero(node != np.arange(len(keys)))
        edges, children = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(left):
            apart = np.bitwise_count(values[left] ^ values[node[left]])
            # An edge is its parent and the distance; the first to ask for it hangs there.
            edge, first, asks = np.unique(node[left] * 65 + apart, return_index=True, return_inverse=True)
            edges.append(edge)
            children.append(left[first])
            node[left] = left[first][asks]
            waits = np.ones(len(left), bool)
            waits[first] = False
            left = left[waits]
        order = np.argsort(edges := np.concatenate(edges))
        self.edges, self.children = edges[order], np.concatenate(children)[order]

    def within(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j), j < i, of one tree that differ in at most ``radius`` bits, in portions."""
        everyone = np.arange(len(self.values))
        for part in np.array_split(everyone, max(1, len(everyone) // 20_000)):
            waiting = [(part, self.roots[part])]
            while waiting:
                query, node = waiting.pop()
                if len(query) > _FRONTIER:
                    half = len(query) // 2
                    waiting += [(query[:half], node[:half]), (query[half:], node[half:])]
                    continue
                apart = np.bitwise_count(self.values[query] ^ self.values[node]).astype(np.int64)
                near = (apart <= radius) & (node < query)
                if near.any():
                    yield query[near], node[near]
                low = np.searchsorted(self.edges, node * 65 + np.maximum(apart - radius, 0), "left")
                high = np.searchsorted(self.edges, node * 65 + np.minimum(apart + radius, 64), "right")
                counts = high - low
                ends = np.cumsum(counts)
                if len(ends) and ends[-1]:
                    at = np.repeat(low - (ends - counts), counts) + np.arange(ends[-1])
                    waiting.append((np.repeat(query, counts), self.children[at]))


@releasing
def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the links in each shard; rows come sorted by shard."""

    def solved(keys: np.ndarray, bits: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
        parent = np.arange(len(keys))
        for a, b in BKForest(keys, bits.view(np.uint64)).within(RADIUS):
            parent = forest(a, b, len(keys), parent)
        moved = np.flatnonzero(parent != np.arange(len(keys)))
        return pa.RecordBatch.from_arrays([pa.array(docs[moved]), pa.array(docs[parent[moved]])], ["u", "v"])

    held: list[np.ndarray] = []
    for rows in batches:
        held.append(np.stack([rows.column(c).to_numpy() for c in ("shard", "bits", "doc")]))
        if sum(h.shape[1] for h in held) >= TASK_ROWS:
            table = np.concatenate(held, axis=1)
            cut = int(np.searchsorted(table[0], table[0, -1]))  # the last shard may go on
            if cut:
                yield solved(*(column.copy() for column in table[:, :cut]))
            held = [table[:, cut:]]
    if held:
        yield solved(*(column.copy() for column in np.concatenate(held, axis=1)))


def _dealt(rows: DataFrame, width: int) -> DataFrame:
    """Rows (shard, rest, ...) dealt into four shards each by blocks of ``rest``'s low bits.

    ``rest`` holds the bits that a shard does not share; what it shares is cut
    out, so ``rest`` gets shorter by a block of ``width / 4`` bits.
    """
    size = width // 4
    last = width - 3 * size
    blocks = []
    for i in range(4):
        bits, low = (last if i == 3 else size), i * size
        value = F.shiftrightunsigned("rest", low).bitwiseAND(F.lit((1 << bits) - 1))
        above = F.shiftleft(F.shiftrightunsigned("rest", low + bits), low) if low + bits < 64 else F.lit(0).cast("long")
        below = F.col("rest").bitwiseAND(F.lit((1 << low) - 1))
        shard = F.shiftleft("shard", 2 + last).bitwiseOR(F.shiftleft(F.lit(i).cast("long"), last)).bitwiseOR(value)
        blocks.append(F.struct(shard.alias("shard"), above.bitwiseOR(below).alias("rest")))
    others = [c for c in rows.columns if c not in ("shard", "rest")]
    dealt = rows.select(*others, F.explode(F.array(*blocks)).alias("b"))
    return dealt.select("b.shard", "b.rest", *others)


def near_links(prints: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (u, v) that connect all pairs of ``prints`` (bits, doc) within the radius.

    ``bits`` are distinct; ``doc`` names them. The links are a forest per shard,
    not all pairs.
    """
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = prints.select(F.lit(1).cast("long").alias("shard"), F.col("bits").alias("rest"), "bits", "doc")
    links = []
    # Unshared bits at each level, and what the widest block takes away.
    for level, width in enumerate((64, 48, 36)):
        rows = stage(_dealt(rows, width), f"shards-{level}")
        large = None
        if level < 2:
            large = rows.groupBy("shard").count().filter(F.col("count") > shard_rows).select("shard")
            large = stage(large, f"large-shards-{level}")
            large = None if large.isEmpty() else large
        now = rows if large is None else rows.join(large, "shard", "left_anti")
        links.append(
            now.select("shard", "bits", "doc")
            .repartition(parts, "shard")
            .sortWithinPartitions("shard")
            .mapInArrow(_links, "u long, v long")
        )
        if large is None:
            break
        rows = rows.join(large, "shard", "left_semi")
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def _groups(marked: DataFrame, shard_rows: int) -> DataFrame:
    """(print_bits, doc, group) of every fingerprint in ``marked`` (doc_id, bits).

    ``doc`` is the smallest doc_id of the fingerprint's rows, ``group`` the
    smallest fingerprint that links reach.
    """
    prints = stage(marked.groupBy("bits").agg(F.min("doc_id").alias("doc")), "distinct-fingerprints")
    vertices = prints.select("bits", F.col("bits").alias("doc"))
    groups = connected_components(near_links(vertices, shard_rows))
    return prints.join(groups, F.col("bits") == F.col("vertex"), "left").select(
        F.col("bits").alias("print_bits"), "doc", F.coalesce("component", "bits").alias("group")
    )


def near_duplicates(docs: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, bits, component_id) of every row of ``docs`` (doc_id, text)."""
    marked = stage(docs.select(F.col("doc_id").cast("long"), fingerprint("text").alias("bits")), "fingerprints")
    groups = stage(_groups(marked, shard_rows), "groups")
    names = stage(groups.groupBy("group").agg(F.min("doc").alias("component_id")), "group-names")
    named = stage(groups.join(names, "group").select("print_bits", "component_id"), "named-fingerprints")
    return marked.join(named, F.col("bits") == F.col("print_bits"), "left").select(
        "doc_id", "bits", "component_id"
    )


def one_of_each(docs: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row of ``docs`` (doc_id, text and any others) for each group.

    It is a row with the group's smallest doc_id; of rows that share it, the
    one whose columns hash lowest, once if rows are equal. Rows without doc_id
    are kept only from groups that have no other rows.
    """
    # Nulls add nothing to a hash, so the text comes first: rows of equal hash have equal texts.
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text" and "map<" not in dict(docs.dtypes)[c]]
    row = F.xxhash64(F.col("text").isNull(), F.col("text"), *others)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row.alias("row"))
    marked = stage(slim.select("doc_id", "row", fingerprint("text").alias("bits")), "marked-rows")
    groups = _groups(marked, shard_rows).select("print_bits", "group")
    in_groups = marked.join(groups, F.col("bits") == F.col("print_bits"), "left")
    chosen = (
        in_groups.groupBy("group")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("m"))
        .select(F.col("m.doc_id").alias("kept_id"), F.col("m.row").alias("kept_row"))
        .distinct()
    )
    repeats = marked.groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("repeats"))

    def same(doc_id: Column, row: Column) -> Column:
        return F.col("kept_id").eqNullSafe(doc_id) & (F.col("kept_row") == row)

    chosen = stage(
        chosen.join(repeats, same(F.col("doc_id"), F.col("row"))).select("kept_id", "kept_row", "repeats"),
        "chosen-rows",
    )
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("doc_id").cast("long").alias("id"),
        row.alias("row"),
    )
    kept = whole.join(chosen, same(F.col("id"), F.col("row")))
    once = kept.filter("repeats = 1").select("doc.*")
    again = kept.filter("repeats > 1").dropDuplicates(["id", "row"]).select("doc.*")
    return once.unionByName(again)
