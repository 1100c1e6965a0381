"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.arrays import releasing
from gaugeline.operators.stage import stage

# Links a task joins into trees at once.
TASK_LINKS = 2_000_000


def forest(a: np.ndarray, b: np.ndarray, n: int, parent: np.ndarray | None = None) -> np.ndarray:
    """Roots of ``n`` vertices after linking ``a[i]`` with ``b[i]``; a root is its tree's smallest."""
    parent = np.arange(n) if parent is None else parent
    while len(a):
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        if not open_.any():
            return parent
        a, b = a[open_], b[open_]
        high, low = np.maximum(ra, rb)[open_], np.minimum(ra, rb)[open_]
        np.minimum.at(parent, high, low)
        while not np.array_equal(above := parent[parent], parent):
            parent = above
    return parent


@releasing
def _local_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links as stars within bounded parts of a partition; connectivity stays the same."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def trees() -> pa.RecordBatch:
        u, v = (np.concatenate(x) for x in zip(*held))
        names, number = np.unique(np.concatenate([u, v]), return_inverse=True)
        roots = forest(number[: len(u)], number[len(u) :], len(names))
        moved = np.flatnonzero(roots != np.arange(len(names)))
        return pa.RecordBatch.from_arrays(
            [pa.array(names[moved]), pa.array(names[roots[moved]])], ["u", "v"]
        )

    for rows in batches:
        held.append((rows.column("u").to_numpy(), rows.column("v").to_numpy()))
        if sum(len(u) for u, _ in held) >= TASK_LINKS:
            yield trees()
            held = []
    if held:
        yield trees()


def connected_components(links: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex in ``links`` (u, v longs, no nulls).

    ``component`` is the smallest vertex reachable. Large-star and small-star
    steps alternate until every vertex points at its component; the links are
    written to the shared folder after each round, so a lost executor costs
    one round at most. Before the first round tasks replace their own links by trees,
    which keeps a dense group from travelling link by link. Neighbours are
    reduced to their smallest before they are joined back, and a vertex with
    very many neighbours is a skewed join key, which Spark splits.
    """
    spark = links.sparkSession
    schema = "u long, v long"
    edges = stage(links.select("u", "v").filter("u != v").mapInArrow(_local_trees, schema), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        pairs = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(
            pairs.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star"
        )
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    whole = edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    return whole.union(edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
