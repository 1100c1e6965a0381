"""Bounded samples of labelled documents, and the folds that labels are learned from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.operators.stage import stage


def fold(folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; a missing doc_id is in fold -1."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(folds)).cast("int"), F.lit(-1))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int) -> DataFrame:
    """At most ``most`` rows (text, label) of ``docs`` with a label, drawn by a hash of doc_id.

    ``learn`` says which doc_ids labels may be learned from. A document with
    labels that contradict each other has none. The drawn labels are at most
    ``most`` rows of 12 bytes, so they are sent to the documents, not the
    documents to them.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & learn)
        .groupBy(F.col("doc_id").cast("long").alias("labelled_id"))
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("highest"))
        .filter("label = highest")
        .orderBy(F.xxhash64("labelled_id"), "labelled_id")
        .limit(most)
        .select("labelled_id", "label")
    )
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(known), F.col("doc_id") == F.col("labelled_id")
    )
    return found.select("doc_id", "text", "label")


def bounded(sample: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of a staged sample of distinct (text, label), drawn by their hash.

    The draw of labels bounds doc_ids; one of them may stand on any number of rows.
    Only hashes are sorted, so no text leaves its task.
    """
    if sample.count() <= most:
        return sample
    place = F.xxhash64("text", "label")
    last = sample.select(place.alias("_place")).orderBy("_place").limit(most).agg(F.max("_place")).first()[0]
    return stage(sample.filter(place <= last), "bounded-sample")
