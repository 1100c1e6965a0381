"""The stages of the corpus pipeline, in order.

Each takes (spark, docs, folder of the tables) and decides about every row its
predecessor kept. All but the last return the columns of ``docs``, whatever
they are; a stage's own columns have names no table should use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import bpe_codec, decontaminate, quality_model, secret_scan, simhash
from gaugeline.llm.labelled import fold
from gaugeline.llm.queries import labels, tokenizer_path

_OWN = "_gaugeline_stage"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches ``quality_model.KEEP_FROM``."""
    ranking = quality_model.learn_quality(docs, labels(spark, sf_dir), fold(4) != 2)
    score = quality_model.score_column(ranking, F.col("text"))
    return docs.filter(score >= quality_model.KEEP_FROM)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest doc_id's."""
    return simhash.one_of_each(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark passages."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(docs, benchmark, _OWN)
    return found.filter(~F.col(_OWN)["contaminated"]).drop(_OWN)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their text replaced; n_chars follows."""
    found = secret_scan.find_secrets(docs, name=_OWN)
    changed = F.size(_OWN) > 0
    clean = found.withColumn("text", secret_scan.redacted(F.col("text"), F.col(_OWN)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn(
            "n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(kind)
        )
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and decoded text."""
    return bpe_codec.encode_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", keep_distinct),
    ("benchmark_decontamination", keep_uncontaminated),
    ("secret_scans", redact_secrets),
    ("bpe_encoding_decoding", encode),
]
