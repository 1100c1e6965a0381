"""The operators on whole given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import (
    bpe_codec,
    conversation_repair,
    decontaminate,
    kneser_ney,
    packing,
    periodic_runs,
    quality_model,
    quality_rules,
    secret_scan,
    simhash,
    token_counts,
    token_files,
    toxicity,
)
from gaugeline.llm.labelled import fold
from gaugeline.operators.skew import null_safe_join

# Tokens a context holds.
CONTEXT_TOKENS = 1024


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base_failed = ~quality_rules.passes("base")
    return quality_rules.ledger(documents(spark, sf_dir)).select(
        "*", base_failed.alias("base_failed"), quality_rules.passes("v1").alias("kept")
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(documents(spark, sf_dir), tokenizer_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_codec.encode_documents(documents(spark, sf_dir), tokenizer_path(), with_ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.learn_toxicity(docs, labels(spark, sf_dir), fold(3) != 1)
    scored = docs.withColumn("held_out", fold(3) == 1).withColumn(
        "score", toxicity.score_column(model, F.col("text"))
    )
    predicted = (F.col("score") >= toxicity.TOXIC_FROM).cast("int")
    return scored.select("doc_id", "held_out", "score", predicted.alias("predicted"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(documents(spark, sf_dir), name="found")
    spans = F.col("found")

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*secret_scan.BASE))
    return found.select(
        "doc_id",
        *map(number, secret_scan.BASE),
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"),
        secret_scan.written(spans).alias("spans"),
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(documents(spark, sf_dir), benchmark, "found")
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"),
        "found.contaminated",
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(documents(spark, sf_dir), tokenizer_path())
    return token_files.read_token_files(manifest)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hexadecimal(F.col("bits")).alias("fingerprint"), "component_id")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    ranking = quality_model.learn_quality(docs, labels(spark, sf_dir), fold(4) != 2)
    scored = docs.withColumn("held_out", fold(4) == 2).withColumn(
        "score", quality_model.score_column(ranking, F.col("text"))
    )
    predicted = (F.col("score") >= quality_model.KEEP_FROM).cast("int")
    return scored.select("doc_id", "held_out", "score", predicted.alias("predicted"))


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = kneser_ney.learn(docs.filter(fold(10) != 0))
    return kneser_ney.score_documents(docs, model, fold(10) == 0)


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` with one text in ten made periodic from some word on, by the checksum of its doc_id.

    Rows without doc_id are left alone.
    """
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(crc / 10)

    def repeated(ws: Column) -> Column:
        n = F.size(ws).cast("long")

        def from_places(a: Column, p: Column) -> Column:
            places = F.sequence(F.lit(0).cast("long"), n - 1)
            source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
            return F.array_join(F.transform(places, lambda i: F.get(ws, source(i).cast("int"))), " ")

        return quality_rules.let(
            g % n, lambda a: from_places(a, 1 + F.floor((n - a) / (3 + g % 8)))
        )

    picked = (crc % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    made = quality_rules.let(words(F.col("text")), repeated)
    return docs.withColumn("text", F.when(picked, made).otherwise(F.col("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_periods(documents(spark, sf_dir)))
    runs = F.col("periodic.runs")
    largest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    written = F.concat(F.array_join(line, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))
    start, length, period = -largest["col2"], largest["length"], -largest["col3"]
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(written, 256).alias("runs_sha256"),
        F.sha2(F.col("periodic.collapsed"), 256).alias("collapsed_sha256"),
    )


# Tokens of a packed sequence.
WINDOW_TOKENS = 2048


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(documents(spark, sf_dir), tokenizer_path(), WINDOW_TOKENS, end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with faults by the checksum of conv_id and turn; nulls are one space there."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20
    text = spaced("text")
    return (
        turns.filter(fault != 0)
        .withColumn("_times", F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            "conv_id",
            "turn",
            F.when(fault == 4, "user").otherwise(spaced("role")).alias("role"),
            F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        )
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = conversation_repair.repair_summary(damaged(turns))
    every = null_safe_join(turns.select("conv_id").distinct(), found, ["conv_id"], "left")
    zeros = {name: 0 for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    none = F.sha2(F.lit(""), 256)
    return every.fillna(zeros | {"audit": ""}).withColumn(
        "repaired_sha256", F.coalesce("repaired_sha256", none)
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_counts": op2_token_counts,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_toxicity": op4_toxicity,
    "op5_secret_scan": op5_secret_scan,
    "op6_decontaminate": op6_decontaminate,
    "op7_token_files": op7_token_files,
    "op8_simhash": op8_simhash,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_kneser_ney": op10_kneser_ney,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_packing": op12_packing,
    "op13_conversation_repair": op13_conversation_repair,
}
