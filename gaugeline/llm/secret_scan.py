"""Secrets in texts, found through an inverted index of trigrams; DataFrame functions only.

Each rule's regular expression gives a Boolean query of trigrams that every
match must contain. The index lists, per trigram and block of documents, the
documents that have it; only trigrams that some rule asks for are listed. Within
a block the lists are intersected and united as the query says, and the
expression then runs on the candidates alone. A rule without mandatory
trigrams scans every text.

Blocks are dealt by a hash of the whole row and hold a bounded number of
documents, so a trigram that every text has makes many short lists. Candidates
come back to their documents by that hash; two rows that share it are at worst
verified for nothing. The text is not shuffled while the candidates are few
enough for Spark to broadcast them, which their written size decides.

Null text is "". Positions are code points, ends exclusive. Every input row
gives one result row, repeated rows too.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.quality_rules import let
from gaugeline.llm.trigrams import Query, trigram_query, trigrams_of
from gaugeline.operators.stage import stage

# Documents of one block of the index, about.
BLOCK_DOCS = 8192


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches whose ``group`` has under ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The first three are the base rules; fixed patterns of public key formats follow.
RULES = [
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("hub", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]
BASE = ("assign", "access", "hex")


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def build_index(docs: DataFrame, trigrams: list[str], block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Postings (block, trigram, rows): ``rows`` are hashes of the documents with ``trigram``.

    Written to the shared folder. ``trigram`` is a number in ``trigrams``.
    """
    blocks = -(-docs.count() // block_docs) or 1
    lower = F.lower(F.col("text"))
    present = let(
        lower,
        lambda low: F.filter(
            F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]),
            lambda number: number.isNotNull(),
        ),
    )
    listed = docs.select(_row_key().alias("row"), F.explode(present).alias("trigram"))
    postings = (
        listed.withColumn("block", F.pmod("row", F.lit(blocks)))
        .groupBy("block", "trigram")
        .agg(F.collect_set("row").alias("rows"))
    )
    return stage(postings, "postings")


def candidates(index: DataFrame, queries: dict[int, Query], trigrams: list[str]) -> DataFrame:
    """(row, rules): the rules, as bits, whose query the index answers with ``row``."""
    none = F.array().cast("array<bigint>")

    def rows_of(lists: Column, query: Query) -> Column:
        if isinstance(query, str):
            return F.coalesce(lists[F.lit(trigrams.index(query))], none)
        parts = [rows_of(lists, part) for part in query[1]]
        return reduce(F.array_intersect if query[0] == "and" else F.array_union, parts)

    def marked(rows: Column, rule: int) -> Column:
        bit = F.lit(1 << rule).cast("long").alias("bit")
        return F.transform(rows, lambda row: F.struct(row.alias("row"), bit))

    def found(lists: Column) -> Column:
        return F.concat(*[marked(rows_of(lists, query), rule) for rule, query in queries.items()])

    by_block = index.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("trigram", "rows"))).alias("lists")
    )
    each = by_block.select(F.explode(let(F.col("lists"), found)).alias("c"))
    return stage(each.groupBy("c.row").agg(F.bit_or("c.bit").alias("rules")), "candidates")


def rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """Matches of ``rule`` as an array of (start, number, end), in order."""
    pattern = F.lit(rule.pattern)
    none = F.array().cast("array<struct<start:bigint,number:int,end:bigint>>")
    held = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    sizes = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), lambda gap: F.length(gap)).alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.length(m)).alias("size"),
        F.transform(held, lambda m: F.length(m)).alias("held"),
    )
    walked = F.aggregate(
        F.filter(sizes, lambda x: x["size"].isNotNull()),
        F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")),
        lambda done, x: F.struct(
            (done["at"] + x["gap"] + x["size"]).alias("at"),
            F.when(
                x["held"] >= rule.least,
                F.concat(
                    done["spans"],
                    F.array(
                        F.struct(
                            (done["at"] + x["gap"]).alias("start"),
                            F.lit(number).alias("number"),
                            (done["at"] + x["gap"] + x["size"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(done["spans"])
            .alias("spans"),
        ),
    )
    return F.when(text.rlike(rule.pattern), walked["spans"]).otherwise(none)


def find_secrets(docs: DataFrame, rules: list[Rule] | None = None, name: str = "secrets") -> DataFrame:
    """``docs`` (doc_id, text and any others) with an array column ``name``.

    Its elements are (start, number, end, kind), sorted by start and then by
    the rule's place in ``rules``.
    """
    rules = rules or RULES
    queries = {i: q for i, rule in enumerate(rules) if (q := trigram_query(rule.pattern)) is not True}
    trigrams = sorted(set().union(*map(trigrams_of, queries.values())))
    index = build_index(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), trigrams)
    wanted = candidates(index, queries, trigrams)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(row, text.alias("text"), F.xxhash64("doc_id", text).alias("key"))
    joined = keyed.join(wanted, F.col("key") == F.col("row"), "left")
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    none = F.array().cast("array<struct<start:bigint,number:int,end:bigint>>")

    def spans(i: int, rule: Rule) -> Column:
        found = rule_spans(F.col("text"), rule, i)
        if i not in queries:
            return found
        asked = F.coalesce(F.col("rules"), F.lit(0).cast("long")).bitwiseAND(F.lit(1 << i).cast("long")) != 0
        return F.when(asked, found).otherwise(none)

    everything = F.sort_array(F.concat(*[spans(i, rule) for i, rule in enumerate(rules)]))
    named = F.transform(
        everything,
        lambda s: F.struct(s["start"].alias("start"), s["number"].alias("number"), s["end"].alias("end"), kinds[s["number"]].alias("kind")),
    )
    return joined.select("doc", named.alias("found")).select("doc.*", F.col("found").alias(name))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each run of overlapping spans replaced by ``[SECRET]``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(s["start"] >= done["at"], F.concat(done["out"], gap, F.lit("[SECRET]")))
            .otherwise(done["out"])
            .alias("out"),
        )

    walked = F.aggregate(spans, start, step)
    whole = let(walked, lambda w: F.concat(w["out"], F.substring(text, (w["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
