"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements
and a long whose bit i says that rule i failed; later steps never touch the
text again. A policy is a versioned set of rules, a mask: a document passes if
``failures & mask`` is zero. What a policy would do without one of its rules
is a bitwise aggregation over the few distinct values of ``failures``.

Words are runs of anything but ASCII white space. Windows of three words are
compared within a document by a 64-bit hash of the three. Nothing is shuffled:
a document is one row from scan to ledger. Null text is "", which has no words;
every input row gives one ledger row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"

# The rules by bit: name and the condition under which a document fails.
RULES: list[tuple[str, Callable[[], Column]]] = [
    ("few_words", lambda: F.col("n_words") < 50),
    ("repeated_windows", lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    ("many_symbols", lambda: 5 * F.col("n_symbols") > F.col("n_words")),
    ("duplicate_lines", lambda: 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
    ("short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    ("long_words", lambda: F.col("word_chars") > 25 * F.col("n_words")),
]

# Versioned policies; a version never changes once it is used.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "many_symbols", "duplicate_lines", "short_words", "long_words"),
}


def policy_mask(policy: str) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(rule) for rule in POLICIES[policy])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in ``words``."""

    def windows(ws: Column) -> Column:
        numbered = F.transform(
            F.sequence(F.lit(0), F.size(ws) - 3),
            lambda i: F.struct(F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("h"), i.alias("i")),
        )
        return F.sort_array(numbered)

    def twice(sorted_windows: Column) -> Column:
        def has_equal(x: Column, k: Column) -> Column:
            before, after = F.get(sorted_windows, k - 1)["h"], F.get(sorted_windows, k + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(sorted_windows, has_equal), lambda x: x["i"]))

    def covered(places: Column) -> Column:
        return _total(
            F.transform(
                places,
                lambda x, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - x, F.lit(3))).cast("long"),
            )
        )

    counted = let(let(let(words, windows), twice), covered)
    return F.when(F.size(words) >= 4, counted).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of each row."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(_WORD))
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))

    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            _total(F.transform(ws, lambda w: F.length(w).cast("long"))).alias("word_chars"),
            repeat_words(ws).alias("n_repeat_words"),
        )

    def of_lines(ls: Column) -> Column:
        return F.struct(
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        )

    measured = docs.select(
        F.col("doc_id"),
        let(words, of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        symbols.cast("long").alias("n_symbols"),
    )
    return measured.select(
        "doc_id", "w.n_words", "w.word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines", "w.n_repeat_words"
    )


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and failure bits of ``docs`` (doc_id, text)."""
    bits = [F.when(failed(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, failed) in enumerate(RULES)]
    return measure(docs).withColumn("failures", reduce(lambda a, b: a.bitwiseOR(b), bits))


def passes(policy: str, failures: str = "failures") -> Column:
    """Whether a ledger row passes ``policy``."""
    return F.col(failures).bitwiseAND(F.lit(policy_mask(policy))) == 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """What each rule of ``policy`` does to a ledger: one row per rule.

    failed: documents the rule fails; only_it: those that no other rule of the
    policy fails, which dropping the rule would bring back; kept: documents the
    whole policy keeps.
    """
    mask = policy_mask(policy)
    masks = rows.groupBy("failures").agg(F.count(F.lit(1)).alias("rows"))
    bits = [(name, 1 << i) for i, (name, _) in enumerate(RULES) if name in POLICIES[policy]]
    rules = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in bits]))
    each = masks.withColumn("r", rules).select("failures", "rows", "r.rule", "r.bit")
    inside = F.col("failures").bitwiseAND(F.lit(mask))

    def where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("rows")).otherwise(F.lit(0))).cast("long")

    return each.groupBy("rule").agg(
        where(F.col("failures").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        where(inside == F.col("bit")).alias("only_it"),
        where(inside == 0).alias("kept"),
    )
