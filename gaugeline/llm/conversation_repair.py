"""Cheapest repairs of conversations, by weighted CYK parsing over intervals of turns.

A repaired conversation is an optional system turn and then pairs of a user
and an assistant turn, ``(s?(ua)+)?`` by the first letters of the roles. Edits
and their costs: Keep 0, Rerole to user or assistant 1, Delete 2, Insert an
empty user or assistant turn 5; a truncated turn that stays costs 5 more; blank
and repeated turns have to go.

The grammar is in Chomsky normal form. Its nonterminals X(p, q) stand for the
turns that lead from p to q, where p and q say what came last (nothing, system,
user, assistant):

    X(p, q) -> X(p, r) X(r, q)          for every r
    X(p, q) -> one turn, edited         closed under insertion on both sides

A cell holds, for each nonterminal that derives a span of turns, the smallest
(cost, audit); the audit is the initials of the edits. Cells of a block of
``BLOCK_TURNS`` turns are filled over all its spans, shortest first, from all
splits. Two spans side by side have all their derivations in the rules above, so
longer spans, of doubling length, need one split each. Within a cell no audit
of equal cost begins another one (the longer would pay for more insertions), so
the smallest audit of a span is made of smallest audits of its parts.

Conversations of at most ``HOT_TURNS`` turns are repaired in a sorted pass, one
after the other. Longer ones are cut into segments of ``SEGMENT_TURNS``: these
are parsed in parallel, their cells meet ``FAN`` at a time, and the edits found
go back to the segments. Only the audit of a conversation, which is one value,
and its digest, which is one hash over all its text, pass through one task.

Null roles and texts are one space; a null turn comes first; rows of one turn
are ordered by role and text. Rows without conv_id are a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.arrays import releasing
from gaugeline.operators.ordering import rank_hot
from gaugeline.operators.skew import null_safe_join, split_hot
from gaugeline.operators.stage import stage

# The costs of edits, and of a truncated turn that stays.
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_COST = 5

BLOCK_TURNS = 8
# Turns of one conversation that one task repairs.
HOT_TURNS = 20_000
SEGMENT_TURNS = 4_096
FAN = 32
# Cells of spans that a worker remembers before it starts afresh.
CACHED_SPANS = 200_000

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# What a turn by this role leads to, from what came last.
_STEPS = {
    "s": [(NOTHING, SYSTEM)],
    "u": [(NOTHING, USER), (SYSTEM, USER), (ASSISTANT, USER)],
    "a": [(USER, ASSISTANT)],
}
_LEGAL = ("su", "ua", "au")
_BLANKS = " \t\n\x0b\x0c\r"
_LONG = (1 << 63) - 1

# {(p, q): (cost, audit)}
Cell = dict[tuple[int, int], tuple[int, str]]

SUMMARY = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)
TURNS = "conv_id long, segment long, place long, edit string, role string, text string"


def _closures() -> Cell:
    """The empty span: nothing, or the cheapest insertions from p to q."""
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    for _ in range(2):
        for (p, r), (cost, audit) in list(cell.items()):
            for a, q in _STEPS["u"] + _STEPS["a"]:
                if a == r and (p, q) not in cell:
                    cell[p, q] = (cost + COSTS["I"], audit + "I")
    return cell


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two spans side by side."""
    by_start: list[list] = [[], [], [], []]
    for (r, q), (cost, audit) in right.items():
        by_start[r].append((q, cost, audit))
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q, more, rest in by_start[r]:
            total = cost + more
            best = out.get((p, q))
            if best is None or total < best[0] or (total == best[0] and audit + rest < best[1]):
                out[p, q] = (total, audit + rest)
    return out


_EMPTY = _closures()


def _one_turn(kind: str) -> Cell:
    """The cell of a turn. A kind is x (has to go) or s, u, a, o; upper case is truncated."""
    cell: Cell = {(p, p): (COSTS["D"], "D") for p in range(4)}
    if kind != "x":
        more = TRUNCATED_COST if kind.isupper() else 0
        edits = [(step, "R") for role in "ua" for step in _STEPS[role]]
        edits += [(step, "K") for step in _STEPS.get(kind.lower(), [])]
        for step, edit in edits:  # K last, it is cheaper
            cell[step] = (COSTS[edit] + more, edit)
    return joined(joined(_EMPTY, cell), _EMPTY)


_spans: dict[str, Cell] = {}


def block_cell(kinds: str) -> Cell:
    """The cell of a block: every span of it from all its splits, shortest first."""
    if kinds in _spans:
        return _spans[kinds]
    if len(_spans) > CACHED_SPANS:
        _spans.clear()
    for size in range(1, len(kinds) + 1):
        for at in range(len(kinds) - size + 1):
            span = kinds[at : at + size]
            if span in _spans:
                continue
            if size == 1:
                _spans[span] = _one_turn(span)
                continue
            best: Cell = {}
            for cut in range(1, size):
                for rule, found in joined(_spans[span[:cut]], _spans[span[cut:]]).items():
                    if rule not in best or found < best[rule]:
                        best[rule] = found
            _spans[span] = best
    return _spans[kinds]


def joined_all(cells: list[Cell]) -> Cell:
    """The cell of spans in a row, over spans of doubling length."""
    while len(cells) > 1:
        pairs = [joined(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(cells) // 2 * 2 :]
    return cells[0] if cells else _EMPTY


def parse(kinds: str) -> Cell:
    """The cell of all turns of these kinds."""
    return joined_all([block_cell(kinds[i : i + BLOCK_TURNS]) for i in range(0, len(kinds), BLOCK_TURNS)])


def whole(cell: Cell) -> tuple[int, str]:
    """The cheapest (cost, audit) of a whole conversation."""
    return min(cell[end] for end in ((NOTHING, NOTHING), (NOTHING, ASSISTANT)) if end in cell)


def edited(audit: str, turns: list[tuple[str, str]], last: int = NOTHING) -> list[tuple[str, str, str]]:
    """(edit, role, text) of what the edits leave of ``turns`` (role, text), after ``last``."""
    rest, out = iter(turns), []
    for edit in audit:
        role, text = (None, "") if edit == "I" else next(rest)
        if edit == "D":
            continue
        last = _after(last, edit, role)
        if edit != "K":
            role = "user" if last == USER else "assistant"
        out.append((edit, role, text))
    return out


def _after(last: int, edit: str, role: str | None) -> int:
    """What came last after an edit that leaves a turn; a system turn only stays as the first."""
    if edit == "K" and last == NOTHING and role[:1] == "s":
        return SYSTEM
    return ASSISTANT if last == USER else USER


def illegal_pairs(initials: str) -> int:
    return sum(initials[i : i + 2] not in _LEGAL for i in range(len(initials) - 1))


def _digest(lines: list[tuple[str, str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in lines).encode()).hexdigest()


def _gaps(turns: list[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return min(max(known) - min(known) + 1 - len(known), _LONG) if known else 0


def repair(rows: list[tuple]) -> tuple[tuple, list[tuple[str, str, str]]]:
    """(gaps, faults, cost and audit, turns left) of ordered rows (turn, role, text, kind)."""
    seen, kinds, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text, kind in rows:
        if kind == "x":
            faults["blank"] += 1
        elif (role, text) in seen:
            faults["duplicate"] += 1
            kind = "x"
        elif kind.isupper():
            faults["truncated"] += 1
        seen.add((role, text))
        kinds.append(kind)
    cost, audit = whole(parse("".join(kinds)))
    initials = "".join(role[:1] if role[:1] in ("s", "u", "a") else "o" for _, role, _, _ in rows)
    found = (_gaps([r[0] for r in rows]), *faults.values(), illegal_pairs(initials), cost, audit)
    return found, edited(audit, [(role, text) for _, role, text, _ in rows])


def _kind(role: Column, text: Column) -> Column:
    """The kind of a turn, but for repetition."""
    said = F.rtrim(text, F.lit(_BLANKS))
    initial = F.substring(role, 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    complete = F.right(said, F.lit(1)).isin(".", "!", "?")
    return F.when(said == "", "x").when(complete, known).otherwise(F.upper(known))


_ORDER = ["_timed", "turn", "role", "text"]


def _ordered(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and kind, with nulls replaced, and what orders null turns first."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        role.alias("role"),
        text.alias("text"),
        _kind(role, text).alias("kind"),
        F.col("turn").isNotNull().alias("_timed"),
    )


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple]]]:
    """(conv_id, rows) of rows that are sorted by conv_id."""
    now, held, started = None, [], False
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "kind")]
        for conv_id, *row in zip(*columns):
            if started and conv_id != now:
                yield now, held
                held = []
            now, started = conv_id, True
            held.append(tuple(row))
    if started:
        yield now, held


_ARROW = {"long": pa.int64(), "string": pa.string()}


def _batches(rows: Iterator[tuple], schema: str, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    fields = [field.split() for field in schema.split(", ")]

    def made(held: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(zip(*held), fields)]
        return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])

    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made(held)
            held = []
    if held:
        yield made(held)


def _each(turns: DataFrame, rows: Callable[[Iterator], Iterator[tuple]], schema: str) -> DataFrame:
    """``rows`` of sorted conversations, each in one task."""

    @releasing
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(rows(_conversations(batches)), schema)

    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)
    return dealt.drop("_timed").mapInArrow(work, schema)


def repair_summary(turns: DataFrame, hot_turns: int = HOT_TURNS) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text; other columns are left out).

    gaps (numbers missing between turns), blank, duplicate and truncated turns by
    their first fault, illegal neighbours, cost and audit of the cheapest
    repair, and the SHA-256 of what it leaves as ``role:text`` lines.
    """

    def rows(found: Iterator) -> Iterator[tuple]:
        for conv_id, held in found:
            summary, lines = repair(held)
            yield conv_id, *summary, _digest(lines)

    cold, hot = split_hot(_ordered(turns), ["conv_id"], hot_turns)
    result = _each(cold, rows, SUMMARY)
    return result if hot is None else result.unionByName(_hot_summary(*_hot_repairs(hot)))


def repaired_turns(turns: DataFrame, hot_turns: int = HOT_TURNS) -> DataFrame:
    """The turns that the cheapest repairs leave, ordered by (conv_id, segment, place), with their edit."""

    def rows(found: Iterator) -> Iterator[tuple]:
        for conv_id, held in found:
            for place, line in enumerate(repair(held)[1]):
                yield conv_id, 0, place, *line

    cold, hot = split_hot(_ordered(turns), ["conv_id"], hot_turns)
    result = _each(cold, rows, TURNS)
    return result if hot is None else result.unionByName(_hot_repairs(hot)[2])


_CELLS = "array<struct<start int, end int, cost long, audit string>>"
_PARSED = f"conv_id long, segment long, initials string, cell {_CELLS}"


def _stored(cell: Cell) -> list[dict]:
    return [{"start": p, "end": q, "cost": c, "audit": a} for (p, q), (c, a) in cell.items()]


def _loaded(cells: list[dict]) -> Cell:
    return {(x["start"], x["end"]): (x["cost"], x["audit"]) for x in cells}


def _parsed_frame(key: tuple, initials: str, cell: Cell) -> pd.DataFrame:
    return pd.DataFrame(
        {"conv_id": pd.array([key[0]], "Int64"), "segment": [key[1]], "initials": [initials], "cell": [_stored(cell)]}
    )


def _missing(value) -> int | None:
    return None if pd.isna(value) else int(value)


def _hot_repairs(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(turns with rank and kind, one row per conversation with initials and audit, turns left)."""
    size = SEGMENT_TURNS
    ranked = stage(rank_hot(turns, ["conv_id"], _ORDER, "rank"), "ranked-turns")
    same = ["conv_id", "role", "text"]
    first = stage(ranked.groupBy(*same).agg(F.min("rank").alias("_first")), "first-turns")
    again = F.col("rank") > F.col("_first")
    marked = null_safe_join(ranked, first, same, "inner").select(
        "conv_id",
        F.floor((F.col("rank") - 1) / size).alias("segment"),
        "rank",
        "turn",
        "role",
        "text",
        "kind",
        (again & (F.col("kind") != "x")).alias("repeated"),
    )
    marked = stage(marked, "marked-turns")

    def segment(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rank")
        kinds = "".join("x" if again else kind for kind, again in zip(frame["kind"], frame["repeated"]))
        initials = "".join(i if i in ("s", "u", "a") else "o" for i in frame["initial"])
        return _parsed_frame((_missing(key[0]), int(key[1])), initials, parse(kinds))

    narrow = marked.select(
        "conv_id", "segment", "rank", "kind", "repeated", F.substring("role", 1, 1).alias("initial")
    )
    parsed = stage(narrow.groupBy("conv_id", "segment").applyInPandas(segment, _PARSED), "segment-cells")

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("segment")
        cell = joined_all([_loaded(c) for c in frame["cell"]])
        return _parsed_frame((_missing(key[0]), int(key[1])), "".join(frame["initials"]), cell)

    most = parsed.agg(F.max("segment")).first()[0] or 0
    while most:
        wider = parsed.withColumn("_to", F.floor(F.col("segment") / FAN))
        parsed = stage(wider.groupBy("conv_id", "_to").applyInPandas(meet, _PARSED), "joined-cells")
        most //= FAN

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [whole(_loaded(cell)) for cell in frame["cell"]]
            yield pd.DataFrame(
                {
                    "conv_id": frame["conv_id"].astype("Int64"),
                    "illegal": [illegal_pairs(i) for i in frame["initials"]],
                    "initials": frame["initials"],
                    "cost": [cost for cost, _ in found],
                    "audit": [audit for _, audit in found],
                }
            )

    found = stage(
        parsed.mapInPandas(finish, "conv_id long, illegal long, initials string, cost long, audit string"),
        "hot-audits",
    )

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for conv_id, initials, audit in zip(frame["conv_id"], frame["initials"], frame["audit"]):
                for piece in _segments(initials, audit, size):
                    columns = {"conv_id": pd.array([_missing(conv_id)], "Int64")}
                    names = ("segment", "last", "edits")
                    yield pd.DataFrame(columns | {n: [v] for n, v in zip(names, piece)})

    edits = stage(
        found.select("conv_id", "initials", "audit").mapInPandas(
            cut, "conv_id long, segment long, last int, edits string"
        ),
        "segment-edits",
    )

    def change(key: tuple, rows: pd.DataFrame, edits: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        lines = edited(edits["edits"].iloc[0], list(zip(rows["role"], rows["text"])), int(edits["last"].iloc[0]))
        frame = pd.DataFrame(lines, columns=["edit", "role", "text"])
        frame.insert(0, "place", range(len(lines)))
        frame.insert(0, "segment", int(key[1]))
        frame.insert(0, "conv_id", pd.array([_missing(key[0])] * len(lines), "Int64"))
        return frame

    keys = ("conv_id", "segment")
    texts = marked.select("conv_id", "segment", "rank", "role", "text")
    left = texts.groupBy(*keys).cogroup(edits.groupBy(*keys)).applyInPandas(change, TURNS)
    return marked, found.drop("initials"), stage(left, "repaired-turns")


def _segments(initials: str, audit: str, size: int) -> Iterator[tuple[int, int, str]]:
    """(segment, what came last before it, its edits); insertions go to the segment after them."""
    last, taken, opened, segment, before = NOTHING, 0, 0, 0, NOTHING
    for at, edit in enumerate(audit):
        if taken == size and (segment + 1) * size < len(initials):
            yield segment, before, audit[opened:at]
            segment, opened, taken, before = segment + 1, at, 0, last
        if edit != "D":
            role = None if edit == "I" else initials[segment * size + taken]
            last = _after(last, edit, role)
        taken += edit != "I"
    if audit:
        yield segment, before, audit[opened:]


def _hot_summary(marked: DataFrame, found: DataFrame, left: DataFrame) -> DataFrame:
    """``SUMMARY`` of long conversations."""
    wide = F.col("turn").cast("decimal(38,0)")
    gaps = F.max(wide) - F.min(wide) + 1 - F.count_distinct("turn")
    blank, truncated = F.col("kind") == "x", F.col("kind").isin("S", "U", "A", "O")
    counted = marked.groupBy("conv_id").agg(
        F.least(F.coalesce(gaps, F.lit(0)), F.lit(_LONG)).cast("long").alias("gaps"),
        F.count_if(blank).alias("blank"),
        F.count_if("repeated").alias("duplicate"),
        F.count_if(truncated & ~F.col("repeated")).alias("truncated"),
    )

    @releasing
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now, state = None, None
            for batch in batches:
                for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                    if state is None or conv_id != now:
                        if state is not None:
                            yield now, state.hexdigest()
                        now, state = conv_id, hashlib.sha256()
                    else:
                        state.update(b"\n")
                    state.update(f"{role}:{text}".encode())
            if state is not None:
                yield now, state.hexdigest()

        return _batches(rows(), "conv_id long, repaired_sha256 string")

    digests = (
        left.repartition("conv_id")
        .sortWithinPartitions("conv_id", "segment", "place")
        .select("conv_id", "role", "text")
        .mapInArrow(digest, "conv_id long, repaired_sha256 string")
    )
    everything = null_safe_join(null_safe_join(counted, found, ["conv_id"], "inner"), digests, ["conv_id"], "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    everything = everything.withColumn("repaired_sha256", F.coalesce("repaired_sha256", none))
    return everything.select(*(field.split()[0] for field in SUMMARY.split(", ")))
