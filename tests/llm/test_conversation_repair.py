"""Repairs of conversations against dynamic programming and a plain CYK table."""

from __future__ import annotations

import itertools
import random

import pytest

from gaugeline.llm import conversation_repair as repair
from gaugeline.llm.queries import QUERIES, damaged
from tests.llm import brute
from tests.llm.conftest import TURN_SCHEMA, TURNS
from tests.llm.test_queries import ordered


def all_splits(kinds: str) -> dict:
    """The textbook table: every span from every split, without blocks or memory."""
    table = {(i, i + 1): repair._one_turn(k) for i, k in enumerate(kinds)}
    for size in range(2, len(kinds) + 1):
        for i in range(len(kinds) - size + 1):
            cell: dict = {}
            for cut in range(i + 1, i + size):
                for rule, found in repair.joined(table[i, cut], table[cut, i + size]).items():
                    cell[rule] = min(cell.get(rule, found), found)
            table[i, i + size] = cell
    return table[0, len(kinds)]


@pytest.mark.parametrize("seed", range(40))
def test_blocks_equal_the_whole_table(seed):
    rng = random.Random(seed)
    kinds = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randint(1, 30)))
    assert repair.parse(kinds) == all_splits(kinds)


def test_no_audit_begins_another_of_its_cell():
    for kinds in map("".join, itertools.product("suAx", repeat=3)):
        for (cost, audit), (other, longer) in itertools.permutations(repair.parse(kinds).values(), 2):
            assert cost != other or audit == longer or not longer.startswith(audit)


def test_insertion_closure():
    assert repair._EMPTY[repair.NOTHING, repair.ASSISTANT] == (10, "II")
    assert repair._EMPTY[repair.USER, repair.ASSISTANT] == (5, "I")
    assert repair._EMPTY[repair.SYSTEM, repair.SYSTEM] == (0, "")
    assert (repair.NOTHING, repair.SYSTEM) not in repair._EMPTY


@pytest.mark.parametrize(
    ("turns", "audit"),
    [
        ([("user", "Hi."), ("assistant", "Yes.")], "KK"),
        ([("system", "Be."), ("user", "Hi."), ("assistant", "Yes.")], "KKK"),
        ([("user", "Hi."), ("user", "Yes.")], "KR"),
        ([("assistant", "Yes.")], "D"),
        ([("user", "Hi."), ("user", "Hi."), ("assistant", "Yes.")], "KDK"),
        ([("user", "Hi."), ("assistant", "cut")], "DD"),
        ([], ""),
    ],
)
def test_known_repairs(turns, audit):
    def kind(text: str) -> str:
        return "" if text.endswith(".") else "^"

    rows = [(i, r, t, r[0] if not kind(t) else r[0].upper()) for i, (r, t) in enumerate(turns)]
    assert repair.repair(rows)[0][-1] == audit


@pytest.fixture(scope="module")
def random_turns(spark):
    rng = random.Random(7)
    rows = []
    for conv in range(60):
        for turn in range(rng.choice([0, 1, 2, 5, 9, 30, 70])):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice(["One.", "Two!", "cut", "", " \n", f"Turn {turn}?", None])
            rows.append((conv, rng.choice([turn, turn, turn // 2, None]), role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, TURN_SCHEMA)


def plain(rows) -> list[tuple]:
    """The contract without damage."""
    held: dict = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        held.setdefault(conv, []).append((turn, role, text))
    for turns in held.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return ordered((conv, *brute.repairs(turns)) for conv, turns in held.items())


def test_summary(spark, random_turns):
    rows = random_turns + TURNS
    assert ordered(map(tuple, repair.repair_summary(frame(spark, rows)).collect())) == plain(rows)


@pytest.mark.parametrize(("segment", "fan"), [(5, 4)])
def test_long_conversations(spark, random_turns, monkeypatch, segment, fan):
    """Cut into segments, all results are the same; the short ones stay on the other way."""
    monkeypatch.setattr(repair, "SEGMENT_TURNS", segment)
    monkeypatch.setattr(repair, "FAN", fan)
    rows = random_turns + TURNS
    turns = frame(spark, rows)
    assert ordered(map(tuple, repair.repair_summary(turns, hot_turns=4).collect())) == plain(rows)

    def lines(found):
        order = found.orderBy("conv_id", "segment", "place").select("conv_id", "edit", "role", "text")
        return [tuple(r) for r in order.collect()]

    assert lines(repair.repaired_turns(turns, hot_turns=4)) == lines(repair.repaired_turns(turns))


@pytest.mark.parametrize("name", ["table_dir", "tiny_dir", "sf_dir"])
def test_query(spark, request, name):
    folder = request.getfixturevalue(name)
    rows = [
        tuple(r)
        for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    ]
    expected = ordered((conv, *brute.repairs(turns)) for conv, turns in brute.damaged(rows).items())
    assert ordered(map(tuple, QUERIES["op13_conversation_repair"](spark, folder).collect())) == expected


def test_damage_keeps_the_rest(spark):
    rows = [(c, 0, "assistant", "Yes.") for c in range(400)]
    found = damaged(frame(spark, rows)).collect()
    expected = [(c, *turn) for c, turns in brute.damaged(rows).items() for turn in turns]
    assert ordered(map(tuple, found)) == ordered(expected)
    assert len({c for c, *_ in expected}) < 400
