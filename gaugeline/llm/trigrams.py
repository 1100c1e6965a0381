"""Boolean trigram queries that every match of a regular expression satisfies.

A query is True (nothing is known), a trigram, or ("and" | "or", queries).
Trigrams are of the lower-cased text, which keeps them necessary whether or not
the expression minds case.
"""

from __future__ import annotations

import itertools
from re import _constants as kinds
from re import _parser as parser

Query = bool | str | tuple

# Strings followed exactly before they are turned into a query.
_MOST_STRINGS = 64
_MOST_LETTERS = 8


def _all_of(*queries: Query) -> Query:
    flat: dict[Query, None] = {}
    for q in queries:
        parts = q[1] if isinstance(q, tuple) and q[0] == "and" else [] if q is True else [q]
        flat |= dict.fromkeys(parts)
    return True if not flat else next(iter(flat)) if len(flat) == 1 else ("and", tuple(flat))


def _any_of(queries: list[Query]) -> Query:
    """One of ``queries``; those that another one already implies go."""
    if True in queries:
        return True
    sets = {q: frozenset(q[1]) if isinstance(q, tuple) and q[0] == "and" else frozenset([q]) for q in queries}
    least = [q for q in sets if not any(sets[o] < sets[q] for o in sets)]
    return least[0] if len(least) == 1 else ("or", tuple(least))


def _of_strings(strings: set[str]) -> Query:
    if any(len(s) < 3 for s in strings):
        return True
    return _any_of([_all_of(*(s[i : i + 3] for i in range(len(s) - 2))) for s in sorted(strings)])


def _letters(items: list) -> set[str] | None:
    """The characters of a class, lower-cased, if they are few."""
    found: set[str] = set()
    for kind, value in items:
        if kind is kinds.LITERAL:
            found.add(chr(value).lower())
        elif kind is kinds.RANGE and value[1] - value[0] < 2 * _MOST_LETTERS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= _MOST_LETTERS else None


def _exact(items: list) -> set[str] | None:
    """All strings that a sequence matches, lower-cased, if they are few."""
    strings = {""}
    for item in items:
        some = _exact_item(*item)
        if some is None or len(strings) * len(some) > _MOST_STRINGS:
            return None
        strings = {a + b for a, b in itertools.product(strings, some)}
    return strings


def _exact_item(kind, value) -> set[str] | None:
    if kind is kinds.LITERAL:
        return {chr(value).lower()}
    if kind is kinds.IN:
        return _letters(value)
    if kind is kinds.SUBPATTERN:
        return _exact(value[-1])
    if kind is kinds.BRANCH:
        ways = [_exact(way) for way in value[1]]
        return None if None in ways else set().union(*ways)
    if kind is kinds.MAX_REPEAT and value[1] <= 3:
        once = _exact(value[2])
        if once is not None and len(once) ** value[1] <= _MOST_STRINGS:
            return {"".join(p) for n in range(value[0], value[1] + 1) for p in itertools.product(once, repeat=n)}
    if kind is kinds.AT:
        return {""}
    return None


def _sequence(items: list) -> Query:
    known: list[Query] = []
    run = {""}
    for kind, value in items:
        some = _exact_item(kind, value)
        if some is not None and len(run) * len(some) <= _MOST_STRINGS:
            run = {a + b for a, b in itertools.product(run, some)}
            continue
        known.append(_of_strings(run))
        run = {""}
        if some is not None:
            run = some
        elif kind is kinds.SUBPATTERN:
            known.append(_sequence(value[-1]))
        elif kind is kinds.BRANCH:
            known.append(_any_of([_sequence(way) for way in value[1]]))
        elif kind is kinds.MAX_REPEAT and value[0] > 0:
            known.append(_sequence(value[2]))
    return _all_of(*known, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """The query of ``pattern``; parts it does not understand demand nothing."""
    return _sequence(list(parser.parse(pattern)))


def trigrams_of(query: Query) -> set[str]:
    if isinstance(query, str):
        return {query}
    return set().union(*map(trigrams_of, query[1])) if isinstance(query, tuple) else set()
