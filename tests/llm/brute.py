"""The contracts of the operators in plain Python, row by row."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import xxhash
from tokenizers import Tokenizer

WORD = r"[^\x20\x09-\x0D]+"


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fold(doc_id: int | None, folds: int) -> int:
    return -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


@cache
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def encoded(path: str, text: str | None) -> list[int]:
    return library(path).encode(text or "", add_special_tokens=False).ids


def rules(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(WORD, text)
    times = Counter(zip(words, words[1:], words[2:]))
    inside = {j for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


def secrets(text: str | None) -> tuple[tuple[int, int, int], str]:
    kinds = [
        ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        ("access", r"AKIA[A-Z0-9]+", 0, 18),
        ("hex", r"[0-9a-f]+", 0, 16),
    ]
    found = []
    for number, (_, pattern, group, least) in enumerate(kinds):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m[group]) >= least:
                found.append((m.start(), number, m.end()))
    found.sort()
    written = ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in found)
    return tuple(sum(k == i for _, k, _ in found) for i in range(3)), sha(written)


def contamination(texts: list, items: list[tuple]) -> list[tuple]:
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))

    windows = defaultdict(set)
    for item, text in items:
        ws = words(text)
        for i in range(max(1, len(ws) - 12) if ws else 0):
            windows[tuple(ws[i : i + 13])] |= set() if item is None else {str(item)}
    out = []
    for text in texts:
        ws, hit, owners = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(ws) - size + 1):
                found = windows.get(tuple(ws[i : i + size]))
                if found is not None:
                    owners |= found
                    hit.update(range(i, i + size))
        out.append((len(ws), len(hit), len(owners), sha(",".join(sorted(owners))), bool(hit) and 20 * len(hit) >= len(ws)))
    return out


def fingerprint(text: str | None) -> int:
    words = re.findall(WORD, lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    bits = np.zeros(64, int)
    for s in shingles:
        bits += (xxhash.xxh64_intdigest(s.encode(), 42) >> np.arange(64, dtype=np.uint64)).astype(np.uint64) & np.uint64(1) != 0
    return sum(1 << i for i in range(64) if 2 * bits[i] > len(shingles))


def components(prints: list[int], names: list[int]) -> list[int]:
    parent = list(range(len(prints)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    values = np.array(prints, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 3).tolist():
            parent[root(j)] = root(i)
    roots = [root(i) for i in range(len(prints))]
    least = defaultdict(lambda: math.inf)
    for r, name in zip(roots, names):
        least[r] = min(least[r], name)
    return [least[r] for r in roots]


def kneser_ney(rows: list[tuple], order: int = 3) -> list[tuple]:
    """(held_out, n_tokens, n_known, train_tokens, base_score, score) of rows (doc_id, text)."""
    tokens = [[*re.findall(WORD, lower(t or "")), None] for _, t in rows]
    held = [fold(i, 10) == 0 for i, _ in rows]

    def grams(ts: list) -> list[tuple]:
        padded = [*[0] * (order - 1), *ts]
        return [tuple(padded[i : i + order]) for i in range(len(ts))]

    c = Counter(w for ts, out in zip(tokens, held) if not out for w in ts)
    n, v = sum(c.values()), len(c)
    a = {order: Counter(g for ts, out in zip(tokens, held) if not out for g in grams(ts))}
    for k in range(order - 1, 0, -1):
        a[k] = Counter(g[1:] for g in a[k + 1])

    def discounts(counts: Counter) -> list[float]:
        ns = [sum(1 for x in counts.values() if x == k) for k in (1, 2, 3, 4)]
        if not all(ns):
            return [0, 0.5, 0.75, 0.9]
        y = ns[0] / (ns[0] + 2 * ns[1])
        return [0, *(min(max(k - (k + 1) * y * ns[k] / ns[k - 1], 0.05), k - 0.05) for k in (1, 2, 3))]

    by = {k: discounts(a[k]) for k in a}
    total, taken = defaultdict(int), defaultdict(float)
    for k in a:
        for g, x in a[k].items():
            total[g[:-1]] += x
            taken[g[:-1]] += by[k][min(x, 3)]

    def p(gram: tuple) -> float:
        low = p(gram[1:]) if len(gram) > 1 else 1 / (v + 1)
        if not total[gram[:-1]]:
            return low
        x = a[len(gram)][gram]
        return (max(x - by[len(gram)][min(x, 3)], 0) + taken[gram[:-1]] * low) / total[gram[:-1]]

    out = []
    for ts, h in zip(tokens, held):
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts)
        out.append((h, len(ts), sum(c[w] > 0 for w in ts), n, base, sum(math.log10(p(g)) for g in grams(ts))))
    return out


def with_periods(doc_id: int | None, text: str | None) -> list[str]:
    words = re.findall(WORD, text or "")
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def runs(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period), period by period."""
    number: dict = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], int)
    smallest: dict = {}
    for q in range(1, len(ids) // 2 + 1):
        same = np.concatenate([[0], ids[q:] == ids[:-q], [0]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(same))
        for at, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end + q - at >= max(12, 2 * q):
                smallest.setdefault((at, end + q), q)
    return sorted(((s, e - s, q) for (s, e), q in smallest.items()), key=lambda r: (r[0], r[2]))


def periodic(doc_id: int | None, text: str | None) -> tuple:
    words = with_periods(doc_id, text)
    found = runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if found else None
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return len(found), *best, milli, sha(listed), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def damaged(rows: list[tuple]) -> dict:
    """Turns (turn, role, text) of every conversation after damage, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        held = out[conv]
        role, text = (" " if v is None else v for v in (role, text))
        names = ("" + str(v) if v is not None else " " for v in (conv, turn))
        fault = zlib.crc32(":".join(names).encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        held += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    for held in out.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return dict(out)


def repairs(rows: list[tuple]) -> tuple:
    """The contract's columns after conv_id, by dynamic programming from turn to turn."""
    kinds, seen = [], set()
    for _, role, text in rows:
        said = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else None if said[-1] in ".!?" else "truncated"
        seen.add((role, text))
        kinds.append(fault)
    # (cost, audit, lines) by what came last: nothing, s, u or a.
    best = {"": (0, "", ())}

    def inserted(states: dict) -> dict:
        states = dict(states)
        for _ in range(2):
            for last, (cost, audit, lines) in list(states.items()):
                role = "assistant" if last == "u" else "user"
                new = (cost + 5, audit + "I", (*lines, f"{role}:"))
                if role[0] not in states or new < states[role[0]]:
                    states[role[0]] = new
        return states

    for (_, role, text), fault in zip(rows, kinds):
        after: dict = {}

        def offer(last: str, found: tuple) -> None:
            if last not in after or found < after[last]:
                after[last] = found

        for last, (cost, audit, lines) in inserted(best).items():
            offer(last, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            needed = "assistant" if last == "u" else "user"
            offer(needed[0], (cost + 1 + more, audit + "R", (*lines, f"{needed}:{text}")))
            if role[:1] == needed[0] or (role[:1] == "s" and last == ""):
                offer(role[0], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
        best = after
    final = inserted(best)
    cost, audit, lines = min(final[last] for last in ("", "a") if last in final)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = min(max(turns) - min(turns) + 1 - len(turns), (1 << 63) - 1) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = (sum(k == f for k in kinds) for f in ("blank", "duplicate", "truncated"))
    return gaps, *counts, illegal, cost, audit, sha("\n".join(lines))
