"""Plain versions of the operators, over lists, to compare with."""

from __future__ import annotations

import re
from collections import defaultdict

ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)


def base_secrets(text: str | None) -> list[tuple[str, int, int]]:
    text, found = text or "", []
    for rank, (kind, pattern, group, least) in enumerate((
        ("assign", ASSIGN, 1, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile("[0-9a-f]+"), 0, 24),
    )):
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                found.append((m.start(), rank, m.end(), kind))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def lowered(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text: str | None, width: int) -> set[tuple[str, ...]]:
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_components(rows: list[tuple], width: int, percent: int) -> dict:
    """Smallest reachable id by id, from (id, text), comparing all pairs that share a shingle."""
    sets = [(i, shingles(t, width)) for i, t in rows if i is not None]
    holders, shared = defaultdict(list), defaultdict(int)
    for n, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(n)
    for members in holders.values():
        for k, a in enumerate(members):
            for b in members[:k]:
                shared[b, a] += 1
    parent = list(range(len(sets)))

    def root(n: int) -> int:
        while parent[n] != n:
            n = parent[n]
        return n

    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a][1]) + len(sets[b][1]) - both):
            parent[root(a)] = root(b)
    least = {}
    for n, (i, _) in enumerate(sets):
        least[root(n)] = min(i, least.get(root(n), i))
    return {i: least[root(n)] for n, (i, _) in enumerate(sets)}


def bench_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def contaminated_words(text: str | None, items: list[tuple], window: int) -> tuple[int, list[str]]:
    words, hit, listed = bench_words(text), set(), set()
    for item, body in items:
        theirs = bench_words(body)
        size = min(window, len(theirs))
        cuts = {tuple(theirs[i : i + size]) for i in range(len(theirs) - size + 1)} if size else ()
        for i in range(len(words) - size + 1) if size else ():
            if tuple(words[i : i + size]) in cuts:
                hit.update(range(i, i + size))
                if item is not None:
                    listed.add(str(item))
    return len(hit), sorted(listed)
