"""Brute-force versions that the tests hold the operators against."""

from __future__ import annotations

from collections import Counter, defaultdict


class Union:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingles(text: str | None, words: int = 5) -> frozenset:
    w = (text or "").encode("utf-8").lower().split()
    if len(w) < words:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1))


def overlaps(sets: dict) -> dict[tuple, int]:
    """Common members of every pair that has some."""
    holders, found = defaultdict(list), Counter()
    for i in sorted(sets):
        own = Counter()
        for g in sets[i]:
            own.update(holders[g])
            holders[g].append(i)
        for j, n in own.items():
            found[j, i] = n
    return found


def linked_components(sets: dict, least: int = 80) -> dict:
    union = Union(sets)
    for (i, j), n in overlaps(sets).items():
        if 100 * n >= least * (len(sets[i]) + len(sets[j]) - n):
            union.join(i, j)
    return {i: union.find(i) for i in sets}
