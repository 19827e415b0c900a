"""Plain versions of operators that SQL can't express."""

from __future__ import annotations

import re
from collections import defaultdict

BLANKS = "\x20\t\n\x0b\x0c\r"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, width: int = 5) -> frozenset:
    words = [w for w in re.split(f"[{BLANKS}]+", (text or "").translate(_LOWER)) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def union_find(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_groups(docs: dict, per_cent: int = 75) -> dict:
    """doc_id -> (set size, smallest doc_id reachable) for doc_id -> text."""
    sets = {d: shingles(t) for d, t in docs.items()}
    same = defaultdict(list)
    for d in sorted(sets):
        if sets[d]:
            same[sets[d]].append(d)
    links = [(ids[0], d) for ids in same.values() for d in ids[1:]]
    reps = {ids[0]: s for s, ids in same.items()}
    postings = defaultdict(list)
    for d, s in reps.items():
        both = defaultdict(int)
        for x in s:
            for other in postings[x]:
                both[other] += 1
            postings[x].append(d)
        links += [(d, o) for o, n in both.items() if 100 * n >= per_cent * (len(s) + len(reps[o]) - n)]
    found = union_find(sets, links)
    return {d: (len(sets[d]), found[d]) for d in sets}
