"""Plain Python versions of what the operators compute."""

import re

WS = re.compile(r"[\x20\x09-\x0D]+")
UP = {i: i + 32 for i in range(65, 91)}


def words(text):
    return [w for w in WS.split((text or "").translate(UP)) if w]


def shingles(text, width):
    w = words(text)
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def near_groups(rows, width, percent):
    """doc_id -> (set size, smallest id of the component), all pairs that
    share a shingle compared."""
    sets = {i: shingles(t, width) for i, t in rows}
    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    u, seen = Union(), set()
    for ids in by.values():
        for x, a in enumerate(ids):
            for b in ids[x + 1:]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    n = len(sets[a] & sets[b])
                    if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                        u.join(a, b)
    return {i: (len(s), u.find(i)) for i, s in sets.items()}
