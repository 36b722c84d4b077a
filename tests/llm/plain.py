"""Plain versions of the operators, for small tables."""

import itertools
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def components(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return find


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def linked(sets, share=80):
    for (a, x), (b, y) in itertools.combinations(sorted(sets.items()), 2):
        if x and y and 100 * len(x & y) >= share * len(x | y):
            yield a, b


def targets(sizes, weights=(5, 2, 1), top=3):
    """Water filling as told: share by weight, stop at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if per * weight[s] >= top * sizes[s]]
        if not over:
            return out | {s: per * weight[s] for s in open_}
        for s in over:
            out[s] = float(top * sizes[s])
            left -= out[s]
            open_.discard(s)
    return out
