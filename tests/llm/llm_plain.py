"""Plain versions of what the joins compute, for tests."""

import itertools
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def joined(pairs, nodes):
    """The smallest node that each one reaches."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    return {i: (max(own), len(own)) for own in groups.values() for i in own}


def shingles(text, count=4):
    words = text.translate(LOWER).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace(
        "\r", " ").split(" ")
    words = [w for w in words if w]
    return frozenset(tuple(words[i:i + count]) for i in range(max(1, len(words) - count + 1))) if words else frozenset()


def near(rows, count=4, percent=85):
    sets = {i: shingles(t, count) for i, t in rows}
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, joined(pairs, sets)
