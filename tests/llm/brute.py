"""Plain versions of what the operators compute, for small inputs."""

import re
from collections import Counter

import numpy as np


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, k):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def near_classes(rows, k):
    """Smallest id reachable over links of 80 % similarity, for (id, text) rows with an id."""
    sets, parent = {}, {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingles(text, k))
        parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    flat = [(i, s) for i, own in sets.items() for s in own]
    for n, (a, x) in enumerate(flat):
        for b, y in flat[:n]:
            both = len(x & y)
            if both and 100 * both >= 80 * (len(x) + len(y) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in parent}


def without_repeats(texts, window):
    """Kept words of each text."""
    split = [words(t) for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = {j for s in range(len(w) - window + 1) if count[tuple(w[s : s + window])] > 1 for j in range(s, s + window)}
        out.append([x for j, x in enumerate(w) if j not in gone])
    return out


def bm25(texts, df, n_docs, mean):
    """All scores: query by document."""
    has = [Counter(t.tolist()) for t in texts]
    out = np.zeros((len(texts), len(texts)))
    for q, query in enumerate(has):
        for d, (h, t) in enumerate(zip(has, texts, strict=True)):
            norm = 1.2 * (0.25 + 0.75 * len(t) / mean)
            out[q, d] = sum(np.log(1 + (n_docs - df[x] + 0.5) / (df[x] + 0.5)) * h[x] * 2.2 / (h[x] + norm) for x in query)
    return out


def packed(texts, scores, size):
    """Sequences of one shard, filled greedily with the best unused neighbours of each seed."""
    out, rest = [], {}
    for i, t in enumerate(texts):
        whole = len(t) // size * size
        out += [[(i, s, size)] for s in range(0, whole, size)]
        if len(t) > whole:
            rest[i] = (whole, len(t) - whole)
    unused, seed = set(rest), None
    while seed or unused:
        if not seed:
            i = min(unused)
            unused.discard(i)
            seed = (i, *rest[i])
        sequence, room, about, seed = [seed], size - seed[2], seed[0], None
        while room and unused:
            best = max(unused, key=lambda d: (scores[about, d], -d))
            if scores[about, best] <= 0:
                best = min(unused)
            unused.discard(best)
            start, length = rest[best]
            take = min(length, room)
            sequence.append((best, start, take))
            room -= take
            if take < length:
                seed = (best, start + take, length - take)
        out.append(sequence)
    return out


def alike(a, b):
    """Positional likeness of two lists of (pos, hash)."""
    first = [{}, {}]
    for side, anchors in zip(first, (a, b), strict=True):
        for pos, h in anchors:
            side.setdefault(h, pos)
    met = sorted((first[0][h], first[1][h]) for h in first[0].keys() & first[1].keys())
    union = len(first[0].keys() | first[1].keys())
    steady = lambda i, j: 0 <= i and j < len(met) and met[j][0] - met[i][0] == met[j][1] - met[i][1]
    placed = sum(len(met) == 1 or steady(i - 1, i) or steady(i, i + 1) for i in range(len(met)))
    return placed / union if union else 1.0


def units(text):
    """A word of up to 16 characters, or each character of a longer one."""
    return [u for w in words(text) for u in ([w] if len(w) <= 16 else w)]
