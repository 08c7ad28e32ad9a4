"""Plain single-process versions of the operators' contracts, for comparison."""

import hashlib
from collections import Counter, defaultdict

import numpy as np


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        up[find(a)] = find(b)
    return [find(x) for x in range(n)]


def components_of(ids, links):
    """The smallest id (nulls last) of each row's component."""
    at, groups = roots(len(ids), links), defaultdict(list)
    for i, r in enumerate(at):
        groups[r].append(ids[i])
    least = {r: min((x for x in v if x is not None), default=None) for r, v in groups.items()}
    return [least[r] for r in at]


def near_duplicates(rows, size):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()})
    holders, links = defaultdict(list), []
    for i, s in enumerate(sets):
        common = Counter(j for e in s for j in holders[e])
        links += [(i, j) for j, c in common.items() if 100 * c >= 80 * (len(s) + len(sets[j]) - c)]
        for e in s:
            holders[e].append(i)
    ids = [r[0] for r in rows]
    return [(i, len(s), c, i is not None and i == c) for i, s, c in zip(ids, sets, components_of(ids, links))]


def without_repeats(rows, window):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[k : k + window]) for _, w in words for k in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def linked_vectors(rows, cosine):
    ok = [i for i, (_, e, label) in enumerate(rows) if label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    links, degree = [], [0] * len(rows)
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    links.append((a, b))
                    degree[a] += 1
                    degree[b] += 1
    ids = [r[0] for r in rows]
    return [(i, n, c, i is not None and i == c) for i, n, c in zip(ids, degree, components_of(ids, links))]
