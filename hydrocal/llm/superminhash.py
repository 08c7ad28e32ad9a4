"""SuperMinHash signatures of many element sets at once (used by operator 2).

An element with 64-bit hash ``e`` visits the ``m`` slots in the order of its own random permutation;
at its j-th visit it offers ``j + r_j`` with ``r_j`` uniform in [0, 1), and a slot keeps the least
offer. Offers of step j lie in [j, j + 1), so once all slots of a set hold values below j + 1 later
steps cannot change them and the set stops early. Steps run over all still open sets side by side.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_EMPTY = U(0xFFFFFFFFFFFFFFFF)


def _random(e: np.ndarray, j: int) -> np.ndarray:
    x = e + U((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def signatures(elements: np.ndarray, of: np.ndarray, sets: int, m: int) -> np.ndarray:
    """elements: uint64 hashes, distinct within a set; ``of``: their set's number (ascending).
    Returns uint64[sets, m]; sets without elements hold all ones."""
    h = np.full(sets * m, _EMPTY, U)
    e, d, perm = elements, of.astype(np.int64), None
    for j in range(m):
        if not len(e):
            break
        x = _random(e, j)
        k = j + (((x & U(0xFFFFFFFF)) * U(m - j)) >> U(32)).astype(np.int64)
        if perm is None:
            slot = k
        else:
            row = np.arange(len(e))
            slot = perm[row, k].astype(np.int64)
            perm[row, k] = perm[row, j]
        np.minimum.at(h, d * m + slot, U(j << 32) | (x >> U(32)))
        open_sets = h.reshape(sets, m).max(axis=1) >= U((j + 1) << 32)
        live = open_sets[d]
        if perm is None:
            e, d, k = e[live], d[live], k[live]
            perm = np.broadcast_to(np.arange(m, dtype=np.uint8 if m <= 256 else np.int32), (len(e), m)).copy()
            perm[np.arange(len(e)), k] = 0  # the first step swapped slots 0 and k
        elif live.sum() < 0.8 * len(e):
            e, d, perm = e[live], d[live], perm[live]
    return h.reshape(sets, m)
