"""The E8 lattice: nearest points, and the roots that lead to neighbouring points."""

from __future__ import annotations

import functools
import itertools

import numpy as np


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest point with integer coordinates of even sum: round, and if the sum is odd, round the worst coordinate the other way."""
    out = np.rint(x)
    rest = x - out
    odd = np.flatnonzero(np.abs(out.sum(axis=1)) % 2 == 1)
    worst = np.abs(rest[odd]).argmax(axis=1)
    out[odd, worst] += np.where(rest[odd, worst] >= 0, 1, -1)
    return out


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points of the rows of x: E8 is the union of D8 and D8 shifted by a half."""
    whole = _nearest_d8(x)
    half = _nearest_d8(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


@functools.cache
def roots() -> np.ndarray:
    """The 240 shortest vectors: +-1 in two places, or +-1/2 everywhere with an even number of minus signs."""
    pairs = [(i, j, a, b) for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
    first = np.zeros((len(pairs), 8))
    for k, (i, j, a, b) in enumerate(pairs):
        first[k, i], first[k, j] = a, b
    signs = np.array(list(itertools.product((0.5, -0.5), repeat=8)))
    return np.concatenate([first, signs[(signs < 0).sum(axis=1) % 2 == 0]])
