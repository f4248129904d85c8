"""Pairs and spanning forests within buckets, vectorised over many buckets at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def pairs(bucket: np.ndarray, side: np.ndarray, apart: bool, most: int = 40_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs within each bucket (rows are sorted by bucket), about ``most`` at a time; if ``apart``, of different sides."""
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[starts, len(bucket)])
    for n in np.unique(sizes[sizes > 1]).tolist():
        i, j = np.triu_indices(n, 1)
        some = starts[sizes == n]
        step = max(1, most // len(i))
        for k in range(0, len(some), step):
            here = some[k : k + step, None]
            for a in range(0, len(i), most):  # a large bucket's pairs come in slices
                p, q = (here + i[a : a + most]).ravel(), (here + j[a : a + most]).ravel()
                split = side[p] != side[q]
                yield (p[split], q[split]) if apart else (p, q)


def forest(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Smallest row that each of n rows reaches over the pairs."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, p, root[q])
        np.minimum.at(new, q, root[p])
        new = new[new]
        if (new == root).all():
            return root
        root = new
