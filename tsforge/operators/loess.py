"""Local linear fits with tricube weights as differences of power sums.

On each side of a point the tricube weight is a polynomial of degree nine in
the distance, so the five sums of a local fit are combinations of the power
sums ``Σ o^p`` (p ≤ 11) and ``Σ o^p y`` (p ≤ 10) over the offsets o of the
neighbours.  Power sums of a range are differences of prefix sums.  They are
kept about the centre of a block and moved to the point by the binomial
theorem; blocks are at most a quarter of a neighbourhood long, which keeps the
moves short and the sums accurate.  The cost of a point doesn't hang on the
size of its neighbourhood.
"""

from __future__ import annotations

from math import comb

import numpy as np

#: Power sums of the values and of the valid positions.
N_VALUE, N_ONE = 11, 12
N_ALL = N_VALUE + N_ONE
#: Weight sum of a point's valid neighbours below which there is no fit.
MIN_WEIGHT = 1e-9


def neighbourhood(i: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Left end and radius of the k nearest positions of position i on 0..n-1."""
    left = np.clip(np.ceil(i - k / 2.0), 0, n - k).astype(np.int64)
    return left, np.maximum(i - left, left + k - 1 - i).astype(np.float64)


def moved(sums: np.ndarray, shift: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Power sums of ``shift + scale * u`` from those of u (N_ALL rows; a column each)."""
    out = np.zeros((N_ALL, *np.broadcast(sums[0], shift).shape))
    powers = [np.ones_like(shift)]
    for _ in range(N_ONE - 1):
        powers.append(powers[-1] * shift)
    for first, count in ((0, N_VALUE), (N_VALUE, N_ONE)):
        unit = np.ones_like(scale)
        for q in range(count):
            term = sums[first + q] * unit
            for p in range(q, count):
                out[first + p] += comb(p, q) * powers[p - q] * term
            unit = unit * scale
    return out


class Blocks:
    """Prefix power sums of the rows of whole blocks."""

    def __init__(self, pos: np.ndarray, value: np.ndarray, length: int):
        self.length = length
        self.ids = np.unique(pos // length)
        at = np.searchsorted(self.ids, pos // length), pos % length
        y, one = np.zeros((len(self.ids), length)), np.zeros((len(self.ids), length))
        ok = ~np.isnan(value)
        y[at[0][ok], at[1][ok]] = value[ok]
        one[at[0][ok], at[1][ok]] = 1.0
        u = (np.arange(length) - self.middle) / length
        self.prefix = np.zeros((N_ALL, len(self.ids), length + 1))
        for p in range(N_ONE):
            if p < N_VALUE:
                np.cumsum(y * u**p, axis=1, out=self.prefix[p, :, 1:])
            np.cumsum(one * u**p, axis=1, out=self.prefix[N_VALUE + p, :, 1:])

    @property
    def middle(self) -> float:
        return (self.length - 1) / 2.0

    def sums(self, lo: np.ndarray, hi: np.ndarray, i: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Power sums of (j - i) / r over the positions lo <= j < hi."""
        out = np.zeros((N_ALL, len(i)))
        first = lo // self.length
        blocks = np.where(hi > lo, (hi - 1) // self.length - first + 1, 0)
        for t in range(int(blocks.max(initial=0))):
            some = np.flatnonzero(blocks > t)
            block = first[some] + t
            row = np.searchsorted(self.ids, block)
            known = (row < len(self.ids)) & (self.ids[np.minimum(row, len(self.ids) - 1)] == block)
            some, block, row = some[known], block[known], row[known]
            begin = block * self.length
            x0, x1 = np.maximum(lo[some] - begin, 0), np.minimum(hi[some] - begin, self.length)
            part = self.prefix[:, row, x1] - self.prefix[:, row, x0]
            out[:, some] += moved(part, (begin + self.middle - i[some]) / r[some], self.length / r[some])
        return out


def fit(before: np.ndarray, after: np.ndarray, i: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Fitted values from the power sums of (j - i) / r left of i and from i on."""
    def weighted(first: int, p: int) -> np.ndarray:
        left, right = before[first + p :], after[first + p :]
        return (left[0] + right[0] + 3.0 * (left[3] - right[3]) + 3.0 * (left[6] + right[6]) + left[9] - right[9])

    sw, sx, sxx = (weighted(N_VALUE, p) for p in range(3))
    sy, sxy = weighted(0, 0), weighted(0, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        xm, ym = sx / sw, sy / sw
        vx, vxy = sxx - sx * xm, sxy - sx * ym
        where = i + xm * r
        sloped = vx * r * r > 1e-12 * np.maximum(1.0, where * where)
        out = np.where(sloped, ym - xm * vxy / np.where(sloped, vx, 1.0), ym)
    return np.where(sw > MIN_WEIGHT, out, np.nan)
