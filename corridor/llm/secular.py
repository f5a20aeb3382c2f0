"""Rank-one updates of a symmetric eigendecomposition by its secular equation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = np.finfo(float).eps
#: Steps of the root finder; it needs about eight, the rest are halvings.
STEPS = 80


def deflate(values: np.ndarray, basis: np.ndarray, z: np.ndarray, tol: float) -> np.ndarray:
    """Places of ``values`` (ascending) that an update ``z z'`` changes.

    Components of ``z`` below ``tol`` are dropped. Where two values are so near that
    their eigenvectors may be turned into each other, a rotation puts both components of
    ``z`` into the second one. ``basis`` and ``z`` are changed in place.
    """
    kept = np.flatnonzero(np.abs(z) > tol)
    if len(kept) > 1 and (np.diff(values[kept]) <= 2 * tol).any():
        chosen, last = [], kept[0]
        for place in kept[1:]:
            length = np.hypot(z[last], z[place])
            c, s = z[place] / length, z[last] / length
            if abs((values[place] - values[last]) * c * s) <= tol:
                z[last], z[place] = 0.0, length
                turned = c * basis[:, last] - s * basis[:, place]
                basis[:, place] = s * basis[:, last] + c * basis[:, place]
                basis[:, last] = turned
            else:
                chosen.append(last)
            last = place
        kept = np.array([*chosen, last])
    return kept


def secular_roots(poles: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of ``1 + sum(squares / (poles - x))``, one above each ascending pole.

    Returns for each root the number of its nearer pole and its distance from it, so
    that differences to all poles lose no digits. Each step fits the terms at or below a
    root and those above it by one pole each and solves the quadratic; a step that leaves
    the bracket of its root halves the bracket. The last root has no pole above it: one
    without weight is put beyond its bracket.
    """
    m = len(poles)
    i = np.arange(m)
    ones = np.ones(m)
    gap = np.append(np.diff(poles), squares.sum() * (1 + 4 * EPS))
    # The sign at the middle of its interval tells the nearer pole of a root.
    value = 1 + (squares / (poles[None, :] - (poles + gap / 2)[:, None])) @ ones
    origin = np.where((value >= 0) | (i == m - 1), i, i + 1)
    delta = poles[None, :] - poles[origin][:, None]
    above = origin > i
    low = np.where(above, -gap / 2, 0.0)
    high = np.where(above, 0.0, np.where(value >= 0, gap / 2, gap))
    left = np.where(above, -gap, 0.0)
    right = np.where(above, 0.0, gap)
    right[-1] = 2 * gap[-1]
    weight = np.append(squares[1:], 0.0)
    # A first guess: the two next poles as they are, all others as they count in the middle.
    middle = np.where(above, -gap / 2, gap / 2)
    rest = value - squares / (left - middle) - weight / (right - middle)
    below = (i[None, :] <= i[:, None]).astype(float)
    with np.errstate(all="ignore"):
        a = rest * (left + right) + squares + weight
        b = rest * left * right + squares * right + weight * left
        r = np.sqrt(np.abs(a * a - 4 * b * rest))
        x = np.where(a <= 0, (a - r) / (2 * rest), 2 * b / (a + r))
        x = np.where((x > low) & (x < high), x, (low + high) / 2)
        for _ in range(STEPS):
            term = delta - x[:, None]
            ratio = squares / term
            f = 1 + ratio @ ones
            done = np.abs(f) <= EPS * m * (1 + np.abs(ratio) @ ones)
            np.copyto(low, x, where=f < 0)
            np.copyto(high, x, where=f > 0)
            done |= high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high))
            if done.all():
                break
            slopes = ratio / term
            slope = slopes @ ones
            slope_below = np.einsum("ij,ij->i", slopes, below)
            to_left, to_right = left - x, right - x
            both = to_left * to_right
            # below ~ p + q / (left - x), above ~ r + s / (right - x), equal in value and slope.
            c = f - slope_below * to_left - (slope - slope_below) * to_right
            a = f * (to_left + to_right) - both * slope
            b = both * f
            r = np.sqrt(np.abs(a * a - 4 * b * c))
            new = x + np.where(a <= 0, (a - r) / (2 * c), 2 * b / (a + r))
            new = np.where((new > low) & (new < high), new, (low + high) / 2)
            x = np.where(done, x, new)
    return origin, x


@dataclass
class Spectrum:
    """Number, mean, and eigendecomposition of the centred scatter of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray  # ascending
    basis: np.ndarray  # eigenvectors as columns

    @classmethod
    def empty(cls, dims: int) -> Spectrum:
        return cls(0, np.zeros(dims), np.zeros(dims), np.eye(dims))

    def update(self, direction: np.ndarray) -> None:
        """Add ``direction direction'`` to the scatter."""
        z = direction @ self.basis
        largest = max(abs(self.values[-1]), z @ z)
        if largest == 0:
            return
        # Scaled by a power of two, so that products neither overflow nor vanish and one
        # tolerance serves values and components: what is below it changes nothing.
        root = 2.0 ** np.floor(np.log2(largest) / 2)
        unit = root * root
        values, z = self.values / unit, z / root
        kept = deflate(values, self.basis, z, 8 * EPS)
        if not len(kept):
            return
        poles = values[kept]
        if (poles[1:] <= poles[:-1]).any():
            raise ArithmeticError("equal values were left after deflation")
        origin, x = secular_roots(poles, z[kept] ** 2)
        apart = (poles[None, :] - poles[origin][:, None]) - x[:, None]
        # The update for which these roots are exact: its eigenvectors are orthogonal.
        own = poles[None, :] - poles[:, None]
        np.fill_diagonal(own, 1.0)
        exact = np.sqrt(np.abs(np.prod(apart / own, axis=0))) * np.sign(z[kept])
        vectors = exact[None, :] / apart
        vectors /= np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        if len(kept) == len(z):
            self.basis = self.basis @ vectors.T
        else:
            self.basis[:, kept] = self.basis[:, kept] @ vectors.T
        self.values[kept] = (poles[origin] + x) * unit
        if (self.values[1:] < self.values[:-1]).any():
            order = np.argsort(self.values, kind="stable")
            self.values, self.basis = self.values[order], self.basis[:, order]

    def add(self, vector: np.ndarray, copies: int = 1) -> None:
        """Add ``copies`` equal vectors: one update by what they differ from the mean."""
        apart = vector - self.mean
        total = self.n + copies
        if self.n:
            self.update(apart * np.sqrt(self.n * copies / total))
        self.mean = self.mean + apart * (copies / total)
        self.n = total

    def merge(self, other: Spectrum) -> None:
        """Add another spectrum: one update per eigenvector, one for the two means."""
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.values, self.basis = other.n, other.mean, other.values, other.basis
            return
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.update(np.sqrt(value) * vector)
        self.add(other.mean, other.n)
