"""Douglas-Peucker thinning under a tolerance that each point has of its own.

A piece is split at its worst point while that is off by more than the smallest tolerance inside the piece.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def _kept(n: int, tol: np.ndarray, off: Callable[[int, int], np.ndarray]) -> np.ndarray:
    keep = np.zeros(n, dtype=bool)
    keep[[0, n - 1]] = True
    open_ = [(0, n - 1)]
    while open_:
        a, b = open_.pop()
        if b - a < 2:
            continue
        d = off(a, b)
        k = int(d.argmax())
        if d[k] > tol[a + 1 : b].min():
            keep[a + 1 + k] = True
            open_ += [(a, a + 1 + k), (a + 1 + k, b)]
    return keep


def horizontal(x: np.ndarray, y: np.ndarray, tol: np.ndarray) -> np.ndarray:
    """Kept points: deviation is the distance to the line through the piece's ends."""

    def off(a, b):
        dx, dy = x[b] - x[a], y[b] - y[a]
        return np.abs(dx * (y[a] - y[a + 1 : b]) - dy * (x[a] - x[a + 1 : b])) / max(float(np.hypot(dx, dy)), 1e-9)

    return _kept(len(x), tol, off)


def vertical(t: np.ndarray, alt: np.ndarray, tol: np.ndarray) -> np.ndarray:
    """Kept points: deviation is that from the altitude which is linear in time between the ends."""

    def off(a, b):
        span = t[b] - t[a]
        u = (t[a + 1 : b] - t[a]) / span if span > 0 else np.zeros(b - a - 1)
        return np.abs(alt[a + 1 : b] - (alt[a] + (alt[b] - alt[a]) * u))

    return _kept(len(t), tol, off)


def ramp(alt: np.ndarray, low_ft: float, high_ft: float, low: float, high: float) -> np.ndarray:
    return np.interp(alt, [low_ft, high_ft], [low, high])


def tolerances(
    alt: np.ndarray, ground: np.ndarray, ground_m=10.0, low_m=20.0, cruise_m=150.0, ground_ft=25.0, cruise_ft=250.0, low_alt_ft=2000.0,
    high_alt_ft=12000.0,
) -> tuple[np.ndarray, np.ndarray]:
    """(metres, feet) for each point."""
    across = np.where(ground, ground_m, ramp(alt, low_alt_ft, high_alt_ft, low_m, cruise_m))
    up = np.where(ground, ground_ft, ramp(alt, low_alt_ft, high_alt_ft, ground_ft, cruise_ft))
    return across, up


def thinned(t, x, y, alt, ground, **limits) -> np.ndarray:
    """Points that either the track or its height profile needs."""
    t, x, y, alt = (np.asarray(v, dtype=np.float64) for v in (t, x, y, alt))
    across, up = tolerances(alt, np.asarray(ground, dtype=bool), **limits)
    return horizontal(x, y, across) | vertical(t, alt, up)
